"""DuckDB SQL for the queries that SQL can express."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
turned AS (
  SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         3 * source_size AS cap FROM per),
levels AS (
  SELECT *, coalesce(CAST(sum(cap) OVER before AS BIGINT), 0) AS capped,
         (CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(cap) OVER before AS BIGINT), 0))::DOUBLE
         / (CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER before AS BIGINT), 0))::DOUBLE AS level
  FROM turned
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT arg_min(level, capped) AS share FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, share * weight) AS target,
         CASE WHEN source_size > 0 THEN least(cap::DOUBLE, share * weight) / source_size ELSE 0.0 END AS rate
  FROM levels, share)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN ('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 12))::BIGINT::DOUBLE
             / 281474976710656.0 < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS r, replace(replace(text, '\', '\\'), '<|', '<\|') AS t
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|><|text|><|end|>') + 1 + length(r) + length(t)) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""


def _draw(node: str, weight: int) -> str:
    return (f"(-ln((('0x' || left(md5('{node}:' || k), 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)"
            f" / {float(weight)})")


def _tree(node, path: str) -> str:
    if isinstance(node, int):
        return str(node)
    children = list(node.items()) if isinstance(node, dict) else [(f"s{s}", s) for s in node]
    if len(children) == 1:
        return _tree(children[0][1], f"{path}/{children[0][0]}")
    count = lambda x: sum(map(count, x.values())) if isinstance(x, dict) else 1 if isinstance(x, int) else len(x)
    draws = {name: _draw(f"{path}/{name}", count(child)) for name, child in children}
    least = f"least({', '.join(draws.values())})"
    cases = " ".join(f"WHEN {draws[name]} = {least} THEN {_tree(child, f'{path}/{name}')}" for name, child in children)
    return f"CASE {cases} END"


_OLD = {"east": {"e1": (0, 1), "e2": (2, 3)}, "west": {"w1": (4, 5), "w2": (6, 7)}}
_NEW = {**_OLD, "new": {"new1": (8,)}}

# The CRC of a text: 256 table entries from the polynomial, then one fold over its bytes.
SHARD = f"""
WITH RECURSIVE bits AS (
  SELECT i AS entry, i::BIGINT AS c, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT entry, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY entry) AS tab FROM bits WHERE step = 8),
distinct_texts AS (SELECT DISTINCT coalesce(text, '') AS body FROM documents),
crcs AS (
  SELECT body, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM distinct_texts, crc_table),
rows_ AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, crc AS text_crc32, coalesce(doc_id::VARCHAR, '') AS k
  FROM documents JOIN crcs ON coalesce(text, '') = body),
placed AS (SELECT *, {_tree(_OLD, 'root')} AS shard, {_tree(_NEW, 'root')} AS grown_shard FROM rows_)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY left(md5('slot:' || k), 3), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  CAST(grown_shard AS INT) AS grown_shard
FROM placed
"""

ORACLE = {
    "op6_mix_sources": MIX,
    "op7_format_chat": CHAT,
    "op10_shard_tree": SHARD,
}

_COMPONENTS = """
reach(n, m) AS (
  SELECT a, b FROM links UNION SELECT reach.n, links.b FROM reach JOIN links ON reach.m = links.a),
least_of AS (SELECT n, min(m) AS least_m FROM reach GROUP BY n)
"""

CAPS = f"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
{_COMPONENTS}, degree AS (SELECT a, count(*) AS d FROM links GROUP BY a)
SELECT vec_id, coalesce(d, 0) AS n_links, least(vec_id, coalesce(least_m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least_m, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON a = vec_id LEFT JOIN least_of ON n = vec_id
"""

MINHASH = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
{_COMPONENTS}
SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, least(doc_id, coalesce(least_m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(least_m, doc_id)) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON least_of.n = doc_id
"""

DECONTAM = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM lowered) , (SELECT DISTINCT size FROM windows)
  WHERE i + size - 1 <= len(w)),
hits AS (SELECT doc_id, i, places.size, item_id FROM places JOIN windows ON places.p = windows.p AND places.size = windows.size),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLE |= {"op2_cap_filters": CAPS, "op3_minhash": MINHASH, "op9_decontaminate": DECONTAM}

EXACT = r"""
WITH bodies AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
groups_ AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM bodies GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM bodies JOIN groups_ USING (body)
"""


def _crc(table: str, column: str, name: str) -> str:
    """CTEs: the CRC of a column's distinct texts, as ``name`` (body, crc)."""
    return f"""
bits AS (
  SELECT i AS entry, i::BIGINT AS c, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT entry, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY entry) AS tab FROM bits WHERE step = 8),
{name} AS (
  SELECT body, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT {column}::VARCHAR AS body FROM {table} WHERE {column} IS NOT NULL), crc_table)"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || ({f}), '-')" for f in fields) + ")"


def _levels(leaves: str, prefix: str, n: int) -> str:
    """CTEs of n levels: a node alone in its tree is carried up unchanged."""
    out = [f"{prefix}0 AS (SELECT tree, i, digest, count(*) OVER (PARTITION BY tree) AS c FROM {leaves})"]
    for k in range(1, n + 1):
        out.append(f"""{prefix}s{k} AS (
  SELECT tree, i, CASE WHEN c = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (PARTITION BY tree, i // 16 ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN c = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (PARTITION BY tree, i // 16 ORDER BY i
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r, c > 1 AS up
  FROM {prefix}{k - 1})""")
        out.append(f"""{prefix}{k} AS (
  SELECT tree, i, digest, count(*) OVER (PARTITION BY tree) AS c FROM (
    SELECT tree, i // 16 AS i, CASE WHEN any_value(c) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest
    FROM {prefix}{k - 1} GROUP BY tree, i // 16))""")
    return ",\n".join(out)


_HIGH, _UPPER = 6, 4            # 16**6 leaves a source, 16**4 sources


def _merkle() -> str:
    joins = "\n".join(f"JOIN lows{k} ON lows{k}.tree = named.tree AND lows{k}.i = named.i // {16**(k - 1)}" for k in range(1, _HIGH + 1)) + "\n" + \
        "\n".join(f"JOIN tops{k} ON tops{k}.i = named.tree // {16**(k - 1)}" for k in range(1, _UPPER + 1))
    steps = [f"lows{k}" for k in range(1, _HIGH + 1)] + [f"tops{k}" for k in range(1, _UPPER + 1)]
    proof = " || ".join(f"{s}.l || {s}.r" for s in steps)
    sides = ", ".join(f"{s}.l AS l{j}, {s}.r AS r{j}, {s}.up AS u{j}" for j, s in enumerate(steps))
    folds = ",\n".join(f"fold{j + 1} AS (SELECT * EXCLUDE h, CASE WHEN u{j} THEN sha256(l{j} || h || r{j}) ELSE h END AS h FROM fold{j})"
                       for j in range(len(steps)))
    return f"""
WITH RECURSIVE {_crc("documents", "doc_id", "crcs")},
leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf("text")} END AS seen
  FROM documents LEFT JOIN crcs ON body = doc_id::VARCHAR),
named AS MATERIALIZED (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
{_levels("named", "low", _HIGH)},
subroots AS (SELECT 0 AS tree, tree AS i, digest FROM low{_HIGH}),
{_levels("subroots", "top", _UPPER)},
fold0 AS (
  SELECT doc_id, leaf, subroots.digest AS subroot, top{_UPPER}.digest AS root, sha256({proof}) AS proof_sha256, seen AS h, {sides}
  FROM named JOIN subroots ON subroots.i = named.tree JOIN top{_UPPER} ON true
{joins}),
{folds}
SELECT doc_id, leaf, subroot, root, proof_sha256, h AS folded_root, h = root AS verified FROM fold{len(steps)}
"""


TRIE = f"""
WITH RECURSIVE {_crc("conversations", "conv_id", "crcs")},
own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
heads AS (SELECT conv_id, w, (crc % 9)::INT AS h FROM own JOIN crcs ON body = conv_id::VARCHAR),
built AS (
  SELECT heads.conv_id, coalesce(first_.w, [])[1:h] || heads.w[h + 1:] AS w
  FROM heads LEFT JOIN own first_ ON first_.conv_id = heads.conv_id - heads.conv_id % 5),
prefixes AS (
  SELECT conv_id, d, len(w) = d AS ends, md5(w[1:d]::VARCHAR || d) AS node, md5(w[1:d - 1]::VARCHAR || (d - 1)) AS parent,
         CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(w[d].text)) END AS n_bytes
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM built)),
nodes AS (
  SELECT node, any_value(CASE WHEN d = 0 THEN NULL ELSE parent END) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(n_bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent),
above AS (
  SELECT nodes.node AS low, prefixes.node AS high FROM nodes JOIN prefixes ON prefixes.conv_id = nodes.conv_id AND prefixes.d <= nodes.depth),
totals AS (
  SELECT high AS node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
  FROM above JOIN nodes ON nodes.node = low LEFT JOIN kids ON kids.node = low GROUP BY high)
SELECT nodes.conv_id, nodes.depth, over_.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN totals USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes over_ ON over_.node = nodes.parent
"""

ORACLE |= {"op11_merkle": _merkle(), "op12_prefix_trie": TRIE, "op13_exact": EXACT}


SCORES = r"""
WITH docs AS (
  SELECT doc_id, EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id AND quality = 1) AS target,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pairs AS (
  SELECT doc_id, target, CASE WHEN i = 1 THEN NULL ELSE w[i - 1] END AS u, w[i] AS v
  FROM (SELECT doc_id, target, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
two AS (SELECT u, v, count(*) AS b, count(*) FILTER (target) AS t FROM pairs GROUP BY u, v),
one AS (SELECT v, count(*) AS b, count(*) FILTER (target) AS t FROM pairs GROUP BY v),
before AS (SELECT u, count(*) AS b, count(*) FILTER (target) AS t FROM pairs GROUP BY u),
whole AS (SELECT count(*) AS b, count(*) FILTER (target) AS t, (SELECT count(*) FROM one) AS n_words FROM pairs),
losses AS (
  SELECT two.u, two.v,
         -ln(0.7 * two.b / greatest(before.b, 1) + 0.3 * (one.b + 0.5) / (whole.b + 0.5 * (n_words + 1))) AS loss_b,
         -ln(0.7 * two.t / greatest(before.t, 1) + 0.3 * (one.t + 0.5) / (whole.t + 0.5 * (n_words + 1))) AS loss_t
  FROM two JOIN one USING (v) JOIN before ON before.u IS NOT DISTINCT FROM two.u CROSS JOIN whole),
per AS (
  SELECT doc_id, avg(loss_t) AS loss_t, avg(loss_b) AS loss_b
  FROM pairs JOIN losses ON losses.u IS NOT DISTINCT FROM pairs.u AND losses.v = pairs.v GROUP BY doc_id)
SELECT doc_id, len(w) AS n_tokens, round(loss_t, 9) AS loss_target, round(loss_b, 9) AS loss_background, round(loss_t - loss_b, 9) AS score
FROM docs LEFT JOIN per USING (doc_id)
"""

ORACLE |= {"op1_lm_scores": SCORES}

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 199, 0))) AS i FROM docs)),
repeated AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
starts AS (SELECT doc_id, i FROM windows SEMI JOIN repeated USING (k)),
runs AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
    SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM starts)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
before AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b,
         string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS kept
  FROM before JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

ORACLE |= {"op8_remove_repeats": REPEATS}
