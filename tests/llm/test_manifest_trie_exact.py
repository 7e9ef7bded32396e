"""Exact dedup, Merkle manifest and prefix trie against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ingestkit.llm import exact, merkle, trie
from ingestkit.session import work_root

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, digest string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    work_root(spark)
    rng = random.Random(5)
    bodies = ["a b", "a\tb", "a \n b", "A b", "", " ", "\x0b\x0c", None, "é b", "long " * 30000, "a b", "a b "]
    rows = [(i, rng.choice(bodies), rng.choice(["en", None]), "hot" if i % 3 == 0 else f"s{i % 7}", i % 5 or None) for i in range(400)]
    rows += [(None, "no id", None, None, None), (None, "no id", "en", None, 1), (7, "twice", "en", "s1", 1), (7, "twice", "en", "s1", 1),
             (900, "ALONE", "en", "only", 2), (901, None, None, None, None), (-3, "A b", "de", "", 0)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)


def _plain_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    groups = {}
    for r, body in zip(rows, norm, strict=True):
        groups.setdefault(body, []).append(r.doc_id)
    out = []
    for r, body in zip(rows, norm, strict=True):
        ids = groups[body]
        least = min((i for i in ids if i is not None), default=None)
        out.append((r.doc_id, least, len(ids), _sha(body)))
    return out


@pytest.mark.parametrize("how", ["hash", "all texts", "weak hash"])
def test_exact_duplicates(docs, how):
    options = {"hash": {}, "all texts": {"max_filter_keys": 0},
               "weak hash": {"key": lambda body: F.encode(F.substring(F.md5(body), 1, 1), "utf-8")}}[how]
    got = exact.exact_duplicates(docs, keep=["lang", "keep_id"], **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "lang"]
    got = got.collect()
    want = _plain_exact(docs.collect())
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    kept = {}
    for r in got:
        kept.setdefault(r.text_sha256, []).append(r.doc_id) if r.kept else None
    assert len(kept) == len({w[3] for w in want}) and all(len(ids) == 1 for ids in kept.values())
    least = {w[3]: w[1] for w in want}
    assert all(least[s] == ids[0] for s, ids in kept.items())


def test_exact_of_empty_tables_and_all_columns(docs):
    assert exact.exact_duplicates(docs.where("false")).count() == 0
    assert exact.drop_copies(docs.where("false")).count() == 0
    for bound in (0, 1000):
        left = exact.drop_copies(docs, max_broadcast_rows=bound)
        assert left.columns == docs.columns
        bodies = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
        assert len(bodies) == len(set(bodies)) == len({w[3] for w in _plain_exact(docs.collect())})


def test_exact_never_gathers_a_hot_group(spark):
    many = spark.range(30000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same  text', CONCAT('t', id)) AS text")
    got = exact.exact_duplicates(many)
    assert got.where("group_size = 10000 and keep_id = 0").count() == 10000 and got.where("kept").count() == 20001
    rows = many.withColumn("__key", F.md5("text")).withColumn("__row", F.col("doc_id"))
    plan = exact._grouped(rows, ["__key"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(row, text):
    return _sha("".join(_field(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def _plain_tree(leaves):
    """(root, proofs): proofs are lists of (left, right) a level."""
    nodes, at = list(leaves), list(range(len(leaves)))
    proofs = [[] for _ in leaves]
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for j, place in enumerate(at):
            run, own = runs[place // 16], place % 16
            proofs[j].append(("".join(run[:own]), "".join(run[own + 1:])))
        nodes, at = [_sha("".join(r)) for r in runs], [p // 16 for p in at]
    return (nodes[0] if nodes else None), proofs


def _lower(text):
    return text and re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _plain_report(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append((r, _leaf(r, r.text)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for name in names:
        by[name].sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
        top, proofs = _plain_tree([leaf for _, leaf in by[name]])
        tops.append(top)
        found += [(r, leaf, name, p) for (r, leaf), p in zip(by[name], proofs, strict=True)]
    root, over = _plain_tree(tops)
    out = []
    for r, leaf, name, proof in found:
        proof = proof + over[names.index(name)]
        struck = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        h = _leaf(r, _lower(r.text)) if struck else leaf
        for left, right in proof:
            h = _sha(left + h + right)
        out.append((r.doc_id, leaf, tops[names.index(name)], root, _sha("".join(a + b for a, b in proof)), h, h == root))
    return out


def _report(df):
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.tamper_report(df, F.when(struck, merkle.lower_ascii(F.col("text"))))
    return got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_merkle_report(spark, docs):
    rows = docs.collect()
    assert sorted(map(str, (tuple(r) for r in _report(docs).collect()))) == sorted(map(str, _plain_report(rows)))
    one = docs.where("source = 'only'")
    assert [tuple(r) for r in _report(one).collect()] == _plain_report(one.collect())
    assert _report(docs.where("false")).count() == 0


def test_merkle_of_many_sources_and_a_hot_one(spark):
    work_root(spark)
    many = spark.range(2000).selectExpr(
        "id AS doc_id", "CONCAT('T', id) AS text", "IF(id % 3 = 0, 'hot', CONCAT('s', id % 300)) AS source", "'en' AS lang", "id AS n_chars")
    assert sorted(map(str, (tuple(r) for r in _report(many).collect()))) == sorted(map(str, _plain_report(many.collect())))
    manifest = merkle.build_manifest(many)
    for k, nodes in enumerate(manifest.forest.levels):
        assert nodes.where(f"hi - lo > {16**k} or lo % {16**k} <> 0 or lo >= hi").count() == 0
    with pytest.raises(ValueError, match="digest"):
        merkle.build_manifest(many, carry={"digest": F.lit(1)})


def _plain_trie(rows):
    own = {}
    for r in rows:
        if r.conv_id is not None:
            own.setdefault(r.conv_id, []).append(r)
    digest = lambda r: hashlib.sha256(f"{len((r.role or '').encode())}:{r.role or ''}{r.text or ''}".encode()).digest()
    for c in own:
        own[c] = [(r.role or "", r.text or "") for r in sorted(own[c], key=lambda r: (r.turn is not None, r.turn or 0, digest(r)))]
    built = {}
    for c, w in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + w[h:]
    members = {}
    for c, w in built.items():
        for d in range(len(w) + 1):
            members.setdefault(tuple(w[:d]), []).append(c)
    nodes = {p: min(m) for p, m in members.items()}
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, c in nodes.items():
        under = [q for q in nodes if q[:len(p)] == p]
        ends = sorted(x for x in members[p] if len(built[x]) == len(p))
        out.append((c, len(p), nodes[p[:-1]] if p else None, len(members[p]), len(kids.get(p, [])), sum(q not in kids for q in under),
                    sum((len(members[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in under), _sha(",".join(map(str, ends)))))
    return sorted(map(str, out))


def _trie(df):
    got = trie.prefix_trie(*trie.branch(trie.turn_rows(df))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(str(tuple(r)) for r in got.collect())


CONV = "conv_id long, turn long, role string, text string, n long, depth string"


def test_trie_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["x", "yé", None, "z" * 50]))
            for c in range(60) if c % 11 for t in range(rng.randrange(1, 14))]
    rows += [(70, 1, "user", "x")] * 3 + [(None, 0, "user", "nobody"), (71, 0, "user", "w " * 30000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV)
    assert _trie(df) == _plain_trie(df.collect())


def test_trie_of_a_hot_conversation_and_copies(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(300)]
    rows += [(c, t, "user", "same") for c in range(100, 250) for t in range(3)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV)
    assert _trie(df) == _plain_trie(df.collect())


def test_trie_without_rows_or_turns(spark):
    empty = spark.createDataFrame([], CONV)
    assert _trie(empty) == []
    turns = spark.createDataFrame([], "conv_id long, at long, token binary, n_bytes long")
    members = spark.createDataFrame([(4, 0), (2, 0)], "conv_id long, n_turns long")
    r = trie.prefix_trie(turns, members).first()
    assert (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) == (2, 0, None, 2, 0, 1, 0)
    assert r.ends_sha256 == _sha("2,4")


def test_trie_lists_ids_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 7)
    df = spark.createDataFrame([(c, 0, "user", "same", 1, "x") for c in range(40)], CONV)
    assert _trie(df) == _plain_trie(df.collect())


@pytest.mark.parametrize("lengths", [[1], [4, 4, 3], [5, 8, 7, 1]])
def test_trie_of_every_width(spark, lengths):
    """Lengths at and beside powers of two, sequences that share openings."""
    turns = [(c, t, f"{t}-{c if t >= 2 * c + 1 else 0}".encode(), t + 1) for c, n in enumerate(lengths) for t in range(n)]
    got = trie.prefix_trie(spark.createDataFrame(turns, "conv_id long, at long, token binary, n_bytes long"),
                           spark.createDataFrame([(c, n) for c, n in enumerate(lengths)], "conv_id long, n_turns long")).collect()
    seqs = {c: [x[2:] for x in turns if x[0] == c] for c in range(len(lengths))}
    prefixes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            prefixes.setdefault(tuple(s[:d]), []).append(c)
    want = {}
    for p, m in prefixes.items():
        under = [q for q in prefixes if q[:len(p)] == p]
        want[(min(m), len(p))] = (len(m), sum(all(r[:-1] != q for r in prefixes if r) for q in under),
                                  sum((len(prefixes[q]) - 1) * (q[-1][1] if q else 0) for q in under))
    assert {(r.conv_id, r.depth): (r.n_convs, r.n_leaves, r.saved_tokens) for r in got} == want
