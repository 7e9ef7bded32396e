"""Near duplicates, cap filters, repeated strings and components against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ingestkit.llm import caps, minhash, repeats
from ingestkit.llm.components import connected_components
from ingestkit.session import work_root


def _components(nodes, links):
    part = {n: n for n in nodes}

    def find(n):
        while part[n] != n:
            n = part[n]
        return n
    for a, b in links:
        x, y = find(a), find(b)
        part[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    work_root(spark)
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + \
        [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for e in links if e[0] != e[1] for n in e}
    assert got == {n: c for n, c in _components({n for e in links for n in e}, links).items() if n in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- MinHash

def _shingles(text):
    w = [x for x in _lower(text).replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.mark.parametrize(("block", "exact"), [(256, False), (4, False), (256, True)])
def test_near_duplicates_equal_brute_force(spark, block, exact):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    shared = " ".join(rng.choices(vocabulary, k=40))
    for _ in range(120):            # edited copies, some of copies; texts with a common passage
        w = rng.choice(texts).split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [shared + " " + " ".join(rng.choices(vocabulary, k=rng.randint(5, 60))) for _ in range(30)]
    base = rng.choices(vocabulary, k=150)
    for _ in range(40):             # one group whose members mostly link through its original
        w = list(base)
        for i in rng.sample(range(150), 4):
            w[i] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [" ".join(base), None, "", " \n", "One Two", "one\ttwo", "one two three", " ", "x " * 30000, "x " * 40000]
    ids = list(range(0, 3 * len(texts), 3))
    rng.shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("rep", F.lit("clash"))
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, block=block, exact=exact).collect()}
    sets = {i: _shingles(t) for i, t in zip(ids, texts, strict=True)}
    some = [i for i in ids if sets[i]]
    links = [(a, b) for a in some for b in some if a < b
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = _components(ids, links)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in ids}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_of_odd_rows(spark):
    t = "a b c d e f g h"
    docs = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t), (3, "other words here"), (3, t)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in minhash.near_duplicates(docs).collect())
    assert got == [("1", 4, "1"), ("1", 4, "1"), ("2", 4, "1"), ("3", 1, "1"), ("3", 4, "1"), ("None", 4, "None")]
    assert sorted(str(r.doc_id) for r in minhash.drop_near_duplicates(docs).collect()) == ["1", "None"]
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_one_row_of_each_component_stays(spark):
    t = "a b c d e f g h"
    docs = spark.createDataFrame([(None, t, 1), (3, "other words here", 2), (3, t, 3), (2, t, 4), (None, "no id at all", 5),
                                  (None, "no id at all", 6), (7, "other words here", 7), (3, "others", 8)], "doc_id long, text string, n long")
    stage = dict(corpus_pipeline.STAGES)["minhash_dedup"]
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert got == {(2, t), (3, "other words here"), (3, "others"), (None, "no id at all")} and out.count() == 4


def test_union_estimate_is_exact_for_whole_sets():
    a, b = np.array([[1, 2, 3, 4, -1, -1]]), np.array([[2, 3, 9, 10, 11, -2]])
    assert minhash.union_estimates(a, b, 6)[0] == 2 / 6          # of the 6 smallest of 7: 2 shared
    assert minhash.union_estimates(a, b, 99)[0] == 2 / 7


def test_loss_sets_what_must_be_shared():
    tail = lambda m: sum(math.comb(64, i) * 0.75**i * 0.25**(64 - i) for i in range(m))
    for loss in (1e-4, 5e-6, 1e-8):
        need = minhash.least_shared(64, 75, loss)
        assert tail(need) <= loss < tail(need + 1)
    assert minhash.least_shared(64, 75, 5e-6) == 32 and minhash.least_shared(4, 100, 0.5) == 4


def test_distinct_ids_are_dropped_without_a_shuffle_of_the_texts(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "CONCAT('a b c d e f g ', id % 150) AS text", "id AS n")
    out = minhash.drop_near_copies(docs)
    assert out.columns == docs.columns and out.count() == 150
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(doc_id" not in plan


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 80)) for _ in range(20)]
    rows, columns = np.arange(0, 12), np.arange(8, 20)
    got = minhash.shared_counts(sets, rows, columns, width=16)
    assert all(got[i, j] == len(np.intersect1d(sets[a], sets[b])) for i, a in enumerate(rows) for j, b in enumerate(columns) if a != b)


# ---- cap filters

def _vectors(rng, d=64):
    centres = rng.standard_normal((60, d))
    x = [c + s * rng.standard_normal(d) for c in centres for s in rng.uniform(0.05, 0.45, 8)]
    x += [list(x[0])] * 30 + [list(np.array(x[0]) * 2)] + list(rng.standard_normal((60, d)))
    return np.array(x, np.float32)


@pytest.mark.parametrize("block", [1024, 8])
def test_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(9)
    x = _vectors(rng)
    label = [int(v) for v in rng.integers(0, 2, len(x))]
    rows = [(i, [float(v) for v in e], l) for i, (e, l) in enumerate(zip(x, label, strict=True))]
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 0.0], [2.0, 0.0]]
    rows += [(1000 + i, e, 0) for i, e in enumerate(odd)] + [(2000, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("clash"))
    got = {r.vec_id: r for r in caps.near_vectors(df, block=block).collect()}
    y = x.astype(np.float64)
    near = (y @ y.T) / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None] >= 0.93
    near &= np.array(label)[:, None] == np.array(label)[None]
    np.fill_diagonal(near, False)
    want = _components(range(len(x)), list(zip(*np.nonzero(near), strict=True)))
    assert [(got[i].n_links, got[i].component_id) for i in range(len(x))] == [(int(near[i].sum()), want[i]) for i in range(len(x))]
    assert all((got[1000 + i].n_links, got[1000 + i].component_id) == (0, 1000 + i) for i in range(6))
    assert got[1006].n_links == got[1007].n_links == 1 and got[1007].component_id == 1006
    assert got[2000].n_links == 0 and got[None].n_links == 0 and got[None].component_id is None
    assert caps.near_vectors(df.where("false")).count() == 0


def test_doubles_are_compared_as_doubles(spark):
    # two pairs that rounding to float would move over the limit, one each way
    x = np.array([1.0, 0.0])
    limit = math.acos(0.93)
    rows = [(0, [1.0, 0.0], 0), (1, [math.cos(limit - 1e-12), math.sin(limit - 1e-12)], 0),
            (2, [1.0, 0.0], 1), (3, [math.cos(limit + 1e-12), math.sin(limit + 1e-12)], 1),
            (4, [3.0, 4.0], 2), (4, [3.0, 4.0], 2), (5, [6.0, 8.0], 2), (5, [-1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in caps.near_vectors(df).collect())
    near = [[float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)) >= 0.93 for _, b, _ in rows] for _, a, _ in rows]
    assert near[0][1] and not near[2][3] and np.float32(x).dtype == np.float32
    # rows that share an id share their links
    assert got == [(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (5, 2, 4), (5, 2, 4)]
    whole = spark.createDataFrame([(0, [1, 0], 0), (1, [2, 0], 0)], "vec_id long, embedding array<int>, label int")
    assert [r.n_links for r in caps.near_vectors(whole).collect()] == [1, 1]


def test_list_decoding_finds_all_directions():
    import itertools
    rng = np.random.default_rng(1)
    plan = caps.plan_filters(500, 16, 0.93, bucket=24)
    x = rng.standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for r in range(plan["repeat"]):
        rotation, codes = caps.code_vectors(plan, r)
        whole = np.array([np.concatenate(c) for c in itertools.product(*codes)])
        row, name = np.nonzero((x @ rotation) @ whole.T >= plan["height"])
        want |= set(zip(row, name + r * len(whole), strict=True))
    assert set(zip(*caps.list_decode(x, plan), strict=True)) == want


@pytest.mark.parametrize("d", [8, 33, 64])
def test_a_vector_exceeds_the_same_filters_in_any_company(d):
    rng = np.random.default_rng(4)
    plan = caps.plan_filters(20_000, d, 0.93, bucket=200)
    x = rng.standard_normal((300, d)).astype(np.float32).astype(np.float64)
    whole = caps._lists(x, np.arange(300), plan)
    for some in ([7], [0, 299], list(range(0, 300, 3))):
        for i, names in zip(some, caps._lists(x[some], np.arange(len(some)), plan), strict=True):
            assert sorted(names) == sorted(whole[i])


@pytest.mark.parametrize(("n", "d"), [(500, 64), (50_000, 64), (2_000_000, 64), (50_000, 16)])
def test_recall_of_pairs_at_the_limit(n, d):
    rng = np.random.default_rng(2)
    x, side = rng.standard_normal((2, 1000, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * side
    plan = caps.plan_filters(n, d, 0.93, bucket=200)
    pairs = [set(zip(*(c.tolist() for c in caps.list_decode(v, plan)), strict=True)) for v in (x, y)]
    assert len({row for row, _ in pairs[0] & pairs[1]}) >= 990


# ---- repeated strings

@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        length, symbol = rng.choice([4, 6, 8]), rng.choice([1, 2])
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 8))]
        found = repeats.repeated_starts(strings, length, symbol, shard_bytes=rng.choice([1, 20, 1000]))
        count = {}
        for s in strings:
            for i in range(len(s) - length + 1):
                count[s[i:i + length]] = count.get(s[i:i + length], 0) + 1
        for s, f in zip(strings, found, strict=True):
            assert f.tolist() == [count[s[i:i + length]] > 1 for i in range(len(s) - length + 1)]


def _cut(texts, length):
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i:i + length]] = count.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:len(t)] > 0
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [16_384, 1])
def test_repeats_equal_brute_force(spark, hot):
    rng = random.Random(10)
    make = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [make(n) for n in (150, 198, 199, 200, 201, 400)]
    texts = [make(rng.randint(0, 100)) + rng.choice(passages) + make(rng.randint(0, 300)) for _ in range(60)]
    texts += [texts[0], texts[1], None, "", "ab", "x" * 1000, "xy" * 150, passages[5] * 3, "z" * 200, "z" * 199, texts[3][5:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit("clash"))
    out = repeats.remove_repeats(docs, hot=hot, max_broadcast_bytes=0 if hot == 1 else 1 << 20)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == _cut([(t or "").encode() for t in texts], 200)
    assert repeats.remove_repeats(docs.where("false")).count() == 0


def test_repeats_in_rows_without_or_with_one_id(spark):
    t, u = "ab" * 60 + "c" * 130, "".join(chr(97 + i * i % 26) for i in range(190))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t), (None, u), (2, u)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert got == [("1", 250, 250), ("1", 250, 250), ("2", 190, 0), ("None", 190, 0), ("None", 250, 250)]


def test_long_texts_are_cut_into_pieces(monkeypatch):
    import pyarrow as pa
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "short", None])], names=["text"])

    def windows():
        out = set()
        for data, offsets, rows, base in repeats._pieces(batch, 200):
            doc, place, first, last, h = repeats.anchors(data, offsets, 200, 48)
            for d, p, a, b, x in zip(doc, place, first, last, h, strict=True):
                out.update((int(rows[d]), int(p - offsets[d]) + base, int(s - offsets[d]) + base, int(x)) for s in range(a, b + 1))
        return out
    whole = windows()
    monkeypatch.setattr(repeats, "PIECE", 1000)
    assert windows() == whole and len(whole) == 9000 - 199
