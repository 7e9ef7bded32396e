"""Mixing, chat formatting and sharding: edge cases and laws."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ingestkit.llm import chat, mixing, sharding
from ingestkit.session import work_root

DOCS = "doc_id long, text string, source string, size string, rate string"


@pytest.fixture(scope="module")
def docs(spark):
    work_root(spark)
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}" if i % 3 else "hot", "x", "y") for i in range(600)]
    rows += [(600, None, "s1", None, None), (601, "", None, None, None), (602, "a\tb c", None, None, None),
             (None, "no id", "s2", None, None), (5, "twice", "s2", None, None), (5, "twice", "s2", None, None),
             (700, "long " * 20000, "s3", None, None)]
    return spark.createDataFrame(rows, DOCS)


def _targets(sizes, weights=(1, 2, 3), cap=3):
    """Water-filling by repeated resharing, as the rule is stated."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(cap * sizes[s])
            rest -= target[s]
        free -= over
    return target


def test_targets_are_filled_like_the_rule_says(spark):
    work_root(spark)
    for sizes in ({"a": 1000, "b": 10, "c": 5, None: 300}, {"a": 1}, {"a": 0, "b": 7}, {"b": 5, "a": 5, "c": 90, "d": 900}):
        rows = [(s, n) for s, n in sizes.items()]
        got = {r.source: r.target for r in mixing.source_targets(
            spark.createDataFrame(rows, "source string, size long")).collect()}
        want = _targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want), (sizes, got, want)


def test_mix(spark, docs):
    planned = mixing.plan_mix(docs)
    got = mixing.mix_digest(planned).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[600].size == 0 and by_id[600].taken == 0 and by_id[602].size == 2
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_digest(mixing.plan_mix(docs)).collect()))
    emitted = mixing.emit_mix(planned).groupBy("doc_id").count().collect()
    assert sum(r["count"] for r in emitted) == planned.agg(F.sum("copies")).first()[0]
    assert mixing.plan_mix(docs.where("false")).count() == 0


def test_copies_follow_the_rate(spark):
    work_root(spark)
    many = spark.range(20000).selectExpr("id AS doc_id", "'a b c' AS text", "CONCAT('s', id % 3) AS source")
    got = mixing.plan_mix(many).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.05 * r.target for r in got)


def test_shards(spark, docs):
    got = sharding.assign_shards(docs).collect()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(got) == docs.count()
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in texts)
    assert sorted({(r.doc_id, r["size"], r.text_crc32) for r in got}, key=str) and \
        set(want) == {(r["size"], r.text_crc32) for r in got}
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert 0 < sum(r.grown_shard == 8 for r in got) < len(got) / 4
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert sharding.assign_shards(docs.where("false")).count() == 0
    assert sharding.assign_shards(docs, keep=["source"]).columns[1] == "source"


def test_shares_follow_the_weights(spark):
    topology = {"a": {"x": (0,)}, "b": {"y": (1, 2), "z": (3,)}}
    ids = spark.range(40000).select(F.col("id").alias("doc_id"))
    n = {r.s: r["count"] for r in ids.groupBy(sharding.shard_of("doc_id", topology).alias("s")).count().collect()}
    assert all(abs(n[s] - 10000) < 500 for s in range(4))


def _say(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>x<|text|>", "\\", "\\<|", "<\\|end|>", "<", "", "é<|end|>\n", "a" * 5000]
    rows = [(c, i, ["user", "assistant", None][i % 3], nasty[(c + i) % len(nasty)]) for c in range(9) for i in range(300)]
    rows += [(20, None, "user", None), (20, 1, "assistant", "x"), (20, 1, "assistant", "x"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_conversations(df.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r.conv_id: r for r in chat.read_back(blocks).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = [(x[1], x[2] or "", x[3] or "") for x in rows if x[0] == conv]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert r.n_turns == len(mine) and r.turns_sha256 == _say([m[1:] for m in mine])
        said = "".join(t for _, role, t in mine if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert blocks.groupBy("conv_id").count().agg(F.max("count")).first()[0] == 3
    assert chat.read_back(chat.format_conversations(
        df.where("false").withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_parts_become_placeholders(spark):
    schema = "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,n_tokens:int>>"
    df = spark.createDataFrame([(1, 0, "user", [("text", "see <|image|>", None, 0), ("image", None, "s3://a", 85),
                                                ("audio", None, "b.wav", None), None, ("text", "!", None, 0)]),
                                (1, 1, "assistant", None)], schema)
    r = chat.format_conversations(df).first()
    assert r.formatted == "<|turn|>user<|text|>see <\\|image|><|image|><|audio|>!<|end|>\n<|turn|>assistant<|text|><|end|>\n"
    assert [(a.turn, a.position, a.kind, a.ref, a.n_tokens) for a in r.attachments] == \
        [(0, 1, "image", "s3://a", 85), (0, 2, "audio", "b.wav", 0)]
    assert r.attached_tokens == 85 and [(s.start, s.length) for s in r.loss_spans] == [(len(r.formatted) - 8, 0)]
