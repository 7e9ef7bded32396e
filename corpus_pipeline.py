"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all that the stage before
kept and returns a DataFrame, which is written as Parquet and read back as the
next stage's documents.  All but the last return the columns of documents.

1. language_id: texts without a recognisable language (null, no letter) go,
   also when there is no label to learn languages from.
2. minhash_dedup: one document of each group of near copies stays.
3. decontaminate: documents that hold a benchmark passage go.
4. mix_sources: documents are repeated or left out for the target weights.
5. shard: every copy gets a shard and a slot.

Cases: rows of one id, and rows without an id, are documents of their own in
the second stage; an empty table passes through; columns of any other name come along untouched.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.llm import decontam, langid, minhash, mixing, sharding
from ingestkit.llm.oracles import DECONTAM, MINHASH, MIX, SHARD
from ingestkit.session import scratch_dir
from ingestkit.workloads.common import table

_USED = ("doc_id", "text", "source")


def _packed(docs: DataFrame) -> DataFrame:
    """The columns that operators use, the others in one struct that no
    operator's column can clash with."""
    others = [c for c in docs.columns if c not in _USED]
    return docs.select(*_USED, F.struct(*[docs[c] for c in others], F.lit(0).alias("__")).alias("__row"))


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in _USED else F.col("__row").getField(c).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train_on(docs)
    if not model["families"]:                     # no label to learn from
        return langid.with_letter(docs)
    return _unpacked(langid.identify(_packed(docs), model).where(F.col("lang_pred") != langid.UNKNOWN), docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.find_overlaps(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.where("n_hit = 0"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _unpacked(mixing.emit_mix(mixing.plan_mix(_packed(docs))), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def _over(sql: str, docs: str) -> str:
    return re.sub(r"\bdocuments\b", docs, sql)


ORACLE_SQL = rf"""
WITH spoken AS (SELECT * FROM documents WHERE regexp_matches(coalesce(text, ''), '\p{{L}}')),
dedup AS MATERIALIZED ({_over(MINHASH, "spoken")}),
distinct_docs AS (SELECT spoken.* FROM spoken JOIN dedup USING (doc_id) WHERE kept),
leaks AS MATERIALIZED ({_over(DECONTAM, "distinct_docs")}),
clean AS (SELECT distinct_docs.* FROM distinct_docs JOIN leaks USING (doc_id) WHERE NOT contaminated),
mixed AS MATERIALIZED ({_over(MIX, "clean")}),
emitted AS (
  SELECT clean.* FROM clean JOIN mixed USING (doc_id), range(3) r(i) WHERE i < taken // size)
SELECT * FROM ({_over(SHARD, "emitted")})
"""
