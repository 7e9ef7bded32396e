"""Exact de-duplication by content hash, with the bytes compared.

Texts are equal when they are identical after every run of ASCII white space
became one space.  Rows are grouped by the 128-bit hash of that normalised
text; the row with the smallest id stays.  Inside the groups of more than one
row the texts themselves are compared, so that a hash that two different texts
share makes two groups, not a loss.

Plan: one narrow pass turns every text into its hash, digest and a row number
(stored, so that the numbers hold when an executor is lost); groups are
counted with map-side combine, so a group that holds a third of all rows sends
one row a task; a second pass over the texts compares the bytes: equal
(hash, text) rows are combined in their own task before they are shuffled, and a
hash left with two texts is a collision.  Only texts whose hash occurs twice
take part: their hashes are broadcast as 64-bit numbers after a count; beyond
``max_filter_keys`` of them all texts take part, with the same result.  The join
back to the rows has a row for every hash on one side, and the rows of a hot
hash can be split by AQE on the other.

Cases: null text equals the empty text; a text of white space only equals one
space; ids that are null come last (the group's keep_id is null only if all
are); rows that repeat an id and a text are copies of which one stays; very
long texts are hashed whole; an empty table gives no rows; columns named in
``keep`` come along unless an output column has their name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.stage import Stage
from ingestkit.session import scratch_dir

BLANKS = r"[\x20\x09-\x0D]+"
MAX_FILTER_KEYS = 2_000_000
OUTPUT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")


def content_key(body: Column) -> Column:
    """The 128-bit key of a normalised text."""
    return F.unhex(F.md5(body))


def _least(row: str) -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(row).alias("row")))


def _marked(rows: DataFrame, groups: DataFrame, on: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """The rows with their group's survivor; a row without a group is alone."""
    alone = F.col("least").isNull()
    return rows.join(groups, list(on), "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("least.row") == F.col("__row"))).alias("kept"), "text_sha256", *carried)


def _grouped(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("group_size"), _least("__row").alias("least")).where("group_size > 1")


def exact_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = (),
                     key: Callable[[Column], Column] = content_key, max_filter_keys: int = MAX_FILTER_KEYS) -> DataFrame:
    """One row for every row of ``documents``: doc_id, keep_id, group_size,
    kept, text_sha256 and the columns of ``keep``."""
    stage = Stage(documents.sparkSession)
    carried = [c for c in keep if c not in OUTPUT]
    body = normalised(text)
    rows = stage(documents.select(F.col(doc_id).alias("doc_id"), *carried, key(body).alias("__key"), F.sha2(body, 256).alias("text_sha256"),
                                  F.monotonically_increasing_id().alias("__row")), "signed-rows")
    groups = stage(_grouped(rows, ["__key"]), "copy-groups")

    bodies = documents.select(key(body).alias("__key"), body.alias("__body"))
    if groups.count() <= max_filter_keys:
        bodies = bodies.join(F.broadcast(groups.select(F.xxhash64("__key").alias("__hash"))),
                             F.xxhash64("__key") == F.col("__hash"), "left_semi")
    texts = bodies.groupBy("__key", "__body").agg(F.lit(1).alias("__one"))
    collided = texts.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    collided = stage(collided, "collisions")
    if collided.isEmpty():
        return stage.finish(_marked(rows, groups, ["__key"], carried))

    shared = documents.select(F.col(doc_id).alias("doc_id"), *carried, key(body).alias("__key"), body.alias("__body"))
    shared = stage(shared.join(collided, "__key", "left_semi").withColumns(
        {"text_sha256": F.sha2("__body", 256), "__row": F.monotonically_increasing_id()}), "collided-rows")
    by_text = _marked(shared, _grouped(shared, ["__key", "__body"]), ["__key", "__body"], carried)
    return stage.finish(_marked(rows.join(collided, "__key", "left_anti"), groups, ["__key"], carried).unionByName(by_text))


def drop_copies(documents: DataFrame, *, max_broadcast_rows: int = MAX_FILTER_KEYS, **options) -> DataFrame:
    """The documents without the copies, all columns as they are: one row of
    each group of equal texts stays."""
    spark = documents.sparkSession
    path = scratch_dir(spark, "numbered-rows")
    documents.withColumn("__number", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    gone = exact_duplicates(rows, keep=["__number"], **options).where(~F.col("kept")).select("__number").checkpoint()
    if gone.count() <= max_broadcast_rows:
        gone = F.broadcast(gone)
    return rows.join(gone, "__number", "left_anti").select(*documents.columns)
