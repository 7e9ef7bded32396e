"""Load reconciliation by content.

A multiset of rows has an order-free fingerprint: the number of rows and the sums
of two 64-bit hashes of each row (nulls hashed with their place, so that they do
not vanish).  The load's own fingerprint is an ``observe`` metric of the write;
the rows that reached the table are read back from the files that the write
added, so the rest of the table is not touched.  Only if the two differ is the
source read again, to name the partitions where they do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestkit.sinks.tables import _describe, _partition_columns, append_partitioned, append_table

_WIDE = "decimal(38,0)"
_MARKS = ("n_rows", "sum_a", "sum_b")


def row_hashes(schema: T.StructType) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; columns in the order of their names."""
    values = []
    for f in sorted(schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        hashable = not any(k in f.dataType.simpleString() for k in ("map<", "variant"))
        values += [c if hashable else F.to_json(c), c.isNull()]
    return F.xxhash64(F.lit(11), *values), F.xxhash64(F.lit(29), *values)


def fingerprint(schema: T.StructType) -> list[Column]:
    a, b = row_hashes(schema)
    return [F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast(_WIDE).alias(n)
                                                  for h, n in ((a, "sum_a"), (b, "sum_b"))]]


def _by_partition(df: DataFrame, schema: T.StructType, parts: list[str]) -> DataFrame:
    return df.groupBy(*parts).agg(*fingerprint(schema))


def compare_content(source: DataFrame, loaded: DataFrame, parts: list[str]) -> DataFrame:
    """Per partition value: source_rows, loaded_rows and equal (the same
    multiset of rows on both sides).  Both frames have the same columns."""
    schema = loaded.schema
    left = _by_partition(source.select(*loaded.columns), schema, parts)
    right = _by_partition(loaded, schema, parts)
    right = right.select(*[F.col(p).alias(f"__{p}") for p in parts], *[F.col(m).alias(f"__{m}") for m in _MARKS])
    if not parts:
        joined = left.join(right)                       # one row on either side
    else:
        joined = left.join(right, reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts]), "full")
    same = reduce(lambda x, y: x & y, [F.col(m).eqNullSafe(F.col(f"__{m}")) for m in _MARKS])
    mine = F.col("n_rows").isNotNull()
    return joined.select(*[F.when(mine, F.col(p)).otherwise(F.col(f"__{p}")).alias(p) for p in parts],
                         F.coalesce("n_rows", F.lit(0)).cast("long").alias("source_rows"),
                         F.coalesce("__n_rows", F.lit(0)).cast("long").alias("loaded_rows"), same.alias("equal"))


def append_with_content_check(df: DataFrame, name: str, partition_cols: list[str] | None = None) -> DataFrame:
    """Append to a file table and compare what was written with the source.

    Returns one row per partition that the load wrote to (one row for a table
    without partitions): the partition columns, source_rows, loaded_rows, equal.
    An empty load gives no rows, or one row of zeros without partitions.
    """
    spark = df.sparkSession
    parts = partition_cols or _partition_columns(spark, name)
    schema, provider = spark.table(name).schema, _describe(spark, name)
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    before = set(spark.table(name).inputFiles())
    seen = Observation(f"content-{abs(hash(name))}")
    observed = df.observe(seen, *fingerprint(schema))
    if parts:
        append_partitioned(observed, name, parts)
    else:
        append_table(observed, name)
    spark.catalog.refreshTable(name)
    added = sorted(set(spark.table(name).inputFiles()) - before)
    loaded = _files_of(spark, name, provider, added, parts, schema)
    whole = _by_partition(loaded, schema, parts)
    total = whole.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast(_WIDE).alias(m) for m in _MARKS]).first()
    if all(int(total[m]) == int(seen.get[m]) for m in _MARKS):
        return whole.select(*parts, F.col("n_rows").alias("source_rows"), F.col("n_rows").alias("loaded_rows"), F.lit(True).alias("equal"))
    return compare_content(df, loaded, parts)


def _files_of(spark, name: str, info: dict[str, str], added: list[str], parts: list[str], schema: T.StructType) -> DataFrame:
    if not added:
        return spark.createDataFrame([], schema)
    provider = (info.get("Provider") or "parquet").lower()
    reader = spark.read.format(provider).schema(schema)
    if parts:
        reader = reader.option("basePath", info["Location"])
    return reader.load(added)
