"""Ranks of all rows in a total order, without a window over them.

Rows are dealt to range partitions of the sort keys (ties by an arrival number,
so that rows with equal keys spread too), sorted inside, and stored with
(partition, position).  A table with one row a partition gives the rows before
each; no task holds more than its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_IN_PARTITION = (1 << 33) - 1       # the low bits of monotonically_increasing_id


def ranked(df: DataFrame, keys: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with the 0-based rank of every row by ``keys`` (ascending, null
    first).  ``df`` should be stored already: it is read twice, once for the
    range bounds."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, "__arrival"]
    placed = df.withColumn("__arrival", F.monotonically_increasing_id()).repartitionByRange(parts, *order) \
        .sortWithinPartitions(*order).drop("__arrival").withColumns(
            {"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}).checkpoint()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range partition
    first = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")) \
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    return placed.join(F.broadcast(first), "__part").withColumn(name, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")
