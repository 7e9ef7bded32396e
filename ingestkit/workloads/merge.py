"""De-duplication and insert-only merge workloads over ``lineitem``.

The merge target is an earlier load: every line shipped before
1996-07-01.  The source is the whole table; the merge window is the
calendar year 1996 on ``l_shipdate``; the natural key is
(``l_orderkey``, ``l_linenumber``), first by ship date, then part and
supplier as tie-breakers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ingestkit.operators.merge import dedup_first, merge_insert_only, merge_into_table, merge_new_rows
from ingestkit.session import scratch_dir, unique_table
from ingestkit.workloads.common import staging, table

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate"]
TIES = ["l_partkey", "l_suppkey"]
LOWER, UPPER = "1996-01-01", "1997-01-01"
LOADED_BEFORE = "1996-07-01"


def dedup_first_q(spark, sf_dir):
    return dedup_first(table(spark, sf_dir, "lineitem"), KEYS, ORDER, TIES)


def _merge(spark, sf_dir, mode):
    li = table(spark, sf_dir, "lineitem")
    target = li.where(F.col("l_shipdate") < F.lit(LOADED_BEFORE).cast("date"))
    return merge_insert_only(target, li, KEYS, order_by=ORDER, tie_breakers=TIES,
                             bound_column="l_shipdate", lower=LOWER, upper=UPPER, mode=mode)


def merge_insert_only_q(spark, sf_dir):
    return _merge(spark, sf_dir, "default")


def merge_insert_only_compat_q(spark, sf_dir):
    return _merge(spark, sf_dir, "compat")


def merge_into_table_q(spark, sf_dir):
    # the earlier load as a table; the same merge twice (second adds nothing)
    li = table(spark, sf_dir, "lineitem")
    name = unique_table(spark, "lineitem_tgt")
    with staging():
        (li.where(F.col("l_shipdate") < F.lit(LOADED_BEFORE).cast("date"))
           .write.format("parquet").option("path", scratch_dir(spark, "tbl-lineitem-tgt"))
           .saveAsTable(name))
    for _ in range(2):
        merge_into_table(name, li, KEYS, order_by=ORDER, tie_breakers=TIES,
                         bound_column="l_shipdate", lower=LOWER, upper=UPPER)
    return spark.table(name)


LISTED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def merge_column_list(spark, sf_dir):
    # an insert column list: the other columns are null in inserted rows only
    li = table(spark, sf_dir, "lineitem")
    target = li.where(F.col("l_shipdate") < F.lit(LOADED_BEFORE).cast("date"))
    return merge_insert_only(target, li, KEYS, order_by=ORDER, tie_breakers=TIES, columns=LISTED,
                             bound_column="l_shipdate", lower=LOWER, upper=UPPER)


LANDED_MONTHS = ["1996_01", "1996_02", "1996_03"]
LANDED_BEFORE = "1996-02-15"


def merge_partitioned_landing(spark, sf_dir):
    # the source is a landing table partitioned by month, of which the merge
    # reads some months; the target is an earlier load, the lines shipped before
    # the middle of February
    li = table(spark, sf_dir, "lineitem")
    name = unique_table(spark, "landing")
    with staging():
        (li.withColumn("year_mon", F.date_format("l_shipdate", "yyyy_MM")).write.partitionBy("year_mon")
           .format("parquet").option("path", scratch_dir(spark, "tbl-landing")).saveAsTable(name))
    target = li.where(F.col("l_shipdate") < F.lit(LANDED_BEFORE).cast("date"))
    landed = spark.table(name).where(F.col("year_mon").isin(LANDED_MONTHS)).drop("year_mon")
    return merge_insert_only(target, landed, KEYS, order_by=ORDER, tie_breakers=TIES)


def merge_runtime_pruned(spark, sf_dir):
    # the target is partitioned by month, which is a merge key; a few landed
    # months prune it by their months and a filter of their keys
    li = table(spark, sf_dir, "lineitem").withColumn("year_mon", F.date_format("l_shipdate", "yyyy_MM"))
    name = unique_table(spark, "by_month")
    with staging():
        (li.where(F.col("l_shipdate") < F.lit(LANDED_BEFORE).cast("date")).write.partitionBy("year_mon")
           .format("parquet").option("path", scratch_dir(spark, "tbl-by-month")).saveAsTable(name))
    landed = li.where(F.col("year_mon").isin(LANDED_MONTHS))
    return merge_new_rows(spark.table(name), landed, [*KEYS, "year_mon"], order_by=ORDER, tie_breakers=TIES,
                          partition_keys=["year_mon"], key_filter=True)


QUERIES = {
    "merge_runtime_pruned": merge_runtime_pruned,
    "merge_column_list": merge_column_list,
    "merge_partitioned_landing": merge_partitioned_landing,
    "merge_into_table": merge_into_table_q,
    "dedup_first": dedup_first_q,
    "merge_insert_only": merge_insert_only_q,
    "merge_insert_only_compat": merge_insert_only_compat_q,
}

_DEDUP = """
SELECT * EXCLUDE (row_num) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey) AS row_num
  FROM lineitem {where}) WHERE row_num = 1"""

_TGT = f"tgt AS (SELECT * FROM lineitem WHERE l_shipdate < DATE '{LOADED_BEFORE}')"
_WIN = "{a}.l_shipdate >= DATE '" + LOWER + "' AND {a}.l_shipdate < DATE '" + UPPER + "'"

_DEFAULT_MERGE = f"""
WITH {_TGT},
src AS ({_DEDUP.format(where="WHERE " + _WIN.format(a="lineitem"))})
SELECT * FROM tgt
UNION ALL
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE {_WIN.format(a="tgt")}
    AND tgt.l_orderkey IS NOT DISTINCT FROM src.l_orderkey
    AND tgt.l_linenumber IS NOT DISTINCT FROM src.l_linenumber)
"""

_MISSING = ", ".join(f"NULL AS {c}" for c in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))

ORACLE = {
    "merge_runtime_pruned": f"""
WITH li AS (SELECT *, strftime(l_shipdate, '%Y_%m') AS year_mon FROM lineitem),
src AS (
  SELECT * FROM li WHERE year_mon IN ('1996_01', '1996_02', '1996_03')
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, year_mon ORDER BY l_shipdate, l_partkey, l_suppkey) = 1)
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM li WHERE li.l_shipdate < DATE '{LANDED_BEFORE}' AND li.l_orderkey = src.l_orderkey
    AND li.l_linenumber = src.l_linenumber AND li.year_mon = src.year_mon)
""",
    "merge_column_list": f"""
WITH {_TGT},
src AS ({_DEDUP.format(where="WHERE " + _WIN.format(a="lineitem"))})
SELECT * FROM tgt
UNION ALL BY NAME
SELECT {", ".join(LISTED)}, {_MISSING} FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE {_WIN.format(a="tgt")}
    AND tgt.l_orderkey = src.l_orderkey AND tgt.l_linenumber = src.l_linenumber)
""",
    "merge_partitioned_landing": f"""
WITH tgt AS (SELECT * FROM lineitem WHERE l_shipdate < DATE '{LANDED_BEFORE}'),
src AS ({_DEDUP.format(where="WHERE strftime(l_shipdate, '%Y_%m') IN ('1996_01', '1996_02', '1996_03')")})
SELECT * FROM tgt
UNION ALL
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.l_orderkey IS NOT DISTINCT FROM src.l_orderkey
    AND tgt.l_linenumber IS NOT DISTINCT FROM src.l_linenumber)
""",
    "dedup_first": _DEDUP.format(where=""),
    "merge_into_table": _DEFAULT_MERGE,
    "merge_insert_only": _DEFAULT_MERGE,
    "merge_insert_only_compat": f"""
WITH {_TGT},
src AS ({_DEDUP.format(where="")})
SELECT * FROM tgt
UNION ALL
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.l_orderkey = src.l_orderkey
    AND tgt.l_linenumber = src.l_linenumber
    AND {_WIN.format(a="tgt")} AND {_WIN.format(a="src")})
""",
}
