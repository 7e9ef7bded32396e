"""SCD2 workloads over a dimension derived from ``customer``.

Fixture rule (the same in Spark and in the oracle SQL):

* silver (the dimension): every customer is current with
  ``attr = c_mktsegment`` (null when the balance is negative), valid
  2020-01-01 .. 9999-12-31; customers of nations 0-4 also carry an
  expired row ``attr = 'OLD'`` valid 2019-01-01 .. 2020-01-01.
* bronze (the feed, 2021-01-01): every customer except nation 24
  (deleted); nation 23 sends a null attribute, nations 20-22 a changed
  one (``c_mktsegment || '_X'``); customers of nation 0 also appear under
  a new key ``c_custkey + 1000000``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.operators.cdc import classify_changes, scd2_apply, scd2_view, scd2_write_back
from ingestkit.operators.history import collapse_versions, splice_changes
from ingestkit.session import scratch_dir, unique_table
from ingestkit.sinks.tables import create_table
from ingestkit.workloads.common import staging, table

AS_OF = "2021-01-02"


def silver_from_customer(customer: DataFrame) -> DataFrame:
    base = customer.select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    current = base.select(
        F.col("c_custkey").alias("sk_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("attr"),
        F.to_date(F.lit("2020-01-01")).alias("mod_dt"),
        F.lit("bronze_data").alias("data_src_cd"),
        F.lit(True).alias("is_current"),
        F.to_date(F.lit("2020-01-01")).alias("eff_start_dt"),
        F.to_date(F.lit("9999-12-31")).alias("eff_end_dt"))
    expired = base.where(F.col("c_nationkey") < 5).select(
        F.col("c_custkey").alias("sk_id"),
        F.lit("OLD").alias("attr"),
        F.to_date(F.lit("2019-01-01")).alias("mod_dt"),
        F.lit("bronze_data").alias("data_src_cd"),
        F.lit(False).alias("is_current"),
        F.to_date(F.lit("2019-01-01")).alias("eff_start_dt"),
        F.to_date(F.lit("2020-01-01")).alias("eff_end_dt"))
    return current.unionByName(expired)


def bronze_from_customer(customer: DataFrame) -> DataFrame:
    base = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    changed = base.where(F.col("c_nationkey") != 24).select(
        F.col("c_custkey").alias("src_id"),
        F.when(F.col("c_nationkey") == 23, F.lit(None))
         .when(F.col("c_nationkey").isin(20, 21, 22), F.concat(F.col("c_mktsegment"), F.lit("_X")))
         .otherwise(F.col("c_mktsegment")).alias("src_attr"),
        F.to_date(F.lit("2021-01-01")).alias("src_mod_dt"))
    new = base.where(F.col("c_nationkey") == 0).select(
        (F.col("c_custkey") + 1000000).alias("src_id"),
        F.col("c_mktsegment").alias("src_attr"),
        F.to_date(F.lit("2021-01-01")).alias("src_mod_dt"))
    return changed.unionByName(new)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    return silver_from_customer(customer), bronze_from_customer(customer)


def scd2_actions(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return classify_changes(silver, bronze, mode="compat")


def scd2_full(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return scd2_apply(silver, bronze, feed="full", as_of=AS_OF)


def scd2_delta(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return scd2_apply(silver, bronze, feed="delta", as_of=AS_OF)


def scd2_full_compat(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return scd2_apply(silver, bronze, feed="full", mode="compat")


def scd2_delta_compat(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return scd2_apply(silver, bronze, feed="delta", mode="compat")


def scd2_full_sorted(spark, sf_dir):
    silver, bronze = _inputs(spark, sf_dir)
    return scd2_apply(silver, bronze, feed="full", as_of=AS_OF, order_by_key=True)


def _marked_feed(customer: DataFrame, mark: str) -> DataFrame:
    return customer.where("c_nationkey = 21").select(
        F.col("c_custkey").alias("src_id"), F.concat("c_mktsegment", F.lit(mark)).alias("src_attr"),
        F.to_date(F.lit("2021-01-01")).alias("src_mod_dt"))


BEFORE = "2020-06-01"


def scd2_table_write_back(spark, sf_dir):
    # the dimension as a table that keeps current and closed rows apart: the full
    # feed twice (the second run changes nothing), two more feeds of the same date
    # for nation 21, then a full feed without the nations 2 and 21 as of a day
    # before nation 21's versions began
    customer = table(spark, sf_dir, "customer")
    silver, bronze = _inputs(spark, sf_dir)
    name = unique_table(spark, "dim_customer")
    with staging():
        create_table(silver, name, path=scratch_dir(spark, "tbl-dim"), partition_by=["is_current"], empty=False)
    for _ in range(2):
        scd2_write_back(name, bronze, feed="full", as_of=AS_OF)
    for mark in ("_B", "_C"):
        scd2_write_back(name, _marked_feed(customer, mark), feed="delta", as_of=AS_OF)
    rest = bronze_from_customer(customer.where("c_nationkey not in (2, 21)"))
    scd2_write_back(name, rest, feed="full", as_of=BEFORE)
    return spark.table(name)


def _order_changes(spark, sf_dir) -> DataFrame:
    """Every order is a change of its customer: several a key, on both sides of
    the dimension's dates."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("src_id"), F.col("o_orderpriority").alias("src_attr"),
        F.col("o_orderdate").cast("date").alias("src_mod_dt"))


def _long_silver(customer: DataFrame) -> DataFrame:
    """Versions inside the orders' years: [1993, 1995) for nations 0-4, from 1995
    on for all, closed in 1997 for nations 10-12."""
    def rows(where: str, attr, start: str, end: str) -> DataFrame:
        day = F.to_date(F.lit(start))
        return customer.where(where).select(
            F.col("c_custkey").alias("sk_id"), attr.alias("attr"), day.alias("mod_dt"), F.lit("silver_data").alias("data_src_cd"),
            F.lit(end == "9999-12-31").alias("is_current"), day.alias("eff_start_dt"), F.to_date(F.lit(end)).alias("eff_end_dt"))
    segment = F.col("c_mktsegment")
    return rows("c_nationkey < 5", F.lit("OLD"), "1993-01-01", "1995-01-01") \
        .unionByName(rows("c_nationkey not between 10 and 12", segment, "1995-01-01", "9999-12-31")) \
        .unionByName(rows("c_nationkey between 10 and 12", segment, "1995-01-01", "1997-01-01"))


def scd2_late_changes(spark, sf_dir):
    # late and repeated arrivals: the changes of odd years first, then all
    dim, changes = _long_silver(table(spark, sf_dir, "customer")), _order_changes(spark, sf_dir)
    early = splice_changes(dim, changes.where("year(src_mod_dt) % 2 = 1"))
    return splice_changes(early, changes)


def scd2_changes_collapsed(spark, sf_dir):
    dim = _long_silver(table(spark, sf_dir, "customer"))
    return collapse_versions(splice_changes(dim, _order_changes(spark, sf_dir)))


def scd2_view_over_tables(spark, sf_dir):
    # dimension and feed as catalog tables, the result as a view read by SQL
    silver, bronze = _inputs(spark, sf_dir)
    dim, feed = unique_table(spark, "dim_view"), unique_table(spark, "feed_view")
    with staging():
        create_table(silver, dim, path=scratch_dir(spark, "tbl-dim-view"), empty=False)
        create_table(bronze, feed, path=scratch_dir(spark, "tbl-feed-view"), empty=False)
    scd2_view(dim, feed, view="merged_dim", feed="full", as_of=AS_OF)
    return spark.sql("""SELECT is_current, eff_end_dt, count(*) AS n, count(attr) AS n_attr,
                               min(sk_id) AS first_key, max(sk_id) AS last_key
                        FROM merged_dim GROUP BY is_current, eff_end_dt""")


QUERIES = {
    "scd2_actions": scd2_actions,
    "scd2_table_write_back": scd2_table_write_back,
    "scd2_view_over_tables": scd2_view_over_tables,
    "scd2_full": scd2_full,
    "scd2_full_sorted": scd2_full_sorted,
    "scd2_full_compat": scd2_full_compat,
    "scd2_delta": scd2_delta,
    "scd2_delta_compat": scd2_delta_compat,
    "scd2_late_changes": scd2_late_changes,
    "scd2_changes_collapsed": scd2_changes_collapsed,
}

_FIXTURE_SQL = """
silver AS (
  SELECT c_custkey AS sk_id,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS attr,
         DATE '2020-01-01' AS mod_dt, 'bronze_data' AS data_src_cd, TRUE AS is_current,
         DATE '2020-01-01' AS eff_start_dt, DATE '9999-12-31' AS eff_end_dt
  FROM customer
  UNION ALL
  SELECT c_custkey, 'OLD', DATE '2019-01-01', 'bronze_data', FALSE,
         DATE '2019-01-01', DATE '2020-01-01'
  FROM customer WHERE c_nationkey < 5
),
bronze AS (
  SELECT c_custkey AS src_id,
         CASE WHEN c_nationkey = 23 THEN NULL
              WHEN c_nationkey IN (20, 21, 22) THEN c_mktsegment || '_X'
              ELSE c_mktsegment END AS src_attr,
         DATE '2021-01-01' AS src_mod_dt
  FROM customer WHERE c_nationkey <> 24
  UNION ALL
  SELECT c_custkey + 1000000, c_mktsegment, DATE '2021-01-01'
  FROM customer WHERE c_nationkey = 0
)"""

_COMPAT_ENRICHED = """,
enriched AS (
  SELECT *,
         CASE WHEN attr <> src_attr THEN 'UPSERT'
              WHEN src_attr IS NULL AND is_current THEN 'DELETE'
              WHEN sk_id IS NULL THEN 'INSERT'
              ELSE 'NOACTION' END AS action
  FROM silver FULL OUTER JOIN bronze ON sk_id = src_id
)"""

_COMPAT_RESULT = "WITH" + _FIXTURE_SQL + _COMPAT_ENRICHED + """
SELECT sk_id, attr, mod_dt, data_src_cd, is_current, eff_start_dt, eff_end_dt
FROM enriched WHERE action = 'NOACTION'
UNION ALL
SELECT src_id, src_attr, src_mod_dt, 'bronze_data', TRUE, src_mod_dt, DATE '9999-12-31'
FROM enriched WHERE action = 'INSERT'
UNION ALL
SELECT sk_id, attr, mod_dt, data_src_cd, FALSE, eff_start_dt, src_mod_dt
FROM enriched WHERE action = 'UPSERT'
UNION ALL
SELECT sk_id, src_attr, src_mod_dt, data_src_cd, TRUE, src_mod_dt, eff_end_dt
FROM enriched WHERE action = 'UPSERT'
"""


def _default_result(feed: str) -> str:
    absent = ("SELECT sk_id, attr, mod_dt, data_src_cd, FALSE, eff_start_dt, DATE '" + AS_OF + "'"
              if feed == "full" else
              "SELECT sk_id, attr, mod_dt, data_src_cd, is_current, eff_start_dt, eff_end_dt")
    return "WITH" + _FIXTURE_SQL + """,
cur AS (SELECT * FROM silver WHERE coalesce(is_current, FALSE)),
hist AS (SELECT * FROM silver WHERE NOT coalesce(is_current, FALSE)),
j AS (SELECT * FROM cur FULL OUTER JOIN bronze ON sk_id = src_id)
SELECT sk_id, attr, mod_dt, data_src_cd, is_current, eff_start_dt, eff_end_dt FROM hist
UNION ALL
SELECT sk_id, attr, mod_dt, data_src_cd, is_current, eff_start_dt, eff_end_dt
FROM j WHERE sk_id IS NOT NULL AND src_id IS NOT NULL AND attr IS NOT DISTINCT FROM src_attr
UNION ALL
SELECT sk_id, attr, mod_dt, data_src_cd, FALSE, eff_start_dt, src_mod_dt
FROM j WHERE sk_id IS NOT NULL AND src_id IS NOT NULL AND attr IS DISTINCT FROM src_attr
UNION ALL
SELECT sk_id, src_attr, src_mod_dt, data_src_cd, TRUE, src_mod_dt, DATE '9999-12-31'
FROM j WHERE sk_id IS NOT NULL AND src_id IS NOT NULL AND attr IS DISTINCT FROM src_attr
UNION ALL
SELECT src_id, src_attr, src_mod_dt, 'bronze_data', TRUE, src_mod_dt, DATE '9999-12-31'
FROM j WHERE sk_id IS NULL
UNION ALL
""" + absent + """
FROM j WHERE src_id IS NULL
"""


ORACLE = {
    "scd2_actions": "WITH" + _FIXTURE_SQL + _COMPAT_ENRICHED + """
SELECT sk_id, attr, mod_dt, data_src_cd, is_current, eff_start_dt, eff_end_dt,
       src_id, src_attr, src_mod_dt, action
FROM enriched
""",
    "scd2_full": _default_result("full"),
    "scd2_full_sorted": _default_result("full"),
    "scd2_full_compat": _COMPAT_RESULT,
    "scd2_delta": _default_result("delta"),
    "scd2_delta_compat": _COMPAT_RESULT,
}

ORACLE["scd2_view_over_tables"] = f"""
SELECT is_current, eff_end_dt, count(*) AS n, count(attr) AS n_attr, min(sk_id) AS first_key, max(sk_id) AS last_key
FROM ({_default_result("full")}) GROUP BY is_current, eff_end_dt
"""


def _step(name: str, before: str, feed: str, kind: str, as_of: str) -> str:
    """One default-mode application as a CTE."""
    closed = f"CASE WHEN eff_start_dt > DATE '{as_of}' THEN eff_end_dt ELSE DATE '{as_of}' END" if kind == "full" else "eff_end_dt"
    stays = f"eff_start_dt > DATE '{as_of}'" if kind == "full" else "TRUE"
    return f"""
{name} AS (
  SELECT * FROM {before} WHERE NOT is_current
  UNION ALL SELECT t.* FROM {before} t JOIN {feed} ON sk_id = src_id
  WHERE is_current AND (attr IS NOT DISTINCT FROM src_attr OR src_mod_dt < eff_start_dt)
  UNION ALL SELECT sk_id, attr, mod_dt, data_src_cd, FALSE, eff_start_dt, src_mod_dt FROM {before} JOIN {feed} ON sk_id = src_id
  WHERE is_current AND attr IS DISTINCT FROM src_attr AND src_mod_dt >= eff_start_dt
  UNION ALL SELECT sk_id, src_attr, src_mod_dt, data_src_cd, TRUE, src_mod_dt, DATE '9999-12-31' FROM {before} JOIN {feed} ON sk_id = src_id
  WHERE is_current AND attr IS DISTINCT FROM src_attr AND src_mod_dt >= eff_start_dt
  UNION ALL SELECT sk_id, attr, mod_dt, data_src_cd, {stays}, eff_start_dt, {closed} FROM {before}
  WHERE is_current AND sk_id NOT IN (SELECT src_id FROM {feed})
  UNION ALL SELECT src_id, src_attr, src_mod_dt, 'bronze_data', TRUE, src_mod_dt, DATE '9999-12-31' FROM {feed}
  WHERE src_id NOT IN (SELECT sk_id FROM {before} WHERE is_current OR eff_end_dt > src_mod_dt))"""


ORACLE["scd2_table_write_back"] = "WITH" + _FIXTURE_SQL + """,
feed_b AS (SELECT c_custkey AS src_id, c_mktsegment || '_B' AS src_attr, DATE '2021-01-01' AS src_mod_dt FROM customer WHERE c_nationkey = 21),
feed_c AS (SELECT c_custkey AS src_id, c_mktsegment || '_C' AS src_attr, DATE '2021-01-01' AS src_mod_dt FROM customer WHERE c_nationkey = 21),
feed_d AS (SELECT bronze.* FROM bronze JOIN customer ON c_custkey = src_id % 1000000 WHERE c_nationkey NOT IN (2, 21)),
""" + ",".join([_step("s1", "silver", "bronze", "full", AS_OF), _step("s2", "s1", "feed_b", "delta", AS_OF),
                _step("s3", "s2", "feed_c", "delta", AS_OF), _step("s4", "s3", "feed_d", "full", BEFORE)]) + " SELECT * FROM s4"

_TIMELINE = """
WITH dim AS (
  SELECT c_custkey AS sk_id, 'OLD' AS attr, DATE '1993-01-01' AS eff_start_dt, DATE '1995-01-01' AS eff_end_dt FROM customer WHERE c_nationkey < 5
  UNION ALL SELECT c_custkey, c_mktsegment, DATE '1995-01-01', CASE WHEN c_nationkey BETWEEN 10 AND 12 THEN DATE '1997-01-01' ELSE DATE '9999-12-31' END
  FROM customer),
entries AS (
  SELECT sk_id, eff_start_dt AS d, attr, 'silver_data' AS code, 1 AS kind FROM dim
  UNION ALL SELECT sk_id, eff_end_dt, NULL, 'bronze_data', 0 FROM dim WHERE eff_end_dt < DATE '9999-12-31'
  UNION ALL SELECT DISTINCT o_custkey, o_orderdate::DATE, o_orderpriority, NULL, 1 FROM orders),
one AS (
  SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY sk_id, d, kind ORDER BY attr DESC NULLS LAST, code NULLS LAST) = 1),
line AS (
  SELECT *, lead(d) OVER (PARTITION BY sk_id ORDER BY d, kind) AS until,
         coalesce(last_value(code IGNORE NULLS) OVER (PARTITION BY sk_id ORDER BY d, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  'bronze_data') AS src FROM one),
versions AS (
  SELECT sk_id, attr, d AS mod_dt, src AS data_src_cd, until IS NULL AS is_current, d AS eff_start_dt,
         coalesce(until, DATE '9999-12-31') AS eff_end_dt FROM line WHERE kind = 1)"""

ORACLE["scd2_late_changes"] = _TIMELINE + " SELECT * FROM versions"
ORACLE["scd2_changes_collapsed"] = _TIMELINE + """,
islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY sk_id ORDER BY eff_start_dt) AS island FROM (
    SELECT *, CASE WHEN lag(eff_end_dt) OVER w IS NOT DISTINCT FROM eff_start_dt AND lag(attr) OVER w IS NOT DISTINCT FROM attr
                   THEN 0 ELSE 1 END AS fresh FROM versions WINDOW w AS (PARTITION BY sk_id ORDER BY eff_start_dt)))
SELECT sk_id, any_value(attr) AS attr, min(mod_dt) AS mod_dt, arg_min(data_src_cd, eff_start_dt) AS data_src_cd, bool_or(is_current) AS is_current,
       min(eff_start_dt) AS eff_start_dt, max(eff_end_dt) AS eff_end_dt FROM islands GROUP BY sk_id, island
"""
