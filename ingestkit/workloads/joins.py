"""Full outer comparison of all ``orders`` with all customers.

The customers of nations 20-24 come under another key (an offset), so orders
without a customer and customers without orders both occur.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ingestkit.operators.joins import full_outer_join, spread_outer_join
from ingestkit.workloads.common import table

OFFSET = 10_000_000


def full_outer_compare(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    moved = F.when(F.col("c_nationkey") >= 20, F.col("c_custkey") + OFFSET).otherwise(F.col("c_custkey"))
    customer = table(spark, sf_dir, "customer").select(moved.alias("c_custkey"), "c_mktsegment")
    return full_outer_join(orders, customer, ["o_custkey"], ["c_custkey"])


def spread_outer_compare(spark, sf_dir):
    # a third of all orders under one customer, which the join spreads
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")).cast("long").alias("o_custkey"), "o_totalprice")
    moved = F.when(F.col("c_nationkey") >= 20, F.col("c_custkey") + OFFSET).otherwise(F.col("c_custkey"))
    customer = table(spark, sf_dir, "customer").select(moved.cast("long").alias("c_custkey"), "c_mktsegment")
    return spread_outer_join(orders, customer, ["o_custkey"], ["c_custkey"])


QUERIES = {"full_outer_compare": full_outer_compare, "spread_outer_compare": spread_outer_compare}

def _compare(orders: str) -> str:
    return f"""
SELECT o_orderkey, o_custkey, o_totalprice, c.c_custkey, c_mktsegment
FROM {orders} o
FULL OUTER JOIN (
  SELECT CASE WHEN c_nationkey >= 20 THEN c_custkey + {OFFSET} ELSE c_custkey END AS c_custkey, c_mktsegment
  FROM customer) c
  ON o_custkey = c.c_custkey
"""


ORACLE = {
    "full_outer_compare": _compare("orders"),
    "spread_outer_compare": _compare("""(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
  o_totalprice FROM orders)"""),
}
