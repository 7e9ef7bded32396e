"""Plan shape: one pass, no full outer join, pushdown and pruning."""

import re

import pytest
from conftest import SF_SMALL

from __spark_entry__ import queries


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _counts(spark, name):
    from ingestkit.session import scoped_conf
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(queries()[name](spark, SF_SMALL))
    reused = plan.count("ReusedExchange")
    return plan, (plan.count("FileScan"), plan.count("Exchange hash") - reused, len(re.findall(r"\w+Join[ (]", plan)))


@pytest.mark.parametrize(("name", "scans", "exchanges", "joins"), [
    # target, history (twice: its rows, the ends of those after the feed's first
    # date), two parts of the feed (twice: for that date); the feed's reduction and
    # the ends by key; the join with these and the one with the target
    ("scd2_full", 8, 5, 2),
    ("scd2_full_compat", 4, 2, 1),
    ("scd2_actions", 4, 2, 1),
    ("full_outer_compare", 2, 2, 1),
    ("merge_insert_only", 3, 2, 1),
    ("merge_insert_only_compat", 3, 2, 1),
    ("dedup_first", 1, 1, 0),
])
def test_number_of_scans_shuffles_and_joins(spark, name, scans, exchanges, joins):
    plan, found = _counts(spark, name)
    assert found[0] <= scans and found[1] <= exchanges and found[2] == joins, (found, plan)
    assert "InMemoryTableScan" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    if name.startswith("scd2_full"):
        assert plan.count("Generate inline") == 1


def test_partitioned_landing_is_pruned(spark):
    plan = _plan(queries()["merge_partitioned_landing"](spark, SF_SMALL))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "landing" in line)
    assert "PartitionFilters: [year_mon" in scan and "1996_01" in scan


def test_merge_pushes_the_window_into_both_scans(spark):
    plan = _plan(queries()["merge_insert_only"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("l_shipdate" in s and "PushedFilters: [IsNotNull(l_shipdate)" in s
                         for s in scans)
    # the target side reads only the key and bound columns
    assert any("ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate" in s
               for s in scans)


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(queries()["dedup_first"](spark, SF_SMALL))
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    assert plan.index("Exchange") < plan.rindex("Partial")
    assert partial >= 0


def test_csv_scan_is_pruned_to_used_columns(spark):
    plan = _plan(queries()["gsod_style_cast"](spark, SF_SMALL))
    scan = next(line for line in plan.splitlines() if "FileScan csv" in line)
    assert "ReadSchema: struct<event_id:string,ts:string,name:string,event_type:string,value:string>" in scan


def test_merge_window_prunes_a_date_partitioned_target(spark):
    import datetime as dt

    from ingestkit.operators.merge import merge_new_rows
    from ingestkit.session import scratch_dir, unique_table

    name = unique_table(spark, "ptarget")
    rows = [(k, dt.date(2019, 1 + (k % 3), 1 + k % 27)) for k in range(60)]
    spark.createDataFrame(rows, "k int, d date").write.partitionBy("d").format("parquet") \
        .option("path", scratch_dir(spark, "tbl")).saveAsTable(name)
    src = spark.createDataFrame(rows, "k int, d date")
    added = merge_new_rows(spark.table(name), src, ["k"], order_by=["d"], bound_column="d",
                           lower="2019-02-01", upper="2019-03-01")
    plan = added._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines()
                if "FileScan parquet" in line and name.split(".")[1] in line)
    assert "PartitionFilters: [isnotnull(d" in scan and "2019-02-01" in scan
    assert added.count() == 0


def test_scd2_generator_is_whole_stage_codegen(spark):
    from ingestkit.session import scoped_conf
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        df = queries()["scd2_full"](spark, SF_SMALL)
        text = df._jdf.queryExecution().executedPlan().toString()
    gen = next(line for line in text.splitlines() if "Generate inline" in line)
    assert "*(" in gen


def test_bucketed_dimension_is_not_shuffled(spark):
    from ingestkit.operators.cdc import scd2_apply
    from ingestkit.session import scoped_conf, scratch_dir, unique_table
    from ingestkit.sinks.tables import create_table
    from ingestkit.workloads.cdc import bronze_from_customer, silver_from_customer
    from ingestkit.workloads.common import table

    customer = table(spark, SF_SMALL, "customer")
    name = unique_table(spark, "dim_bucketed")
    create_table(silver_from_customer(customer), name, path=scratch_dir(spark, "tbl"),
                 bucket_by=(8, ["sk_id"]), empty=False)
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.shuffle.partitions": "8"}):
        out = scd2_apply(spark.table(name), bronze_from_customer(customer), feed="full",
                         as_of="2021-01-02", null_keys=False)
        plan = _plan(out)
    assert "Bucketed: true" in plan
    assert "hashpartitioning(sk_id#" not in plan
