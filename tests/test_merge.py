"""Insert-only merge matrix (FIXTURES F7) and dedup determinism."""

import datetime as dt

import pytest

from ingestkit.operators.merge import dedup_first, merge_insert_only

D = dt.date
SCHEMA = "k int, d date"


def _run(spark, target, source, mode):
    return merge_insert_only(target, source, ["k", "d"], order_by=["d"], bound_column="d",
                             lower="2019-01-01", mode=mode)


def _keys(df):
    return sorted(((r.k is None, r.k or 0), r.d) for r in df.collect())


def test_merge_matrix(spark):
    tgt = spark.createDataFrame([(1, D(2019, 1, 5)), (9, D(2018, 12, 31))], SCHEMA)
    src = spark.createDataFrame([(1, D(2019, 1, 5)), (2, D(2019, 1, 6)), (9, D(2018, 12, 31)),
                                 (None, D(2019, 1, 7))], SCHEMA)
    # compat: 9 (outside the window) and the null key come in on every run
    once = _run(spark, tgt, src, "compat")
    assert once.count() == 5
    once = spark.createDataFrame(once.collect(), SCHEMA)
    assert _run(spark, once, src, "compat").count() == 7
    # default: first run adds 2 and the null key, second run adds nothing
    once = _run(spark, tgt, src, "default")
    assert once.count() == 4
    once = spark.createDataFrame(once.collect(), SCHEMA)
    assert _keys(_run(spark, once, src, "default")) == _keys(once)


def test_dedup_keeps_first_by_order_then_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, 1, "x")],
                               "k int, o int, t string")
    got = sorted(tuple(r) for r in dedup_first(df, ["k"], ["o"], ["t"]).collect())
    assert got == [(1, 3, "z"), (2, 1, "x")]


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    plan = dedup_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_needs_an_order(spark):
    df = spark.createDataFrame([(1, D(2019, 1, 5))], SCHEMA)
    with pytest.raises(ValueError):
        merge_insert_only(df, df, ["k"], order_by=[])


def test_unlisted_columns_are_null_in_inserted_rows_only(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0)], "k int, s string, x double")
    src = spark.createDataFrame([(1, "b", 2.0), (2, "c", 3.0)], "k int, s string, x double")
    out = merge_insert_only(tgt, src, ["k"], order_by=["x"], columns=["k", "x"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1.0), (2, None, 3.0)]
