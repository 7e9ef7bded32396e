"""Both forms of the full outer join have the same rows."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ingestkit.operators.joins import full_outer_join, split_outer_join

side = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=side, right=side)
def test_same_rows_as_full_outer(spark, left, right):
    l_df = spark.createDataFrame(left, "lk int, lv int")
    r_df = spark.createDataFrame(right, "rk int, rv int")
    want = Counter(tuple(r) for r in l_df.join(r_df, l_df.lk == r_df.rk, "full").collect())
    for out in (full_outer_join(l_df, r_df, ["lk"], ["rk"]), split_outer_join(l_df, r_df, ["lk"], ["rk"]),
                full_outer_join(l_df, r_df, ["lk"], ["rk"], spread_null_keys=True)):
        assert Counter(tuple(r) for r in out.collect()) == want


def test_sides_are_read_and_shuffled_once(spark):
    from ingestkit.session import scoped_conf
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = full_outer_join(spark.range(10).selectExpr("id AS a"), spark.range(5).selectExpr("id AS b"), ["a"], ["b"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 2 and plan.count("Exchange hash") == 2 and plan.count("Join") == 1


def test_key_lists_are_checked(spark):
    with pytest.raises(ValueError):
        full_outer_join(spark.range(1), spark.range(1), ["id"])


def test_small_feed_never_shuffles_the_large_side(spark):
    from ingestkit.session import scoped_conf, scratch_dir
    big, small = scratch_dir(spark, "big"), scratch_dir(spark, "small")
    spark.range(200000).selectExpr("id AS k", "id * 3 AS v").write.parquet(big)
    spark.range(0, 400000, 8000).selectExpr("id AS rk", "id AS rv").write.parquet(small)
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": str(64 * 1024)}):
        out = split_outer_join(spark.read.parquet(big), spark.read.parquet(small), ["k"], ["rk"])
        n = out.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert n == 200000 + 25
    assert "hashpartitioning(k#" not in plan and "hashpartitioning(__lk0" not in plan


def test_self_join_of_one_lineage(spark):
    df = spark.range(20).selectExpr("id AS k", "id % 4 AS g", "id * 2 AS v")
    left = df.select("k", "v")
    right = df.where("g = 0").select(df.k.alias("k2"), df.v.alias("v2"))
    got = Counter(tuple(r) for r in full_outer_join(left, right, ["k"], ["k2"]).collect())
    want = Counter(tuple(r) for r in left.join(right, left.k == right.k2, "full").collect())
    assert got == want


side2 = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 1),
                           st.integers(0, 9)), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=side2, right=side2)
def test_composite_keys(spark, left, right):
    l_df = spark.createDataFrame(left, "a int, b int, lv int")
    r_df = spark.createDataFrame(right, "c int, d int, rv int")
    got = Counter(tuple(r) for r in full_outer_join(l_df, r_df, ["a", "b"], ["c", "d"]).collect())
    cond = (l_df.a == r_df.c) & (l_df.b == r_df.d)
    want = Counter(tuple(r) for r in l_df.join(r_df, cond, "full").collect())
    assert got == want
