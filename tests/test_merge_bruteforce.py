"""Insert-only merge against a plain-Python implementation."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import merge_insert_only as brute_merge
from ingestkit.operators.merge import merge_insert_only

SCHEMA = "k int, d date, v int"
LO, HI = dt.date(2019, 1, 1), dt.date(2019, 2, 1)
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                          st.one_of(st.none(), st.sampled_from(
                              [dt.date(2018, 12, 31), dt.date(2019, 1, 5), dt.date(2019, 1, 20),
                               dt.date(2019, 2, 1)])),
                          st.integers(0, 3)), max_size=8, unique=True)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, source=rows, mode=st.sampled_from(["default", "compat"]))
def test_random_merge(spark, target, source, mode):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    out = merge_insert_only(t, s, ["k"], order_by=["d"], tie_breakers=["v"], bound_column="d",
                            lower=LO.isoformat(), upper=HI.isoformat(), mode=mode)
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter(brute_merge(target, source, LO, HI, mode))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, source=rows)
def test_default_merge_is_idempotent(spark, target, source):
    kw = dict(order_by=["d"], tie_breakers=["v"], bound_column="d",
              lower=LO.isoformat(), upper=HI.isoformat())
    once = merge_insert_only(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA),
                             ["k"], **kw)
    once = spark.createDataFrame(once.collect(), SCHEMA)
    twice = merge_insert_only(once, spark.createDataFrame(source, SCHEMA), ["k"], **kw)
    assert Counter(tuple(r) for r in twice.collect()) == Counter(tuple(r) for r in once.collect())
