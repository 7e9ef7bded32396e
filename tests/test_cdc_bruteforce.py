"""SCD2 against plain-Python implementations: random fixtures and a hot key."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import H, scd2_compat, scd2_default
from ingestkit.operators.cdc import scd2_apply

TGT = ("sk_id long, attr string, mod_dt date, data_src_cd string, is_current boolean, "
       "eff_start_dt date, eff_end_dt date")
STG = "src_id long, src_attr string, src_mod_dt date"
D = [dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2021, 6, 1)]
AS_OF = dt.date(2022, 1, 1)
# feed dates, starts, ends and the close date all fall in one range
DAYS = [dt.date(2021, m, 1) for m in range(1, 7)]

keys = st.one_of(st.none(), st.integers(0, 4))
attrs = st.sampled_from([None, "a", "b"])
target_rows = st.lists(st.tuples(keys, attrs, st.sampled_from(D[:1]), st.just("src"),
                                 st.sampled_from([True, False, None]),
                                 st.sampled_from(D[:1]), st.just(H)), max_size=8)
staging_rows = st.lists(st.tuples(keys, attrs, st.sampled_from(D[1:])), max_size=6)


def _norm(rows):
    return Counter(tuple(r) for r in rows)


def _spark_rows(df):
    return [tuple(r) for r in df.select("sk_id", "attr", "mod_dt", "data_src_cd", "is_current",
                                         "eff_start_dt", "eff_end_dt").collect()]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=target_rows, staging=staging_rows, feed=st.sampled_from(["full", "delta"]))
def test_random_fixtures(spark, target, staging, feed):
    t = spark.createDataFrame(target, TGT)
    s = spark.createDataFrame(staging, STG)
    got = _spark_rows(scd2_apply(t, s, feed=feed, mode="compat"))
    assert _norm(got) == _norm(scd2_compat(target, staging))
    got = _spark_rows(scd2_apply(t, s, feed=feed, as_of=AS_OF.isoformat()))
    assert _norm(got) == _norm(scd2_default(target, staging, feed, AS_OF))


def test_hot_key(spark):
    # a third of all target rows (history) and of the feed sit on key 7
    n = 3000
    target = [(7 if i % 3 == 0 else i, "h", D[0], "src", False, D[0], D[0]) for i in range(n)]
    target += [(k, "a", D[0], "src", True, D[0], H) for k in range(1, n, 3)]
    staging = [(7 if i % 3 == 0 else i, "b" if i % 2 else "a", D[1]) for i in range(n)]
    t = spark.createDataFrame(target, TGT)
    s = spark.createDataFrame(staging, STG)
    got = _spark_rows(scd2_apply(t, s, feed="full", as_of=AS_OF.isoformat()))
    assert _norm(got) == _norm(scd2_default(target, staging, "full", AS_OF))
    got = _spark_rows(scd2_apply(t, s, feed="full", mode="compat"))
    assert _norm(got) == _norm(scd2_compat(target, staging))


valid_dims = st.dictionaries(st.integers(0, 6), st.tuples(attrs, st.booleans()), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(dim=valid_dims, staging=staging_rows, feed=st.sampled_from(["full", "delta"]))
def test_invariants_on_a_valid_dimension(spark, dim, staging, feed):
    # a valid dimension: per key one current row, optionally one closed row
    rows = [(k, a, D[0], "src", True, D[0], H) for k, (a, _) in dim.items()]
    rows += [(k, "old", D[0], "src", False, D[0], D[0]) for k, (_, hist) in dim.items() if hist]
    t = spark.createDataFrame(rows, TGT)
    s = spark.createDataFrame(staging, STG)
    once = spark.createDataFrame(
        _spark_rows(scd2_apply(t, s, feed=feed, as_of=AS_OF.isoformat())), TGT)
    current = Counter(r.sk_id for r in once.collect() if r.is_current)
    assert all(n == 1 for n in current.values())
    assert all(r.eff_start_dt <= r.eff_end_dt for r in once.collect() if r.sk_id is not None)
    twice = _spark_rows(scd2_apply(once, s, feed=feed, as_of=AS_OF.isoformat()))
    assert _norm(twice) == _norm(_spark_rows(once))


days = st.sampled_from(DAYS)


@st.composite
def dimensions(draw):
    """Per key up to two closed versions and perhaps a current one, in order."""
    rows = []
    for key in draw(st.lists(keys, unique_by=lambda k: (k is None, k), max_size=4)):
        cuts = sorted(draw(st.lists(days, min_size=1, max_size=4, unique=True)))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if i < 2 and draw(st.booleans()):
                rows.append((key, draw(attrs), a, "src", False, a, b))
        if draw(st.booleans()):
            rows.append((key, draw(attrs), cuts[-1], "src", True, cuts[-1], H))
    return rows


feeds = st.lists(st.tuples(keys, attrs, st.one_of(st.none(), days)), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=dimensions(), staging=feeds, feed=st.sampled_from(["full", "delta"]), as_of=days)
def test_dates_of_one_range(spark, target, staging, feed, as_of):
    t, s = spark.createDataFrame(target, TGT), spark.createDataFrame(staging, STG)
    got = _spark_rows(scd2_apply(t, s, feed=feed, as_of=as_of.isoformat()))
    assert _norm(got) == _norm(scd2_default(target, staging, feed, as_of))
    by_key = {}
    for r in got:
        assert r[5] <= r[6], r                                  # no interval ends before it starts
        by_key.setdefault(r[0], []).append(r)
    for rows in by_key.values():
        rows.sort(key=lambda r: (r[5], r[6]))
        assert all(a[6] <= b[5] for a, b in zip(rows, rows[1:])), rows      # none overlap
        assert sum(r[4] is True for r in rows) <= 1
