"""Changes spliced into a dimension's history, against plain Python."""

import datetime as dt
import itertools
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import H, spliced
from ingestkit.operators.history import collapse_versions, splice_changes
from test_cdc_bruteforce import DAYS, STG, TGT, attrs, dimensions, feeds

COLUMNS = ("sk_id", "attr", "mod_dt", "data_src_cd", "is_current", "eff_start_dt", "eff_end_dt")


def _rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def _apply(spark, dim, changes):
    return _rows(splice_changes(spark.createDataFrame(dim, TGT), spark.createDataFrame(changes, STG)))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(dim=dimensions(), changes=feeds)
def test_random_fixtures(spark, dim, changes):
    got = _apply(spark, dim, changes)
    assert Counter(got) == Counter(spliced(dim, changes))
    by_key = {}
    for r in got:
        assert r[5] < r[6] and r[4] == (r[6] == H)
        by_key.setdefault(r[0], []).append(r)
    for rows in by_key.values():
        rows.sort(key=lambda r: r[5])
        assert all(a[6] <= b[5] for a, b in zip(rows, rows[1:]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(dim=dimensions(), changes=st.lists(st.tuples(st.integers(0, 2), attrs, st.sampled_from(DAYS)), min_size=2, max_size=5), data=st.data())
def test_any_order_of_arrival(spark, dim, changes, data):
    whole = Counter(_apply(spark, dim, changes))
    one_by_one = dim
    for change in data.draw(st.permutations(changes)):
        one_by_one = _apply(spark, one_by_one, [change])
    assert Counter(one_by_one) == whole
    assert Counter(_apply(spark, one_by_one, changes)) == whole          # again: no change


def test_every_order_of_one_key(spark):
    d = lambda m: dt.date(2021, m, 1)
    dim = [(1, "a", d(1), "src", False, d(1), d(4))]
    changes = [(1, "b", d(2)), (1, "a", d(3)), (1, "c", d(6))]
    want = Counter([(1, "a", d(1), "src", False, d(1), d(2)), (1, "b", d(2), "src", False, d(2), d(3)),
                    (1, "a", d(3), "src", False, d(3), d(4)), (1, "c", d(6), "bronze_data", True, d(6), H)])
    for order in list(itertools.permutations(changes))[1::2]:
        now = dim
        for change in order:
            now = _apply(spark, now, [change])
        assert Counter(now) == want, order


def test_versions_that_cover_no_time_pass_through(spark):
    d = lambda m: dt.date(2021, m, 1)
    dim = [(1, "x", d(2), "src", False, d(2), d(2)), (1, "n", None, "src", False, None, d(2)), (1, "a", d(1), "src", True, d(1), H)]
    got = _apply(spark, dim, [(1, "b", d(2)), (1, "z", None), (None, "n", d(3))])
    assert Counter(got) == Counter([*dim[:2], (1, "a", d(1), "src", False, d(1), d(2)), (1, "b", d(2), "src", True, d(2), H),
                                    (None, "n", d(3), "bronze_data", True, d(3), H)])


def _plain_collapse(rows):
    out = []
    for r in sorted(rows, key=lambda r: (str(r[0]), r[5])):
        last = out[-1] if out else None
        if last and last[0] == r[0] and last[6] == r[5] and last[1] == r[1]:
            out[-1] = (*last[:4], r[4], last[5], r[6])
        else:
            out.append(r)
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(dim=dimensions(), changes=feeds)
def test_collapsed_for_reading(spark, dim, changes):
    got = _apply(spark, dim, changes)
    read = _rows(collapse_versions(spark.createDataFrame(got, TGT)))
    assert Counter(read) == Counter(_plain_collapse(got))


def test_hot_key_is_spread_by_month(spark):
    # a third of the changes are one key's, on 3,000 days
    n = 9000
    changes = spark.range(n).selectExpr("IF(id % 3 = 0, -1, id) AS src_id", "CONCAT('v', id) AS src_attr",
                                        "DATE_ADD(DATE '2010-01-01', CAST(id / 3 AS INT)) AS src_mod_dt")
    out = splice_changes(spark.createDataFrame([], TGT), changes)
    assert out.count() == n
    hot = out.where("sk_id = -1")
    assert hot.count() == 3000 and hot.where("is_current").count() == 1
    assert hot.where("eff_end_dt = DATE_ADD(eff_start_dt, 1)").count() == 2999
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__block" in plan.split("RepartitionByExpression")[1].splitlines()[0]


def test_small_feed_leaves_the_dimension_where_it_is(spark):
    dim = spark.range(200000).selectExpr("id AS sk_id", "'a' AS attr", "DATE '2021-01-01' AS mod_dt", "'src' AS data_src_cd",
                                         "true AS is_current", "DATE '2021-01-01' AS eff_start_dt", "DATE '9999-12-31' AS eff_end_dt")
    changes = spark.createDataFrame([(5, "b", dt.date(2021, 2, 1)), (5, "c", dt.date(2021, 3, 1))], STG)
    plan = splice_changes(dim, changes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(sk_id" not in plan
