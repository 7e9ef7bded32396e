"""SCD2 write-back: run ledger, interrupted runs, versions that look alike."""

import datetime as dt
from collections import Counter

import pytest

from ingestkit.operators import dimension
from ingestkit.operators.cdc import scd2_apply, scd2_write_back
from ingestkit.session import scoped_conf, scratch_dir, unique_table
from ingestkit.sinks import files
from ingestkit.sinks.ledger import DONE, DROPPED, RunLedger
from ingestkit.sinks.tables import create_table
from test_cdc_bruteforce import STG, TGT, H

COLUMNS = ("sk_id", "attr", "mod_dt", "data_src_cd", "is_current", "eff_start_dt", "eff_end_dt")


def D(m, d=1):
    return dt.date(2021, m, d)


ROWS = [(1, "old", D(1), "src", False, D(1), D(2)), (1, "a", D(2), "src", True, D(2), H), (2, "b", D(2), "src", True, D(2), H)]


def _table(spark, rows=ROWS):
    name = unique_table(spark, "dim")
    create_table(spark.createDataFrame(rows, TGT), name, path=scratch_dir(spark, "tbl-dim"), partition_by=["is_current"], empty=False)
    return name


def _rows(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def _feed(spark, rows):
    return spark.createDataFrame(rows, STG)


FEEDS = [("delta", [(1, "b", D(3))], D(3)), ("delta", [(1, "c", D(3))], D(3)), ("delta", [(1, "b", D(3)), (4, "n", D(3))], D(3)),
         ("delta", [(1, "e", D(3))], D(3)), ("full", [(1, "e", D(3)), (4, "m", D(4))], D(4)), ("full", [], D(3, 15)), ("full", [], D(5)),
         ("delta", [(1, "late", D(2)), (2, "again", D(6))], D(6)), ("full", [(2, "again", D(6)), (9, "new", None)], D(1))]


def test_several_feeds_equal_the_operator_after_each(spark):
    name = _table(spark)
    now = spark.createDataFrame(ROWS, TGT)
    for feed, rows, as_of in FEEDS:
        want = scd2_apply(now, _feed(spark, rows), feed=feed, as_of=as_of.isoformat()).collect()
        scd2_write_back(name, _feed(spark, rows), feed=feed, as_of=as_of.isoformat())
        assert _rows(spark.table(name)) == Counter(tuple(r) for r in want), (feed, rows)
        now = spark.createDataFrame(want, TGT)
    kept = [r.attr for r in spark.table(name).where("sk_id = 1").collect()]
    # b twice: two versions that look alike are two
    assert sorted(kept) == ["a", "b", "b", "c", "e", "old"]


class Cut(Exception):
    pass


@pytest.mark.parametrize("where", ["before storing", "before publishing", "while moving", "before the switch", "after the switch"])
def test_a_cut_run_can_be_repeated(spark, monkeypatch, where):
    name = _table(spark, [*ROWS, (3, "c", D(2), "src", True, D(2), H)])
    feed = _feed(spark, [(1, "x", D(3)), (2, "y", D(3)), (5, "n", D(3))])
    want = _rows(scd2_apply(spark.createDataFrame(spark.table(name).collect(), spark.table(name).schema), feed, as_of="2021-04-01"))
    real = {n: getattr(dimension, n) for n in ("scd2_apply", "_publish", "switch_partition")}

    def cut(*_a, **_k):
        raise Cut

    with monkeypatch.context() as m:
        if where == "before storing":
            m.setattr(dimension, "scd2_apply", cut)
        elif where == "before publishing":
            m.setattr(dimension, "_publish", cut)
        elif where == "while moving":
            moved, move = [], files.move

            def one_file(*a):
                move(*a) if not moved else cut()
                moved.append(a)
            m.setattr(files, "move", one_file)
        elif where == "before the switch":
            m.setattr(dimension, "switch_partition", cut)
        else:
            def then_cut(*a):
                real["switch_partition"](*a)
                cut()
            m.setattr(dimension, "switch_partition", then_cut)
        with pytest.raises(Cut), scoped_conf(spark, {"spark.sql.files.maxRecordsPerFile": "1"}):      # a file a row
            scd2_write_back(name, feed, as_of="2021-04-01", feed_id="f1")
    scd2_write_back(name, feed, as_of="2021-04-01", feed_id="f1")
    assert _rows(spark.table(name)) == want
    states = Counter(r.state for r in RunLedger.of_table(spark, name).runs())
    assert states == ({DONE: 1, DROPPED: 1} if where == "before storing" else {DONE: 1})


def test_a_feed_id_is_applied_once(spark):
    name = _table(spark)
    for feed_id, attr in (("f1", "x"), ("f2", "y"), ("f1", "x")):
        scd2_write_back(name, _feed(spark, [(1, attr, D(3))]), feed="delta", as_of="2021-04-01", feed_id=feed_id)
    assert [r.attr for r in spark.table(name).where("sk_id = 1 and is_current").collect()] == ["y"]


def test_history_is_not_read_beyond_the_feeds_dates(spark, monkeypatch):
    name = _table(spark)
    plans = []

    def kept(target, staging, **options):
        out = scd2_apply(target, staging, **options)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(dimension, "scd2_apply", kept)
    scd2_write_back(name, _feed(spark, [(1, "x", D(3))]), feed="delta", as_of="2021-04-01")
    scans = [line for line in plans[0].splitlines() if "FileScan parquet" in line and "is_current" in line]
    assert scans
    for line in scans:
        assert "PartitionFilters: [isnotnull(is_current" in line, line
    history = [line for line in scans if "NOT is_current" in line]
    assert history and all("GreaterThan(eff_end_dt,2021-03-01)" in line and "ReadSchema: struct<sk_id:bigint,eff_end_dt:date>" in line
                           for line in history if "eff_end_dt" in line.split("ReadSchema")[1])


def test_a_reader_that_began_before_goes_on(spark):
    name = _table(spark)
    before = spark.table(name).where("is_current")
    rows = before.collect()
    reading = before._jdf.queryExecution().toRdd().toJavaRDD()           # planned: its files are listed
    scd2_write_back(name, _feed(spark, [(1, "x", D(3))]), feed="delta", as_of="2021-04-01")
    assert reading.count() == len(rows)
    # the folder before the previous one is gone, the previous one is not
    root = files.table_location(spark, name)
    for m in (4, 5):
        scd2_write_back(name, _feed(spark, [(1, f"x{m}", D(m))]), feed="delta", as_of="2021-08-01")
    runs = [n for n, _, folder in files.listed(spark, root) if folder and n.startswith("run-")]
    assert len(runs) == 2 and not files.exists(spark, f"{root}/is_current=true")


def test_a_table_in_one_piece_is_replaced(spark):
    name = unique_table(spark, "dim_whole")
    create_table(spark.createDataFrame(ROWS, TGT), name, path=scratch_dir(spark, "tbl-dim"), empty=False)
    feed = _feed(spark, [(1, "x", D(3))])
    want = _rows(scd2_apply(spark.createDataFrame(ROWS, TGT), feed, as_of="2021-04-01"))
    for _ in range(2):
        assert scd2_write_back(name, feed, as_of="2021-04-01")["replaced"] == "table"
        assert _rows(spark.table(name)) == want
