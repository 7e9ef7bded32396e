"""SCD2 golden matrix (FIXTURES F6) and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from ingestkit.operators.cdc import classify_changes, scd2_apply

D = dt.date
H = D(9999, 12, 31)
TGT_SCHEMA = ("sk_id long, attr string, mod_dt date, data_src_cd string, is_current boolean, "
              "eff_start_dt date, eff_end_dt date")
STG_SCHEMA = "src_id long, src_attr string, src_mod_dt date"


def _target(spark):
    d20, d19 = D(2020, 1, 1), D(2019, 1, 1)
    rows = [(1, "a", d20, True, d20, H), (2, "b", d20, True, d20, H), (3, "c", d20, True, d20, H),
            (4, "old", d19, False, d19, d20), (4, "new", d20, True, d20, H),
            (5, None, d20, True, d20, H), (6, "f", d20, True, d20, H), (8, "h", d19, False, d19, d20)]
    return spark.createDataFrame([(k, a, m, "bronze_data", c, s, e) for k, a, m, c, s, e in rows],
                                 TGT_SCHEMA)


def _staging(spark):
    d21 = D(2021, 1, 1)
    rows = [(1, "a"), (2, "B2"), (4, "new"), (5, "e"), (6, None), (7, "g")]
    return spark.createDataFrame([(k, a, d21) for k, a in rows], STG_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.select(
        "sk_id", "attr", "mod_dt", "is_current", "eff_start_dt", "eff_end_dt").collect()),
        key=lambda r: tuple((x is None, str(x)) for x in r))


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_compat_actions(spark):
    out = classify_changes(_target(spark), _staging(spark), mode="compat")
    got = [(r.sk_id, r.attr, r.src_id, r.action) for r in out.collect()]
    by = {(k, a, s): act for k, a, s, act in got}
    assert by[(1, "a", 1)] == "NOACTION"
    assert by[(2, "b", 2)] == "UPSERT"
    assert by[(3, "c", None)] == "DELETE"
    assert by[(4, "new", 4)] == "NOACTION"
    assert by[(4, "old", 4)] == "UPSERT"
    assert by[(5, None, 5)] == "NOACTION"
    assert by[(6, "f", 6)] == "DELETE"
    assert by[(None, None, 7)] == "INSERT"
    assert by[(8, "h", None)] == "NOACTION"
    assert len(got) == 9


def test_compat_result(spark):
    d19, d20, d21 = D(2019, 1, 1), D(2020, 1, 1), D(2021, 1, 1)
    expected = [(1, "a", d20, True, d20, H), (2, "b", d20, False, d20, d21),
                (2, "B2", d21, True, d21, H), (4, "old", d19, False, d19, d21),
                (4, "new", d20, True, d20, H), (4, "new", d21, True, d21, d20),
                (5, None, d20, True, d20, H), (7, "g", d21, True, d21, H),
                (8, "h", d19, False, d19, d20)]
    for feed in ("full", "delta"):
        out = scd2_apply(_target(spark), _staging(spark), feed=feed, mode="compat")
        assert _rows(out) == _sorted(expected)


def _default_expected(feed):
    d19, d20, d21, d22 = D(2019, 1, 1), D(2020, 1, 1), D(2021, 1, 1), D(2021, 1, 2)
    three = (3, "c", d20, False, d20, d22) if feed == "full" else (3, "c", d20, True, d20, H)
    return _sorted([(1, "a", d20, True, d20, H), (2, "b", d20, False, d20, d21),
                    (2, "B2", d21, True, d21, H), three,
                    (4, "old", d19, False, d19, d20), (4, "new", d20, True, d20, H),
                    (5, None, d20, False, d20, d21), (5, "e", d21, True, d21, H),
                    (6, "f", d20, False, d20, d21), (6, None, d21, True, d21, H),
                    (7, "g", d21, True, d21, H), (8, "h", d19, False, d19, d20)])


def test_default_full_and_delta(spark):
    for feed in ("full", "delta"):
        out = scd2_apply(_target(spark), _staging(spark), feed=feed, as_of="2021-01-02")
        assert _rows(out) == _default_expected(feed)


def test_default_is_idempotent(spark):
    for feed in ("full", "delta"):
        once = scd2_apply(_target(spark), _staging(spark), feed=feed, as_of="2021-01-02")
        once = spark.createDataFrame(once.collect(), once.schema)
        twice = scd2_apply(once, _staging(spark), feed=feed, as_of="2021-01-02")
        assert _rows(twice) == _rows(once)


def test_one_current_row_per_key_and_no_overlap(spark):
    out = scd2_apply(_target(spark), _staging(spark), feed="full", as_of="2021-01-02")
    cur = out.where("is_current").groupBy("sk_id").count().where("count > 1").count()
    assert cur == 0
    bad = out.where(F.col("eff_end_dt") < F.col("eff_start_dt")).count()
    assert bad == 0


def test_staging_duplicates_reduced_to_latest(spark):
    stg = spark.createDataFrame([(2, "x", D(2021, 1, 1)), (2, "y", D(2021, 2, 1)),
                                 (2, "a", D(2021, 2, 1))], STG_SCHEMA)
    out = scd2_apply(_target(spark), stg, feed="delta", as_of="2021-03-01")
    cur = [tuple(r) for r in out.where("sk_id = 2 AND is_current").select("attr", "mod_dt").collect()]
    assert cur == [("y", D(2021, 2, 1))]


def test_null_key_is_one_key_value(spark):
    tgt = _target(spark).unionByName(spark.createDataFrame(
        [(None, "z", D(2020, 1, 1), "bronze_data", True, D(2020, 1, 1), H)], TGT_SCHEMA))
    stg = _staging(spark).unionByName(spark.createDataFrame([(None, "n", D(2021, 1, 1))], STG_SCHEMA))
    out = scd2_apply(tgt, stg, feed="full", as_of="2021-01-02")
    nulls = sorted((r.attr, r.is_current) for r in out.where("sk_id IS NULL").collect())
    # default mode matches keys null-safely: the feed's null-key row replaces
    # the dimension's (one current row per key, and a re-run changes nothing)
    assert nulls == [("n", True), ("z", False)]
    again = scd2_apply(spark.createDataFrame(out.collect(), out.schema), stg, feed="full",
                       as_of="2021-01-02")
    assert _rows(again) == _rows(out)


def test_flag_deletes_and_order(spark):
    out = scd2_apply(_target(spark), _staging(spark), feed="full", as_of="2021-01-02",
                     flag_deletes=True, order_by_key=True)
    rows = out.collect()
    assert [r.sk_id for r in rows] == sorted(r.sk_id for r in rows)
    deleted = [(r.sk_id, r.is_current) for r in rows if r.is_deleted]
    assert deleted == [(3, False)]


def test_scd2_view_over_tables(spark):
    from ingestkit.operators.cdc import scd2_view
    from ingestkit.session import scratch_dir, unique_table
    tgt, stg = unique_table(spark, "silver"), unique_table(spark, "bronze")
    _target(spark).write.format("parquet").option("path", scratch_dir(spark, "t")).saveAsTable(tgt)
    _staging(spark).write.format("parquet").option("path", scratch_dir(spark, "s")).saveAsTable(stg)
    scd2_view(tgt, stg, feed="full", as_of="2021-01-02")
    rows = spark.sql("SELECT * FROM merged_cdc")
    assert _rows(rows) == _default_expected("full")


def test_a_late_row_changes_nothing(spark):
    t = spark.createDataFrame([(1, "a", D(2021, 5, 1), "bronze_data", True, D(2021, 5, 1), H)], TGT_SCHEMA)
    f = spark.createDataFrame([(1, "b", D(2021, 1, 1))], STG_SCHEMA)
    for feed in ("full", "delta"):
        assert [tuple(r) for r in scd2_apply(t, f, feed=feed, as_of="2021-06-01").collect()] == [tuple(t.collect()[0])]


def test_write_back_touches_current_rows_only(spark):
    import glob
    import os

    from ingestkit.operators.cdc import scd2_write_back
    from ingestkit.session import scratch_dir, unique_table
    from ingestkit.sinks.tables import create_table
    name, path = unique_table(spark, "dim"), scratch_dir(spark, "tbl-dim")
    rows = [(1, "old", D(2019, 1, 1), "bronze_data", False, D(2019, 1, 1), D(2020, 1, 1)),
            (1, "a", D(2020, 1, 1), "bronze_data", True, D(2020, 1, 1), H),
            (2, "b", D(2020, 1, 1), "bronze_data", True, D(2020, 1, 1), H)]
    t = spark.createDataFrame(rows, TGT_SCHEMA)
    create_table(t, name, path=path, partition_by=["is_current"], empty=False)
    history = lambda: set(glob.glob(os.path.join(path.removeprefix("file:"), "is_current=false", "*.parquet")))
    held = history()
    feed = spark.createDataFrame([(1, "z", D(2021, 1, 1)), (3, "c", D(2021, 1, 1))], STG_SCHEMA)
    want = sorted(map(str, (r.asDict() for r in scd2_apply(t, feed, as_of="2021-01-02").collect())))
    for _ in range(2):
        scd2_write_back(name, feed, as_of="2021-01-02")
        got = spark.table(name).select(*t.columns)
        assert sorted(map(str, (r.asDict() for r in got.collect()))) == want
        assert held <= history()
    # a feed without any key closes all
    scd2_write_back(name, feed.where("false"), as_of="2022-01-01")
    assert spark.table(name).where("is_current").count() == 0
    assert not glob.glob(os.path.join(spark.conf.get("spark.checkpoint.dir"), "**", "scd2-stage*"), recursive=True)
