"""Publication by pointer, runs appended once, bin packing."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ingestkit.session import scratch_dir, unique_table
from ingestkit.sinks import files, publish
from ingestkit.sinks.ledger import DONE, RunLedger
from ingestkit.sinks.tables import TableMissing, create_table


def _ids(spark, name):
    return sorted(r[0] for r in spark.table(name).select("id").collect())


def test_a_table_is_switched_at_once(spark):
    name, root = unique_table(spark, "versions"), scratch_dir(spark, "tbl-versions")
    with pytest.raises(TableMissing):
        publish.replace_table(spark.range(3), name)
    publish.replace_table(spark.range(3), name, root=root)
    old = spark.table(name)
    reading = old._jdf.queryExecution().toRdd().toJavaRDD()          # planned: its files are listed
    publish.replace_table(spark.range(10, 14), name)
    assert _ids(spark, name) == [10, 11, 12, 13] and reading.count() == 3
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):           # a failed write changes nothing
        publish.replace_table(spark.range(5).select((F.lit(1) / (F.col("id") - 3)).cast("long").alias("id")), name)
    assert _ids(spark, name) == [10, 11, 12, 13]
    for n in (20, 30, 40):
        publish.replace_table(spark.range(n, n + 2), name)
    assert len([x for x in files.listed(spark, root) if x[2]]) == 2    # the version shown and the one before
    assert _ids(spark, name) == [40, 41]


def test_partitions_are_switched_one_by_one(spark):
    name = unique_table(spark, "parts")
    df = spark.range(9).selectExpr("id", "CAST(id % 3 AS STRING) AS p", "CAST(NULL AS STRING) AS q")
    create_table(df, name, path=scratch_dir(spark, "tbl-parts"), partition_by=["p"], empty=False)
    kept = files.data_files(spark, files.partition_location(spark, name, {"p": "1"}))
    specs = publish.replace_partitions(spark.createDataFrame([(100, "0", "x"), (101, "a b/c'd", "y"), (102, None, "z")], "id long, p string, q string"), name)
    assert {s["p"] for s in specs} == {"0", "a b/c'd", None}
    assert _ids(spark, name) == [1, 2, 4, 5, 7, 8, 100, 101, 102]
    assert files.data_files(spark, files.partition_location(spark, name, {"p": "1"})) == kept
    for n in range(3):
        publish.replace_partitions(spark.createDataFrame([(200 + n, "0", "x")], "id long, p string, q string"), name)
    assert _ids(spark, name) == [1, 2, 4, 5, 7, 8, 101, 102, 202]


class Cut(Exception):
    pass


@pytest.mark.parametrize("where", ["_stored", "adopt_files", "move"])
@pytest.mark.parametrize("parts", [[], ["p"]])
def test_a_run_is_appended_once(spark, monkeypatch, where, parts):
    name = unique_table(spark, "once")
    df = spark.range(40).selectExpr("id", "CAST(id % 3 AS INT) AS p").repartition(4)
    create_table(df, name, path=scratch_dir(spark, "tbl-once"), partition_by=parts or None)

    def cut(*_a, **_k):
        raise Cut
    with monkeypatch.context() as m:
        if where == "move":
            moved, move = [], files.move

            def two_files(*a):
                cut() if len(moved) == 2 else move(*a)
                moved.append(a)
            m.setattr(files, "move", two_files)
        else:
            m.setattr(publish, where, cut)
        with pytest.raises(Cut):
            publish.append_once(df, name, "batch-7")
    assert publish.append_once(df, name, "batch-7") is True
    assert publish.append_once(df, name, "batch-7") is False
    assert _ids(spark, name) == list(range(40))
    publish.append_once(df.where("id < 5"), name, "batch-8")
    assert Counter(_ids(spark, name)) == Counter([*range(40), *range(5)])
    assert {r.state for r in RunLedger.of_table(spark, name).runs()} == {DONE}


def test_first_fit_decreasing():
    assert publish.packed([("a", 6), ("b", 5), ("c", 4), ("d", 3), ("e", 2)], 10) == [["a", "c"], ["b", "d", "e"]]
    assert publish.packed([("a", 9), ("b", 8)], 10) == [] and publish.packed([], 10) == []


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_small_files_are_packed_and_large_ones_stay(spark, parts):
    name = unique_table(spark, "pack")
    path = scratch_dir(spark, "tbl-pack")
    big = spark.range(60000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS s", "CAST(0 AS INT) AS p").coalesce(1)
    create_table(big, name, path=path, partition_by=parts or None, empty=False)
    small = spark.range(60000, 62000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS s", "CAST(id % 2 AS INT) AS p").repartition(12)
    small.write.mode("append").partitionBy(*parts).saveAsTable(name) if parts else small.write.mode("append").saveAsTable(name)
    folders = [files.partition_location(spark, name, {"p": p}) for p in (0, 1)] if parts else [path]
    target = 1 << 20
    large = {f for folder in folders for f in files.data_files(spark, folder) if f[1] >= target}
    bins = sum(len(publish.packed([f for f in files.data_files(spark, d) if f[1] < target], target)) for d in folders)
    before = sum(len(files.data_files(spark, d)) for d in folders)
    rows = Counter(map(tuple, spark.table(name).collect()))
    report = publish.pack_small_files(spark, name, target_file_bytes=target)
    after = {f for folder in folders for f in files.data_files(spark, folder)}
    assert large and large <= after
    assert report["files_after"] == bins and len(after) == before - report["files_before"] + bins and report["rows"] == 2000
    assert Counter(map(tuple, spark.table(name).collect())) == rows
    assert publish.pack_small_files(spark, name, target_file_bytes=target)["rows"] in (0, 2000)


@pytest.mark.parametrize("where", ["adopt_files", "delete"])
def test_a_cut_packing_is_finished(spark, monkeypatch, where):
    name = unique_table(spark, "pack")
    create_table(spark.range(100).repartition(8), name, path=scratch_dir(spark, "tbl-pack"), empty=False)

    def cut(*_a):
        raise Cut
    with monkeypatch.context() as m:
        m.setattr(publish if where == "adopt_files" else files, where, cut)
        with pytest.raises(Cut):
            publish.pack_small_files(spark, name)
    publish.pack_small_files(spark, name)
    assert _ids(spark, name) == list(range(100)) and len(files.data_files(spark, files.table_location(spark, name))) == 1
