"""Table sinks, compaction and streaming restarts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ingestkit.session import scratch_dir, unique_table
from ingestkit.sinks.tables import (TableMissing, append_table, append_with_reconcile,
                                    compact_table, create_table)
from ingestkit.sources.delimited import read_delimited, write_delimited
from ingestkit.sources.messages import TopicSource, publish_batch
from ingestkit.streaming.ingest import StreamIngest, run_to_end, start_ingest


def _files(path):
    return [p for p in glob.glob(os.path.join(path.removeprefix("file:"), "**", "*.parquet"),
                                 recursive=True)]


def test_append_requires_existing_table(spark):
    df = spark.range(3)
    with pytest.raises(TableMissing):
        append_table(df, unique_table(spark, "absent"))


def test_append_matches_columns_by_name(spark):
    name = unique_table(spark, "byname")
    create_table(spark.range(0).selectExpr("id AS a", "'x' AS b"), name,
                 path=scratch_dir(spark, "tbl"))
    append_table(spark.range(2).selectExpr("'y' AS b", "id AS a"), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(0, "y"), (1, "y")]


def test_reconcile_counts(spark):
    name = unique_table(spark, "recon")
    create_table(spark.range(0), name, path=scratch_dir(spark, "tbl"))
    r1 = append_with_reconcile(spark.range(5), name).collect()[0]
    r2 = append_with_reconcile(spark.range(7), name).collect()[0]
    assert (r1.source_rows, r1.target_rows_before, r1.target_rows_after, r1.reconciled) == (5, 0, 5, True)
    assert (r2.source_rows, r2.target_rows_before, r2.target_rows_after, r2.reconciled) == (7, 5, 12, True)


def test_compaction_reduces_files_and_keeps_rows(spark):
    name = unique_table(spark, "small")
    path = scratch_dir(spark, "tbl-small")
    df = spark.range(20000).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS s")
    df.repartition(40).write.format("parquet").option("path", path).saveAsTable(name)
    before = len(_files(path))
    compact_table(spark, name, target_file_bytes=1 << 30)
    after = len(_files(path))
    assert after < before and after >= 1
    assert spark.table(name).count() == 20000
    assert spark.table(name).agg(F.sum("id")).collect()[0][0] == sum(range(20000))


def test_partitioned_compaction_only_touches_selected_partitions(spark):
    name = unique_table(spark, "smallp")
    path = scratch_dir(spark, "tbl-smallp")
    df = spark.range(6000).selectExpr("id", "CAST(id % 3 AS INT) AS p")
    df.repartition(30).write.partitionBy("p").format("parquet").option("path", path).saveAsTable(name)
    compact_table(spark, name, target_file_bytes=1 << 30, where="p = 1")
    per = {p: len(_files(os.path.join(path, f"p={p}"))) for p in (0, 1, 2)}
    assert per[1] < per[0] and per[1] < per[2]
    assert spark.table(name).count() == 6000


def test_quote_off_splits_quoted_field(spark):
    path = scratch_dir(spark, "csv")
    write_delimited(spark.createDataFrame([(1, "a, b")], "k int, s string"), path)
    on = read_delimited(spark, path, "k:integer,s:string,t:string").collect()[0]
    off = read_delimited(spark, path, "k:integer,s:string,t:string", quote="").collect()[0]
    assert (on.s, on.t) == ("a, b", None)
    assert (off.s, off.t) == ('"a', ' b"')


def test_stream_restart_adds_each_message_once(spark):
    folder = scratch_dir(spark, "topics")
    spec = StreamIngest(source=TopicSource("t", folder=folder), schema="a:long,b:string",
                        target_table=unique_table(spark, "st"), trigger="availableNow",
                        checkpoint=scratch_dir(spark, "ckpt"), table_path=scratch_dir(spark, "tbl"))
    first = spark.range(10).select(F.to_json(F.struct(F.col("id").alias("a"),
                                                      F.lit("x").alias("b"))).alias("v"))
    publish_batch(first, folder, "t", F.col("v"))
    run_to_end(start_ingest(spark, spec))
    run_to_end(start_ingest(spark, spec))
    assert spark.table(spec.target_table).count() == 10
    second = spark.range(10, 15).select(F.to_json(F.struct(F.col("id").alias("a"))).alias("v"))
    publish_batch(second, folder, "t", F.col("v"))
    run_to_end(start_ingest(spark, spec))
    assert sorted(r.a for r in spark.table(spec.target_table).collect()) == list(range(15))


def test_compaction_rejects_row_level_filter(spark):
    name = unique_table(spark, "smallq")
    spark.range(100).selectExpr("id", "CAST(id % 2 AS INT) AS p").write.partitionBy("p") \
        .format("parquet").option("path", scratch_dir(spark, "tbl")).saveAsTable(name)
    with pytest.raises(ValueError):
        compact_table(spark, name, where="id < 10")
    assert spark.table(name).count() == 100


def test_compaction_keeps_string_partition_values(spark):
    name = unique_table(spark, "strpart")
    df = spark.range(30).selectExpr("id", "lpad(CAST(id % 3 AS STRING), 4, '0') AS p")
    df.repartition(6).write.partitionBy("p").format("parquet") \
        .option("path", scratch_dir(spark, "tbl")).saveAsTable(name)
    compact_table(spark, name, target_file_bytes=1 << 30)
    assert sorted(r.p for r in spark.table(name).select("p").distinct().collect()) == \
        ["0000", "0001", "0002"]


def test_default_checkpoint_resumes_after_a_restart(spark):
    # no checkpoint given: the stream's own folder under spark.checkpoint.dir,
    # the same one when the stream is started anew
    from ingestkit.streaming.ingest import checkpoint_for
    folder = scratch_dir(spark, "topics")
    spec = StreamIngest(source=TopicSource("t", folder=folder), schema="a:long",
                        target_table=unique_table(spark, "stable"), trigger="availableNow",
                        table_path=scratch_dir(spark, "tbl"))
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_for(spark, spec.target_table) == f"{root}/streams/{spec.target_table}"
    for first in (0, 5):
        rows = spark.range(first, first + 5).select(F.to_json(F.struct(F.col("id").alias("a"))).alias("v"))
        publish_batch(rows, folder, "t", F.col("v"))
        run_to_end(start_ingest(spark, spec))
    assert sorted(r.a for r in spark.table(spec.target_table).collect()) == list(range(10))


def test_work_root_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from ingestkit.session import work_root
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        work_root(SimpleNamespace(sparkContext=sc, conf=conf))


@pytest.mark.parametrize(("target", "split"), [(200_000, 1 << 27), (2_000_000, 100_000), (1 << 30, 100_000)])
@pytest.mark.parametrize("parts", [[], ["p"]])
def test_compaction_meets_its_target(spark, target, split, parts):
    from ingestkit.session import scoped_conf
    name, path = unique_table(spark, "target"), scratch_dir(spark, "tbl-target")
    df = spark.range(60000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS s", "CAST(id % 3 AS INT) AS p")
    writer = df.repartition(20).write.format("parquet").option("path", path)
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)

    def sizes():
        out = {}
        for f in _files(path):
            out.setdefault(os.path.dirname(f), []).append(os.path.getsize(f))
        return out
    before = sizes()
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": str(split)}):
        compact_table(spark, name, target_file_bytes=target)
    after = sizes()
    assert set(before) == set(after)
    for folder, was in before.items():
        wanted = max(1, -(-sum(was) // target))
        assert abs(len(after[folder]) - wanted) <= 1
        assert max(after[folder]) <= 1.5 * max(target, 1)
    assert spark.table(name).agg(F.count("id"), F.sum("id")).first() == (60000, sum(range(60000)))
    assert not glob.glob(os.path.join(spark.conf.get("spark.checkpoint.dir"), "**", "compact-stage*"), recursive=True)


def test_touched_counts_plan_any_number_of_partitions(spark):
    # a partitioned table is simulated by its rows: only the semi join matters
    from ingestkit.sinks.tables import _rows_in
    name = unique_table(spark, "many")
    create_table(spark.range(30000).selectExpr("id AS p", "id % 7 AS v"), name, path=scratch_dir(spark, "tbl"), empty=False)
    touched = spark.range(20000).selectExpr("id AS __p")
    assert _rows_in(spark, name, touched, ["p"]) == 20000


def test_timestamps_are_read_in_any_plain_form(spark):
    path = scratch_dir(spark, "ts")
    forms = ["2024-01-01 10:00:00", "2024-01-01T10:00:00", "2024-01-01", "2024-01-01 10:00:00.123456"]
    spark.createDataFrame([(t,) for t in forms], "t string").coalesce(1).write.csv(path)
    got = [str(r.t) for r in read_delimited(spark, path, "t:timestamp").collect()]
    assert got == ["2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00", "2024-01-01 10:00:00.123456"]
    odd = scratch_dir(spark, "ts-odd")
    spark.createDataFrame([("01/02/2024 03h",)], "t string").write.csv(odd)
    own = read_delimited(spark, odd, "t:timestamp", options={"timestampFormat": "dd/MM/yyyy HH'h'"})
    assert str(own.collect()[0].t) == "2024-02-01 03:00:00"


def test_replayed_batch_replaces_itself(spark):
    from ingestkit.streaming.ingest import batch_folder_writer
    out = scratch_dir(spark, "mb")
    write = batch_folder_writer(out)
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    write(spark.range(3), 1)            # the same batch delivered again
    got = spark.read.parquet(out).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r.batch_id, r["count"]) for r in got] == [(0, 5), (1, 3)]


def test_glob_path_reads_all_matching_files(spark):
    base = scratch_dir(spark, "glob")
    for day in ("2020-01-01", "2020-01-02"):
        write_delimited(spark.createDataFrame([(day, 1)], "d string, n int"), f"{base}/{day}")
    got = read_delimited(spark, f"{base}/*/*.csv", "d:date,n:integer")
    assert sorted(str(r.d) for r in got.collect()) == ["2020-01-01", "2020-01-02"]


def test_processing_time_trigger(spark):
    folder = scratch_dir(spark, "topics")
    publish_batch(spark.range(4).select(F.to_json(F.struct(F.col("id").alias("a"))).alias("v")),
                  folder, "t", F.col("v"))
    spec = StreamIngest(source=TopicSource("t", folder=folder), schema="a:long",
                        target_table=unique_table(spark, "pt"), trigger="1 second",
                        checkpoint=scratch_dir(spark, "ckpt"), table_path=scratch_dir(spark, "tbl"))
    q = start_ingest(spark, spec)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.a for r in spark.table(spec.target_table).collect()) == [0, 1, 2, 3]


def test_compaction_refuses_a_live_stream_sink_table(spark):
    folder = scratch_dir(spark, "topics")
    publish_batch(spark.range(6).select(F.to_json(F.struct(F.col("id").alias("a"))).alias("v")),
                  folder, "t", F.col("v"))
    spec = StreamIngest(source=TopicSource("t", folder=folder), schema="a:long",
                        target_table=unique_table(spark, "sinkt"), trigger="availableNow",
                        checkpoint=scratch_dir(spark, "ckpt"), table_path=scratch_dir(spark, "tbl"))
    run_to_end(start_ingest(spark, spec))
    with pytest.raises(ValueError):
        compact_table(spark, spec.target_table)
    compact_table(spark, spec.target_table, allow_stream_sink=True)
    assert spark.table(spec.target_table).count() == 6


def test_reconcile_touched_partitions_only(spark):
    name = unique_table(spark, "recon_p")
    base = spark.range(1000).selectExpr("id", "CAST(id % 10 AS INT) AS p")
    create_table(base, name, path=scratch_dir(spark, "tbl"), partition_by=["p"], empty=False)
    load = spark.range(30).selectExpr("id + 5000 AS id", "CAST(id % 3 AS INT) AS p")
    r = append_with_reconcile(load, name, partition_cols=["p"], scope="touched").collect()[0]
    # partitions 0, 1, 2 held 100 rows each before the load
    assert (r.source_rows, r.target_rows_before, r.target_rows_after, r.reconciled) == \
        (30, 300, 330, True)
    assert spark.table(name).count() == 1030
