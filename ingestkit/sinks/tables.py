"""Table writes: replace, append, partitioned append, load reconciliation
and small-file compaction.

All writes go through the session catalog.  With a v2 catalog (a table
format with its own commit protocol) ``writeTo(...).append()`` is used;
plain file-source tables take the v1 ``saveAsTable`` path, which matches
columns by name.  A v1 append would silently *create* a missing table,
so existence is checked first; the provider decides between the two.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestkit.session import remove_folder, scoped_conf, scratch_dir
from ingestkit.sinks import files

MAX_BROADCAST_PARTITIONS = 50_000


class TableMissing(RuntimeError):
    pass


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def overwrite_table(df: DataFrame, name: str, *, fmt: str = "orc", path: str | None = None,
                    partition_by: list[str] | None = None) -> None:
    """Replace the table's contents (create it if absent)."""
    writer = df.write.format(fmt).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def create_table(df: DataFrame, name: str, *, fmt: str = "parquet", path: str | None = None,
                 partition_by: list[str] | None = None,
                 bucket_by: tuple[int, list[str]] | None = None, empty: bool = True) -> None:
    """Create a table with ``df``'s schema (and, with ``empty=False``, rows).

    ``bucket_by=(n, keys)`` hash-buckets and sorts the files by ``keys``:
    joins and aggregations on those keys then read the table without a
    shuffle (the other side is shuffled into the same ``n`` partitions).
    Choose ``n`` so that one bucket of the whole table is a few hundred MB.
    """
    writer = (df.limit(0) if empty else df).write.format(fmt).mode("error")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name to an existing table; fail if it is absent."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        raise TableMissing(f"table {name} does not exist")
    if _is_file_table(spark, name):
        writer = df.write.mode("append")
        parts = _partition_columns(spark, name)
        if parts:
            writer = writer.partitionBy(*parts)
        writer.saveAsTable(name)
    else:
        df.writeTo(name).append()


def clustered(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows arranged for a partitioned write.

    ``rebalance`` hashes on the partition columns and lets AQE split a
    partition value that is too big for one task and merge small ones, so
    each task writes few, evenly sized files; the local sort then lets the
    writer keep one file open at a time.
    """
    return df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols)


def append_partitioned(df: DataFrame, name: str, partition_cols: list[str], *,
                       create: bool = False, fmt: str = "parquet", path: str | None = None) -> None:
    """Partitioned append; ``create=True`` creates the table on first use."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        if not create:
            raise TableMissing(f"table {name} does not exist")
        create_table(df, name, fmt=fmt, path=path, partition_by=partition_cols)
    append_table(clustered(df, partition_cols), name)


REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("target_rows_before", T.LongType()),
    T.StructField("target_rows_after", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("reconciled", T.BooleanType()),
])


def _rows_in(spark: SparkSession, name: str, touched: DataFrame | None, parts: list[str]) -> int:
    t = spark.table(name)
    if touched is not None:
        on = reduce(lambda a, b: a & b, [t[p].eqNullSafe(touched[f"__{p}"]) for p in parts])
        t = t.join(touched, on, "left_semi")
    return t.count()


def append_with_reconcile(df: DataFrame, name: str, *,
                          partition_cols: list[str] | None = None,
                          scope: str = "table") -> DataFrame:
    """Append and report source vs target counts (one row).

    The source is counted by an ``observe`` metric of the write itself, so
    it is not read a second time; the target counts come from file footers.
    ``scope="table"`` counts the whole target (what the original load job
    printed).  ``scope="touched"`` (partitioned tables) counts only the
    partitions the load writes to: the target is semi-joined with the load's
    distinct partition values, which are stored first (one pass over the
    source's partition columns), so any number of them stays on the executors.
    """
    spark = df.sparkSession
    if scope not in ("table", "touched"):
        raise ValueError(f"scope must be 'table' or 'touched', not {scope!r}")
    parts = partition_cols or (_partition_columns(spark, name) if table_exists(spark, name) else [])
    touched = stage = None
    if scope == "touched":
        if not parts:
            raise ValueError("scope='touched' needs a partitioned table")
        stage = scratch_dir(spark, "touched")
        df.select(*[F.col(p).alias(f"__{p}") for p in parts]).distinct().write.parquet(stage)
        touched = spark.read.parquet(stage)
    obs = Observation(f"load_{abs(hash(name))}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    before = _rows_in(spark, name, touched, parts) if table_exists(spark, name) else 0
    if partition_cols:
        append_partitioned(observed, name, partition_cols)
    else:
        append_table(observed, name)
    src = int(obs.get["rows"])
    after = _rows_in(spark, name, touched, parts)
    if stage:
        remove_folder(spark, stage)
    row = (name, src, before, after, after - before, after - before == src)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def replace_from_staged(staged: DataFrame, name: str, *, partitions_only: bool = False) -> None:
    """Overwrite table ``name`` with ``staged`` (data that does not read the
    table itself, e.g. written under the work root).

    ``partitions_only=True`` replaces just the partitions present in
    ``staged`` (dynamic partition overwrite); otherwise the whole table.
    """
    spark = staged.sparkSession
    staged = staged.select(*spark.table(name).columns)
    mode = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if partitions_only else "static"}
    with scoped_conf(spark, mode):
        staged.write.mode("overwrite").insertInto(name)


def _describe(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r.col_name: r.data_type for r in rows}


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _is_file_table(spark: SparkSession, name: str) -> bool:
    """Whether the session catalog keeps the table as plain files (no commit
    protocol of a table format), by its provider."""
    provider = (_describe(spark, name).get("Provider") or "").lower()
    return provider in ("parquet", "orc", "csv", "json", "text", "avro", "hive")


def _has_stream_sink_log(spark: SparkSession, location: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location.rstrip("/") + "/_spark_metadata")
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path))


def _partition_bytes(spark: SparkSession, name: str, parts: list[str], location: str) -> list[tuple[dict[str, object], int]]:
    """Partition values and bytes, from the list of the table's files."""
    if not parts:
        return [({}, sum(size for _, size in files.data_files(spark, location)))]
    specs = [files.partition_spec(r.partition) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return [(spec, sum(size for _, size in files.data_files(spark, files.partition_location(spark, name, spec)))) for spec in specs]


def _salted(df: DataFrame, sizes: list[tuple[dict[str, object], int]], parts: list[str], target_file_bytes: int, fmt: str) -> DataFrame:
    """The rows with the number of the output file (within their partition)
    that they go to: ceil(bytes of the partition / target) files each."""
    columns = df.schema.fields
    df = df.withColumn("__file", F.col("_metadata.file_path"))
    if fmt == "parquet":
        df = df.withColumn("__at", F.xxhash64("__file", F.col("_metadata.row_index")))
    else:
        df = df.withColumn("__at", F.xxhash64("__file", *[
            f.name for f in columns if not isinstance(f.dataType, T.MapType | T.VariantType)]))
    counts = [(*[spec[p] for p in parts], max(1, -(-size // target_file_bytes))) for spec, size in sizes]
    if not parts:
        return df.withColumn("__salt", F.pmod("__at", F.lit(counts[0][0])).cast("int")).drop("__file", "__at")
    # one row a partition of the table
    kinds = {f.name: f.dataType for f in columns}
    listed = df.sparkSession.createDataFrame(counts, ", ".join([*[f"`__{p}` string" for p in parts], "__n long"]))
    listed = listed.select(*[F.col(f"__{p}").cast(kinds[p]).alias(f"__{p}") for p in parts], "__n")
    on = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in parts])
    df = df.join(F.broadcast(listed) if len(counts) <= MAX_BROADCAST_PARTITIONS else listed, on)
    salt = F.pmod(F.col("__at"), F.col("__n")).cast("int")
    return df.withColumn("__salt", salt).drop("__file", "__at", "__n", *[f"__{p}" for p in parts])


def compact_table(spark: SparkSession, name: str, *, target_file_bytes: int = 128 * 1024 * 1024,
                  where: str | None = None, allow_stream_sink: bool = False) -> dict[str, object]:
    """Rewrite a table (or the partitions selected by ``where``) into files
    of about ``target_file_bytes``: ceil(bytes / target) files per partition.

    A table format with a rewrite procedure gets
    ``CALL <catalog>.system.rewrite_data_files``.  A file-source table is
    rewritten by Spark jobs: rows are dealt to their output file by a hash of
    where they come from, each file is staged, and the staged files replace the
    table's (INSERT OVERWRITE, one task a staged file; with partitions only the
    rewritten ones change), because Spark refuses to overwrite a table it is
    reading.  The staged copy is deleted once the row counts agree; if the swap
    fails it stays for ``replace_from_staged``.
    """
    info = _describe(spark, name)
    provider = (info.get("Provider") or "").lower()
    if provider == "iceberg":
        parts = name.split(".")
        catalog, ident = parts[0], ".".join(parts[1:])
        def quoted(text: str) -> str:
            return "'" + text.replace("'", "''") + "'"
        args = f"table => {quoted(ident)}" + (f", where => {quoted(where)}" if where else "")
        spark.sql(f"CALL {catalog}.system.rewrite_data_files({args})").collect()
        return {"table": name, "method": "procedure"}

    location = info["Location"]
    if _has_stream_sink_log(spark, location) and not allow_stream_sink:
        # a streaming file sink lists its committed files in _spark_metadata;
        # rewriting the folder drops that log, and with it the guarantee that
        # readers never see files of an unfinished micro-batch
        raise ValueError(f"{name} is written by a streaming file sink; stop the stream and pass "
                         "allow_stream_sink=True to compact it (its sink log is dropped)")
    parts = _partition_columns(spark, name)
    if where:
        # the swap replaces whole partitions, so the filter may only select
        # partitions; a row-level filter would drop the rows it leaves out
        if not parts:
            raise ValueError("where= needs a partitioned table (filter on partition columns)")
        part_schema = T.StructType([f for f in spark.table(name).schema.fields if f.name in parts])
        try:
            # an empty frame with only the partition columns: nothing else resolves
            spark.createDataFrame([], part_schema).where(where).schema
        except AnalysisException as err:
            raise ValueError(f"where= may only use partition columns {parts}: {where!r}") from err
    fmt = provider or "parquet"
    stage = scratch_dir(spark, "compact-stage")
    df = spark.table(name)
    if where:
        df = df.where(where)
    rows, schema = df.count(), spark.table(name).schema
    keys = [*parts, "__salt"]
    salted = _salted(df, _partition_bytes(spark, name, parts, location), parts, target_file_bytes, fmt)
    salted.repartition(*keys).sortWithinPartitions(*keys).write.partitionBy(*keys).format(fmt).save(stage)
    # the table's own schema, not partition-value inference, types the copy;
    # an opening cost above the split size makes every staged file one task
    whole = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}
    with scoped_conf(spark, whole):
        staged = spark.read.format(fmt).schema(T.StructType(schema.fields + [T.StructField("__salt", T.IntegerType())])) \
            .load(stage).drop("__salt")
        replace_from_staged(staged, name, partitions_only=bool(parts))
    after = spark.table(name).where(where) if where else spark.table(name)
    if after.count() != rows:
        raise RuntimeError(f"{name}: row counts differ after compaction; the copy is in {stage}")
    remove_folder(spark, stage)
    return {"table": name, "method": "rewrite", "rows": rows}
