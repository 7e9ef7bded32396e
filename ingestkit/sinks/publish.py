"""Rows published to tables in steps that can be repeated.

What a run has stored in a folder of its own reaches the table either by
pointer (one catalog call sets the table's or the partition's location to the
folder: readers see the old rows or the new ones, and readers that began before
go on in the old folder, which is kept until the next run) or, for appends, by
moving the files into the table's folders under names that carry the run: a file
that has been moved is not moved again.  A run that fails before its rows are
stored leaves the table as it was.

File tables of the session catalog only (a table format commits by itself).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.sinks import files
from ingestkit.sinks.ledger import DONE, DROPPED, OPEN, STAGED, RunLedger
from ingestkit.sinks.tables import TableMissing, _describe, _is_file_table, _partition_columns, table_exists


def switch_table(spark: SparkSession, table: str, folder: str) -> None:
    """Point a table at a folder: one catalog call."""
    files.make_folder(spark, folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def switch_partition(spark: SparkSession, table: str, spec: dict[str, object], folder: str) -> None:
    """Point one partition at a folder: one catalog call."""
    files.make_folder(spark, folder)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {files.spec_sql(spec)} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} {files.spec_sql(spec)} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def partition_folders(spark: SparkSession, place: str, columns: list[str]) -> list[tuple[dict[str, object], str]]:
    """(spec, folder) of the partitions that a partitioned write left in ``place``."""
    found: list[tuple[dict[str, object], str]] = [({}, place)]
    for column in columns:
        deeper = []
        for spec, folder in found:
            for name, _, is_folder in files.listed(spark, folder):
                if is_folder and name.startswith(f"{column}="):
                    deeper.append((spec | files.partition_spec(name), f"{folder}/{name}"))
        found = deeper
    return found


def _checked(spark: SparkSession, table: str) -> tuple[str, str, list[str]]:
    if not table_exists(spark, table):
        raise TableMissing(f"table {table} does not exist")
    if not _is_file_table(spark, table):
        raise ValueError(f"{table} has a commit protocol of its own; append to it directly")
    info = _describe(spark, table)
    return info["Location"].rstrip("/"), (info.get("Provider") or "parquet").lower(), _partition_columns(spark, table)


def _stored(df: DataFrame, table: str, place: str, provider: str, parts: list[str]) -> None:
    columns = df.sparkSession.table(table).columns
    writer = df.select(*columns).write.mode("overwrite").format(provider)
    (writer.partitionBy(*parts) if parts else writer).save(place)


def replace_table(df: DataFrame, table: str, *, root: str | None = None, fmt: str = "orc") -> str:
    """Replace an unpartitioned table's rows by pointer (``root``, ``fmt``: where
    and how a new table is created).  Returns the folder of the new version."""
    spark, version = df.sparkSession, files.new_id("v")
    if not table_exists(spark, table):
        if root is None:
            raise TableMissing(f"table {table} does not exist (root= says where to create it)")
        place = f"{root.rstrip('/')}/{version}"
        df.write.format(fmt).option("path", place).saveAsTable(table)
        return place
    now, provider, parts = _checked(spark, table)
    if parts:
        raise ValueError(f"{table} is partitioned: replace_partitions switches its partitions")
    above, last = now.rsplit("/", 1)
    base = above if last.startswith("v-") else f"{now}__versions"
    place = f"{base}/{version}"
    _stored(df, table, place, provider, [])
    switch_table(spark, table, place)
    for name, _, is_folder in files.listed(spark, base):          # versions before the previous one
        if is_folder and name.startswith("v-") and f"{base}/{name}" not in (place, now):
            files.delete(spark, f"{base}/{name}")
    return place


def replace_partitions(df: DataFrame, table: str) -> list[dict[str, object]]:
    """Replace the partitions that ``df`` has rows for, each by pointer; the
    others stay.  Returns their specs.  A partition's version before the previous
    one is removed."""
    spark, version = df.sparkSession, files.new_id("v")
    root, provider, parts = _checked(spark, table)
    if not parts:
        raise ValueError(f"{table} has no partitions: replace_table switches the table")
    place = f"{root}__versions/{version}"
    _stored(df, table, place, provider, parts)
    done = []
    for spec, folder in partition_folders(spark, place, parts):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {files.spec_sql(spec)}")
        before = files.partition_location(spark, table, spec)
        switch_partition(spark, table, spec, folder)
        inside = folder.removeprefix(place + "/")
        for name, _, is_folder in files.listed(spark, f"{root}__versions"):
            old = f"{root}__versions/{name}/{inside}"
            if is_folder and old not in (folder, before):
                files.delete(spark, old)
        done.append(spec)
    return done


def adopt_files(spark: SparkSession, table: str, place: str, run: str) -> None:
    """Move what a run stored in ``place`` into the table's folders."""
    root, _provider, parts = _checked(spark, table)
    for spec, folder in partition_folders(spark, place, parts):
        target = root
        if spec:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {files.spec_sql(spec)}")
            target = files.partition_location(spark, table, spec)
            files.make_folder(spark, target)
        for name, _size in files.data_files(spark, folder):
            files.move(spark, f"{folder}/{name}", f"{target}/{run}-{name}")
    spark.catalog.refreshTable(table)


def append_once(df: DataFrame, table: str, run: str) -> bool:
    """Append ``df`` unless the run of this name has been appended before.

    A run that was cut while it computed its rows stores them anew (over what
    was left); one that was cut while its files moved goes on with the rest.
    Returns whether rows were appended by this call.
    """
    spark = df.sparkSession
    root, provider, parts = _checked(spark, table)
    ledger = RunLedger(spark, root + "__runs")
    known = next((r for r in ledger.runs() if r.run == run), None)
    if known is not None and known.state == DONE:
        return False
    if known is None or known.state != STAGED:
        known = ledger.begin(None, run, f"{root}__runs/{run}")
        _stored(df, table, known.place, provider, parts)
        known = ledger.mark(known, STAGED)
    adopt_files(spark, table, known.place, run)
    ledger.mark(known, DONE)
    files.delete(spark, known.place)
    return True


def table_batch_writer(table: str, query: str, keep_runs: int = 1000) -> Callable[[DataFrame, int], None]:
    """A handler of micro-batches that appends batch N of ``query`` to a table
    once, however often it is replayed.  The ledger keeps the last ``keep_runs``
    batches (a stream replays its last one only)."""
    def write(df: DataFrame, batch_id: int) -> None:
        append_once(df, table, f"{query}-{batch_id}")
        if batch_id % keep_runs == 0:
            ledger = RunLedger.of_table(df.sparkSession, table)
            mine = [r for r in ledger.runs() if r.run.rsplit("-", 1)[0] == query and r.state == DONE]
            ledger.forget(mine[:-keep_runs])
    return write


def packed(sizes: list[tuple[str, int]], capacity: int) -> list[list[str]]:
    """First fit decreasing: files in bins of at most ``capacity`` bytes; bins
    of one file are left out, there is nothing to merge."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= capacity:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def _finish_packing(spark: SparkSession, table: str, place: str, run: str) -> None:
    adopt_files(spark, table, f"{place}/rows", run)
    for path in files.read_text(spark, f"{place}/replaced").splitlines():
        files.delete(spark, path)
    spark.catalog.refreshTable(table)


def pack_small_files(spark: SparkSession, table: str, *, target_file_bytes: int = 128 << 20, bins_a_job: int = 64) -> dict[str, int]:
    """Merge the files below ``target_file_bytes``; files at the target stay.

    The small files of every partition are packed into bins (first fit
    decreasing over their sizes, which is all that the driver reads); one task
    reads a bin and writes one file, without a shuffle.  Rows are counted before
    anything is published.  The new files are moved in before the old ones are
    deleted, both from a ledger, so a run that was cut is finished by the next
    one; a reader that lists the table between the two sees rows twice, so run it
    when nobody reads, or use ``compact_table`` with a table format.
    """
    root, provider, parts = _checked(spark, table)
    ledger = RunLedger(spark, root + "__runs")
    for r in ledger.runs():
        if r.feed_id == "pack" and r.state == STAGED:
            _finish_packing(spark, table, r.place, r.run)
            ledger.mark(r, DONE)
        elif r.feed_id == "pack" and r.state == OPEN:
            files.delete(spark, r.place)
            ledger.mark(r, DROPPED)
    if any(name == "_spark_metadata" for name in files.all_names(spark, root)):
        raise ValueError(f"{table} is written by a streaming file sink")
    folders = [({}, root)]
    if parts:
        rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
        specs = [files.partition_spec(r.partition) for r in rows]
        folders = [(spec, files.partition_location(spark, table, spec)) for spec in specs]
    work = [(spec, folder, names) for spec, folder in folders
            for names in packed([f for f in files.data_files(spark, folder) if f[1] < target_file_bytes], target_file_bytes)]
    if not work:
        return {"files_before": 0, "files_after": 0, "rows": 0}
    run = files.new_id("pack")
    entry = ledger.begin("pack", run, f"{root}__runs/{run}")
    fields = [f for f in spark.table(table).schema.fields if f.name not in parts]
    schema = spark.createDataFrame([], spark.table(table).schema).select(*[f.name for f in fields]).schema
    spec_columns = {f.name: f.dataType for f in spark.table(table).schema.fields}
    old, n_rows = [], 0
    for first in range(0, len(work), bins_a_job):
        job = None
        for spec, folder, names in work[first:first + bins_a_job]:
            paths = [f"{folder}/{n}" for n in names]
            old += paths
            one = spark.read.format(provider).schema(schema).load(paths).coalesce(1)
            one = one.select("*", *[F.lit(spec[p]).cast(spec_columns[p]).alias(p) for p in parts])
            job = one if job is None else job.union(one)
        writer = job.write.mode("append").format(provider)
        (writer.partitionBy(*parts) if parts else writer).save(f"{entry.place}/rows")
    n_rows = spark.read.format(provider).schema(schema).load(old).count()
    written = spark.read.format(provider).schema(spark.table(table).schema).load(f"{entry.place}/rows").count()
    if n_rows != written:
        raise RuntimeError(f"{table}: {n_rows} rows were read and {written} written; nothing was replaced")
    files.write_text(spark, f"{entry.place}/replaced", "\n".join(old))
    entry = ledger.mark(entry, STAGED)
    _finish_packing(spark, table, entry.place, run)
    ledger.mark(entry, DONE)
    files.delete(spark, entry.place)
    return {"files_before": len(old), "files_after": len(work), "rows": n_rows}
