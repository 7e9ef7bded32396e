"""SCD2 write-back into a table.

A dimension partitioned by its current flag keeps history in place.  A run reads
the current rows (PartitionFilters), and of the closed ones only those that end
after the feed's first date (a pushed filter: Parquet skips the files of earlier
runs by their statistics).  It stores the new current rows and the newly closed
rows in a folder of its own, notes that in the table's run ledger, and publishes
them: the closed rows' files move into the history partition under names that
carry the run, then one catalog call points the current partition at the run's
folder.  Both steps can be repeated, so a run that was cut anywhere is finished
by the next one from what it stored, without comparing rows: versions that look
alike stay as many as they are.

Readers that began before the switch go on reading the previous folder, which is
kept until the next run; between the two steps a closed version is seen both as
closed and as current.  One writer a table at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.operators.cdc import HIGH_DATE, Scd2Columns, scd2_apply
from ingestkit.session import remove_folder, scratch_dir
from ingestkit.sinks import files
from ingestkit.sinks.ledger import DONE, DROPPED, OPEN, STAGED, Run, RunLedger
from ingestkit.sinks.publish import switch_partition
from ingestkit.sinks.tables import _describe, _partition_columns, replace_from_staged


def _replace_whole(spark: SparkSession, target_table: str, staging: DataFrame, options: dict) -> dict[str, object]:
    stage = scratch_dir(spark, "scd2-stage")
    scd2_apply(spark.table(target_table), staging, **options).write.parquet(stage)
    replace_from_staged(spark.read.parquet(stage), target_table)
    remove_folder(spark, stage)
    return {"table": target_table, "replaced": "table"}


def _publish(spark: SparkSession, table: str, flag: str, run: str, place: str) -> None:
    """Show what a run stored; every step may have been done before."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {files.spec_sql({flag: False})}")
    history = files.partition_location(spark, table, {flag: False})
    files.make_folder(spark, history)
    for name, _size in files.data_files(spark, f"{place}/{flag}=false"):
        files.move(spark, f"{place}/{flag}=false/{name}", f"{history}/{run}-{name}")
    switch_partition(spark, table, {flag: True}, f"{place}/{flag}=true")


def _clear(spark: SparkSession, runs: list[Run], root: str, flag: str, keep: set[str]) -> None:
    """Remove the folders of earlier runs, but for those in ``keep``."""
    for r in runs:
        if r.state in (DONE, DROPPED) and r.place not in keep:
            files.delete(spark, r.place)
    if f"{root}/{flag}=true" not in keep:
        files.delete(spark, f"{root}/{flag}=true")


def finish_runs(spark: SparkSession, table: str, ledger: RunLedger, flag: str) -> list[Run]:
    """Finish the runs that were cut after they had stored their rows, drop the
    others; returns all runs so far."""
    found = []
    for r in ledger.runs():
        if r.state == STAGED:
            _publish(spark, table, flag, r.run, r.place)
            r = ledger.mark(r, DONE)
        elif r.state == OPEN:
            files.delete(spark, r.place)
            r = ledger.mark(r, DROPPED)
        found.append(r)
    return found


def write_back(target_table: str, staging: DataFrame, *, feed_id: str | None = None, **options) -> dict[str, object]:
    """Apply ``staging`` to a dimension table and store the result.

    ``feed_id`` names the feed (a file, a batch): a feed that the ledger has as
    done is not applied again.  Without it every call applies its feed, which
    with the default semantics changes nothing if it was the last one applied.
    A table that is not partitioned by the current flag alone, and the compat
    mode, replace the whole table.
    """
    spark = staging.sparkSession
    c = options.get("columns") or Scd2Columns()
    flag = c.is_current
    if _partition_columns(spark, target_table) != [flag] or options.get("mode") == "compat":
        return _replace_whole(spark, target_table, staging, options)
    info = _describe(spark, target_table)
    root, provider = info["Location"].rstrip("/"), (info.get("Provider") or "parquet").lower()
    ledger = RunLedger(spark, root + "__runs")
    earlier = finish_runs(spark, target_table, ledger, flag)
    if feed_id is not None and any(r.state == DONE and r.feed_id == feed_id for r in earlier):
        return {"table": target_table, "replaced": "nothing", "feed_id": feed_id}

    name = files.new_id("run")
    run = ledger.begin(feed_id, name, f"{root}/{name}")
    table = spark.table(target_table)
    began = staging.agg(F.min(F.col(c.src_mod_dt).cast(table.schema[c.end].dataType))).first()[0]
    result = scd2_apply(table.where(F.col(flag)), staging, closed=table.where(~F.col(flag)),
                        feed_from=began if began is not None else HIGH_DATE, **options)
    result.select(*table.columns).write.partitionBy(flag).format(provider).save(run.place)
    run = ledger.mark(run, STAGED)

    before = f"{root}/{flag}=true"
    if spark.sql(f"SHOW PARTITIONS {target_table} {files.spec_sql({flag: True})}").count():
        before = files.partition_location(spark, target_table, {flag: True})
    _publish(spark, target_table, flag, run.run, run.place)
    ledger.mark(run, DONE)
    previous = before.removesuffix(f"/{flag}=true")
    _clear(spark, earlier, root, flag, {run.place, previous if previous != root else before})
    return {"table": target_table, "replaced": "current rows", "run": run.run, "feed_id": feed_id}
