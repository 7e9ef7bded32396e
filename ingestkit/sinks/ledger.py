"""A ledger of the runs that write to a table.

A run has one small JSON file in a folder beside the table: run, feed_id, state
and place.  It is open while it computes its rows, staged once they are stored
under ``place``, and done when the target shows them.  A run that was cut between
staged and done is finished from what it stored; one that was cut before is
dropped.  The file is replaced at every step, so the ledger has one entry a run
and is the only thing that a repeat has to read; ``spark.read.json`` reads it too.

One writer a table at a time.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession

from ingestkit.sinks import files

OPEN, STAGED, DONE, DROPPED = "open", "staged", "done", "dropped"


@dataclass(frozen=True)
class Run:
    run: str
    feed_id: str | None
    state: str
    place: str
    began: float


class RunLedger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        files.make_folder(spark, folder)

    @classmethod
    def of_table(cls, spark: SparkSession, table: str) -> RunLedger:
        return cls(spark, files.table_location(spark, table) + "__runs")

    def _write(self, run: Run) -> Run:
        files.write_text(self.spark, f"{self.folder}/{run.run}.json", json.dumps(asdict(run)))
        return run

    def begin(self, feed_id: str | None, run: str, place: str) -> Run:
        return self._write(Run(run, feed_id, OPEN, place, time.time()))

    def mark(self, run: Run, state: str) -> Run:
        return self._write(replace(run, state=state))

    def runs(self) -> list[Run]:
        """All runs in the order in which they began."""
        found = [Run(**json.loads(files.read_text(self.spark, f"{self.folder}/{name}")))
                 for name, _ in files.data_files(self.spark, self.folder)]
        return sorted(found, key=lambda r: r.began)

    def forget(self, runs: list[Run]) -> None:
        for r in runs:
            files.delete(self.spark, f"{self.folder}/{r.run}.json")
