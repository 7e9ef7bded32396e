"""SQL runner and SQL-defined transforms.

``run_sql`` runs one statement (queries, DDL, SHOW ...) against a chosen
database, optionally with DataFrames bound as named views.  The analyzed
plan is built eagerly, so the previous current database is restored as
soon as the statement is planned; the returned DataFrame stays lazy.
"""

from __future__ import annotations

import contextlib
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ingestkit.session import scoped_conf


def load_statement(text: str | list[str]) -> str:
    """SQL text from a file's lines: joined with newlines and stripped, so a
    line ending in an alias and a line starting with FROM stay apart."""
    if isinstance(text, (list, tuple)):
        text = "\n".join(text)
    return text.strip().rstrip(";").strip()


_BINDING = threading.Lock()


def _temp_view(spark: SparkSession, name: str) -> DataFrame | None:
    """The temporary view of this name, if there is one."""
    try:
        found = spark.catalog.getTable(name)
    except AnalysisException:
        return None
    return spark.table(name) if found.isTemporary else None


@contextlib.contextmanager
def _bound(spark: SparkSession, views: dict[str, DataFrame]):
    """The frames under their view names while a statement is analyzed.  One
    statement at a time; views of the same names are put back afterwards."""
    with _BINDING:
        before = {n: held for n in views if (held := _temp_view(spark, n)) is not None}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        try:
            yield
        finally:
            for name in views:
                if name in before:
                    before[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, statement: str, *, database: str | None = None,
            views: dict[str, DataFrame] | None = None, args: dict | None = None,
            null_on_bad_cast: bool = False) -> DataFrame:
    """Run ``statement``; ``views`` are bound under their names while it is
    analyzed (the hand-over from a scan to a SQL transform).

    ``null_on_bad_cast=True`` analyzes it without ANSI mode: a cell that a
    CAST cannot convert becomes null instead of failing the job.  The choice
    is part of the analyzed plan, batch or stream.  It holds for the whole
    statement: whole numbers that overflow wrap, as they did before ANSI mode.  The
    session's switch is off while the statement is analyzed, so a statement that
    another thread analyzes in the same session at that moment, not through
    ``run_sql``, is analyzed without ANSI mode too.
    """
    previous = spark.catalog.currentDatabase()
    mode = {"spark.sql.ansi.enabled": "false"} if null_on_bad_cast else {}
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        with _bound(spark, views or {}), scoped_conf(spark, mode):
            return spark.sql(load_statement(statement), args=args)
    finally:
        if database:
            spark.catalog.setCurrentDatabase(previous)


def transform(df: DataFrame, statement: str, view: str = "genericTempView", *,
              null_on_bad_cast: bool = True) -> DataFrame:
    """Apply a SQL transform that reads ``view`` to ``df`` (batch or stream).
    Supplied statements turn bad cells into nulls unless told otherwise."""
    return run_sql(df.sparkSession, statement, views={view: df}, null_on_bad_cast=null_on_bad_cast)
