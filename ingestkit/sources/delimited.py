"""Delimited-file scan with a declared schema (schema-on-read).

The declared schema is applied *by position*; a header line, when
present, is skipped, not matched.  Bad cells become null (PERMISSIVE).
``quote=""`` turns quoting off, so a quoted field holding the separator
splits in two and keeps its quote characters.  Globs are resolved by
Spark; splitting, column pruning and filter pushdown into the scan are
left to the file source.  Timestamps are read with Spark's own rules (with
or without a fraction, a ``T`` or a time of day); ``options`` are the file
source's and win over everything set here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ingestkit.functions.schema_text import as_struct

# Written timestamps keep their microseconds (Spark's default keeps millis).
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_delimited(spark: SparkSession, path: str | list[str], schema: str | T.StructType, *,
                   fmt: str = "csv", header: bool = False, sep: str = ",",
                   quote: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    reader = (spark.read.format(fmt).schema(as_struct(schema))
              .option("header", str(bool(header)).lower())
              .option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if quote is not None:
        reader = reader.option("quote", quote)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", header: bool = False,
                    quote: str | None = None, mode: str = "error") -> None:
    """Write ``df`` as delimited text (one file per task)."""
    writer = (df.write.mode(mode).format("csv").option("sep", sep)
              .option("header", str(bool(header)).lower())
              .option("timestampFormat", TIMESTAMP_FORMAT)
              .option("timestampNTZFormat", TIMESTAMP_FORMAT))
    if quote is not None:
        writer = writer.option("quote", quote)
    writer.save(path)
