"""Avro payload columns, by Spark's own Avro module.

The module is a separate Spark package (``spark-avro``); a cluster that
uses these functions starts with it.  Nothing is emulated without it.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _require_module() -> None:
    spark = SparkSession.getActiveSession()
    loader = spark.sparkContext._jvm.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroUtils")
    except Exception as err:
        raise RuntimeError("Spark's Avro module is not on the class path; start the session with the "
                           "spark-avro package of your Spark version") from err


def to_avro(data: Column, schema: str = "") -> Column:
    """``data`` encoded as Avro binary.  A null struct has no payload (null),
    so encode ``struct(data.*)`` where a null message must not become a
    delete marker of a compacted topic."""
    from pyspark.sql.avro import functions as A

    _require_module()
    return A.to_avro(data, schema)


def from_avro(value: Column, writer_schema: str, reader_schema: str | None = None, mode: str = "FAILFAST") -> Column:
    """Avro binary decoded with the schema it was written with, and resolved to
    ``reader_schema`` by field names (Avro itself is positional: decoding with
    the reader's schema alone would swap fields that changed places)."""
    from pyspark.sql.avro import functions as A

    _require_module()
    options = {"mode": mode} | ({"avroSchema": reader_schema} if reader_schema else {})
    return A.from_avro(value, writer_schema, options)


def message_struct(data: str, fields: list[str]) -> Column:
    """``struct(data.*)``: not null even where ``data`` is."""
    return F.struct(*[F.col(data)[f].alias(f) for f in fields])
