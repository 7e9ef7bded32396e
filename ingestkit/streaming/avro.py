"""Republish a JSON topic as Avro, and decode an Avro topic to columns.

Both need Spark's Avro module, see :mod:`ingestkit.functions.avro`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ingestkit.functions.avro import from_avro, message_struct, to_avro
from ingestkit.functions.schema_text import as_struct
from ingestkit.sources.messages import TopicSource, read_topic_stream
from ingestkit.streaming.ingest import checkpoint_for, with_trigger


def avro_stream(spark: SparkSession, source: TopicSource, json_schema: str | T.StructType, *,
                avro_schema: str = "", key: str | None = None) -> DataFrame:
    """JSON messages re-encoded as Avro binary ``value`` (plus ``key``)."""
    st = as_struct(json_schema)
    msgs = read_topic_stream(spark, source)
    data = msgs.select(F.from_json(F.col("value").cast("string"), st).alias("data"))
    key_col = F.col("data")[key].cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return data.select(to_avro(message_struct("data", st.fieldNames()), avro_schema).alias("value"),
                       key_col.alias("key"))


def publish_avro(spark: SparkSession, source: TopicSource, json_schema: str | T.StructType, *,
                 topic: str, brokers: str, checkpoint: str, avro_schema: str = "",
                 key: str | None = None, trigger: str = "default") -> StreamingQuery:
    """Start the republishing stream into a topic."""
    out = avro_stream(spark, source, json_schema, avro_schema=avro_schema, key=key)
    writer = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
              .option("topic", topic).outputMode("append").option("checkpointLocation", checkpoint))
    return with_trigger(writer, trigger).start()


def consume_avro(spark: SparkSession, source: TopicSource, writer_schema: str, reader_schema: str | None = None, *,
                 mode: str = "FAILFAST") -> DataFrame:
    """Avro topic decoded to columns (streaming DataFrame): written with
    ``writer_schema``, read as ``reader_schema`` (default: as written)."""
    msgs = read_topic_stream(spark, source)
    return msgs.select(from_avro(F.col("value"), writer_schema, reader_schema, mode).alias("data")).select("data.*")


def ingest_avro(spark: SparkSession, source: TopicSource, writer_schema: str, target_table: str, *,
                reader_schema: str | None = None, mode: str = "FAILFAST", checkpoint: str | None = None,
                trigger: str = "default", table_format: str = "parquet", table_path: str | None = None) -> StreamingQuery:
    """The decoded stream appended to a table."""
    out = consume_avro(spark, source, writer_schema, reader_schema, mode=mode)
    writer = out.writeStream.outputMode("append").format(table_format).option(
        "checkpointLocation", checkpoint or checkpoint_for(spark, target_table))
    if table_path:
        writer = writer.option("path", table_path)
    return with_trigger(writer, trigger).toTable(target_table)
