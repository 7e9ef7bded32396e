"""Streaming ingest: topic -> decode -> (SQL) -> append to a table.

Structured Streaming replaces both the continuous Kafka-to-table jobs and
the DStream micro-batch job: the same decode and SQL run on every
micro-batch, progress lives in a checkpoint, and a restart on the same
checkpoint resumes where the last committed batch ended (the file and
table sinks are exactly-once; ``foreachBatch`` handlers are made
idempotent by writing each batch id to its own folder with overwrite).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ingestkit.functions.json_codec import decode_json
from ingestkit.plans.sql import transform
from ingestkit.session import durable_root
from ingestkit.sources.messages import TopicSource, read_topic_stream


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """A stable checkpoint folder for a named stream: the same path in every
    application, so a restarted job resumes where the last one committed."""
    return f"{durable_root(spark)}/streams/{name}"


def with_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``default`` (next micro-batch as soon as the last one ends),
    ``availableNow``, ``once``, or a processing-time interval like '1 minute'."""
    if trigger == "default":
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def decoded_stream(spark: SparkSession, source: TopicSource, schema: str | T.StructType,
                   keep: tuple[str, ...] = (), options: dict[str, str] | None = None) -> DataFrame:
    """Message stream with its JSON value expanded into columns."""
    return decode_json(read_topic_stream(spark, source), schema, keep=keep, options=options)


@dataclass
class StreamIngest:
    source: TopicSource
    schema: str                                  # schema text of the JSON messages
    target_table: str
    statement: str | None = None                 # SQL over ``view``
    view: str = "genericTempStreamingView"
    partition_cols: list[str] = field(default_factory=list)
    trigger: str = "1 minute"
    checkpoint: str | None = None
    table_format: str = "parquet"
    table_path: str | None = None
    # sink options passed through, e.g. {"fanout-enabled": "true"} for a
    # table format whose partitioned writer can keep files open per partition
    options: dict[str, str] = field(default_factory=dict)
    decode_options: dict[str, str] = field(default_factory=dict)   # of from_json
    null_on_bad_cast: bool = True                # a CAST in ``statement`` that fails gives null


def start_ingest(spark: SparkSession, spec: StreamIngest) -> StreamingQuery:
    df = decoded_stream(spark, spec.source, spec.schema, options=spec.decode_options)
    if spec.statement:
        df = transform(df, spec.statement, spec.view, null_on_bad_cast=spec.null_on_bad_cast)
    writer = (df.writeStream.outputMode("append").format(spec.table_format)
              .option("checkpointLocation",
                      spec.checkpoint or checkpoint_for(spark, spec.target_table)))
    if spec.table_path:
        writer = writer.option("path", spec.table_path)
    for k, v in spec.options.items():
        writer = writer.option(k, v)
    if spec.partition_cols:
        writer = writer.partitionBy(*spec.partition_cols)
    return with_trigger(writer, spec.trigger).toTable(spec.target_table)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow``/``once`` query and surface its error."""
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {err}")
    return query


def start_microbatch(spark: SparkSession, source: TopicSource, schema: str | T.StructType,
                     handler: Callable[[DataFrame, int], None], *, trigger: str = "10 seconds",
                     checkpoint: str) -> StreamingQuery:
    """Decode every micro-batch of one or more topics and hand it to
    ``handler(df, batch_id)``; the handler runs once per batch on the
    driver but its DataFrame work runs on the executors."""
    raw = read_topic_stream(spark, source).select(
        F.col("value").cast("string").alias("results"), "topic")

    def each(batch: DataFrame, batch_id: int) -> None:
        handler(decode_json(batch, schema, column="results", keep=("topic",)), batch_id)

    writer = raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def batch_folder_writer(folder: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Idempotent handler: batch N replaces ``folder/batch_id=N``."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{folder.rstrip('/')}/batch_id={batch_id}")
    return write


def start_checked_ingest(spark: SparkSession, spec: StreamIngest, reject_table: str, *, name: str) -> StreamingQuery:
    """JSON messages appended to ``spec.target_table`` (which exists), those
    that do not fit the schema to ``reject_table``; either table gets every
    micro-batch of the stream ``name`` once, however often it is replayed."""
    from ingestkit.functions.rejects import REJECT_SCHEMA, decode_json_checked, split_rejects
    from ingestkit.sinks.publish import table_batch_writer
    from ingestkit.sinks.tables import table_exists

    if not table_exists(spark, reject_table):
        spark.createDataFrame([], REJECT_SCHEMA).write.format("parquet").saveAsTable(reject_table)
    to_target, to_rejects = table_batch_writer(spec.target_table, name), table_batch_writer(reject_table, name)

    def each(batch: DataFrame, batch_id: int) -> None:
        checked = decode_json_checked(batch, spec.schema, options=spec.decode_options)
        good, rejects = split_rejects(checked)
        if spec.statement:
            good = transform(good, spec.statement, spec.view, null_on_bad_cast=spec.null_on_bad_cast)
        to_target(good, batch_id)
        to_rejects(rejects, batch_id)

    writer = read_topic_stream(spark, spec.source).writeStream.foreachBatch(each).option(
        "checkpointLocation", spec.checkpoint or checkpoint_for(spark, name))
    return with_trigger(writer, spec.trigger).start()
