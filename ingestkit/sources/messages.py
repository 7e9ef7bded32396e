"""Message-topic streams.

With brokers configured, topics are read with Spark's Kafka source.  A topic
can also be a folder of parquet files with the columns that consumers read
(``value``, ``topic``): that is how topics are replayed offline.  Either way
the plan after the source is the same.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
])


@dataclass
class TopicSource:
    """Where a topic stream comes from.

    ``topics`` is a comma-separated subscription list.  Give ``brokers``
    for a live cluster, or ``folder`` for file-backed topics (one
    sub-folder per topic).
    """

    topics: str
    brokers: str | None = None
    folder: str | None = None
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None     # caps a Kafka micro-batch
    options: dict[str, str] = field(default_factory=dict)   # e.g. {"kafka.group.id": "g"}


def topic_glob(folder: str, topics: str) -> str:
    names = [t for t in topics.split(",") if t]
    return f"{folder.rstrip('/')}/{names[0]}" if len(names) == 1 else \
        f"{folder.rstrip('/')}/{{{','.join(names)}}}"


def read_topic_stream(spark: SparkSession, src: TopicSource) -> DataFrame:
    """A streaming DataFrame with the message columns."""
    if src.brokers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", src.brokers)
                  .option("subscribe", src.topics)
                  .option("startingOffsets", src.starting_offsets)
                  .option("failOnDataLoss", str(src.fail_on_data_loss).lower()))
        if src.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", src.max_offsets_per_trigger)
        for k, v in src.options.items():
            reader = reader.option(k, v)
        return reader.load()
    if not src.folder:
        raise ValueError("TopicSource needs brokers or a folder")
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if src.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", src.max_files_per_trigger)
    return reader.parquet(topic_glob(src.folder, src.topics))


def publish_batch(df: DataFrame, folder: str, topic: str, value: Column) -> None:
    """Append a batch of rows to a file-backed topic (a narrow write)."""
    messages = df.select(value.cast("binary").alias("value"), F.lit(topic).alias("topic"))
    messages.write.mode("append").parquet(f"{folder.rstrip('/')}/{topic}")
