"""Streaming workloads over ``events`` replayed as a message topic.

Each workload publishes ``events`` as JSON messages into a file-backed
topic under the work root, runs the streaming job
with an ``availableNow`` trigger, and returns a batch read of what the
job wrote.  Timestamps declared as ``timestamp`` are read in the session
zone and handed back as wall-clock (``timestamp_ntz``) values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ingestkit.functions.json_codec import encode_json
from ingestkit.session import scratch_dir, unique_table
from ingestkit.sinks.publish import table_batch_writer
from ingestkit.sinks.tables import create_table
from ingestkit.sources.messages import TopicSource, publish_batch
from ingestkit.streaming.ingest import (StreamIngest, batch_folder_writer, run_to_end,
                                        start_checked_ingest, start_ingest, start_microbatch)
from ingestkit.workloads.common import staging, table
from ingestkit.workloads.ingest import TIME_FORMS_SQL, event_time_forms

EVENTS_SCHEMA = ("event_id:long,ts:timestamp,user_id:long,event_type:string,value:double,"
                 "props:string")
SPLIT_TS = "2024-01-16 00:00:00"


def _json_value(ev, corrupt: bool = False):
    text = encode_json(ev)
    if corrupt:
        text = F.when(F.col("event_type") == "error", F.lit("bad{")).otherwise(text)
    return text


def _publish_events(spark, sf_dir, folder, topic="events", *, corrupt=False, where=None):
    ev = table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.where(where)
    with staging():
        publish_batch(ev, folder, topic, _json_value(ev, corrupt))


def _wall_clock(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if "ts" in df.columns else df


def stream_json_decode(spark, sf_dir):
    folder = scratch_dir(spark, "topics")
    _publish_events(spark, sf_dir, folder, corrupt=True)
    spec = StreamIngest(source=TopicSource("events", folder=folder), schema=EVENTS_SCHEMA,
                        target_table=unique_table(spark, "events_decoded"),
                        trigger="availableNow", checkpoint=scratch_dir(spark, "ckpt"),
                        table_path=scratch_dir(spark, "tbl-events-decoded"))
    run_to_end(start_ingest(spark, spec))
    return _wall_clock(spark.table(spec.target_table))


STREAM_SQL = """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date
FROM genericTempStreamingView
"""


def _two_arrivals(spark, sf_dir, partition_cols):
    # first half of the topic, run, second half arrives, restart on the
    # same checkpoint: every event lands exactly once
    folder = scratch_dir(spark, "topics")
    spec = StreamIngest(source=TopicSource("events", folder=folder), schema=EVENTS_SCHEMA,
                        target_table=unique_table(spark, "events_stream"), statement=STREAM_SQL,
                        partition_cols=partition_cols, trigger="availableNow",
                        checkpoint=scratch_dir(spark, "ckpt"),
                        table_path=scratch_dir(spark, "tbl-events-stream"))
    early = F.coalesce(F.col("ts") < F.lit(SPLIT_TS), F.lit(False))
    _publish_events(spark, sf_dir, folder, where=early)
    run_to_end(start_ingest(spark, spec))
    _publish_events(spark, sf_dir, folder, where=~early)
    run_to_end(start_ingest(spark, spec))
    run_to_end(start_ingest(spark, spec))          # nothing new: adds nothing
    return spark.table(spec.target_table)


def stream_sql_append(spark, sf_dir):
    return _two_arrivals(spark, sf_dir, [])


def stream_partitioned_append(spark, sf_dir):
    return _two_arrivals(spark, sf_dir, ["event_type"])


def stream_microbatch_json(spark, sf_dir, files_per_trigger=4):
    # two topics, one subscription, a few files a micro-batch
    folder = scratch_dir(spark, "topics")
    kinds = F.coalesce(F.col("event_type").isin("click", "view", "purchase"), F.lit(False))
    _publish_events(spark, sf_dir, folder, "events-a", where=kinds)
    _publish_events(spark, sf_dir, folder, "events-b", where=~kinds)
    out = scratch_dir(spark, "microbatch-out")
    source = TopicSource("events-a,events-b", folder=folder,
                         max_files_per_trigger=files_per_trigger)
    run_to_end(start_microbatch(spark, source, EVENTS_SCHEMA, batch_folder_writer(out),
                                trigger="availableNow", checkpoint=scratch_dir(spark, "ckpt")))
    return _wall_clock(spark.read.parquet(out).drop("batch_id", "topic"))


def json_timestamp_forms(spark, sf_dir):
    # times in several text forms inside JSON messages, decoded by a stream
    folder = scratch_dir(spark, "topics")
    times = event_time_forms(table(spark, sf_dir, "events"))
    with staging():
        publish_batch(times, folder, "times", encode_json(times))
    spec = StreamIngest(source=TopicSource("times", folder=folder), schema="event_id:long,ts:timestamp",
                        target_table=unique_table(spark, "event_times"), trigger="availableNow",
                        checkpoint=scratch_dir(spark, "ckpt"), table_path=scratch_dir(spark, "tbl-times"))
    run_to_end(start_ingest(spark, spec))
    return _wall_clock(spark.table(spec.target_table))


STREAM_CAST_SQL = """
SELECT event_id, CAST(value AS DOUBLE) AS value, CAST(ts AS DATE) AS event_date FROM genericTempStreamingView
"""


def stream_bad_casts(spark, sf_dir):
    # cells that a CAST cannot convert are null; half of the topic arrives
    # before a restart
    folder = scratch_dir(spark, "topics")
    ev = table(spark, sf_dir, "events")
    text = ev.select("event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.col("value").cast("string")).alias("value"), F.col("ts").cast("string").alias("ts"))
    spec = StreamIngest(source=TopicSource("cells", folder=folder), schema="event_id:long,value:string,ts:string",
                        target_table=unique_table(spark, "cells"), statement=STREAM_CAST_SQL, trigger="availableNow",
                        checkpoint=scratch_dir(spark, "ckpt"), table_path=scratch_dir(spark, "tbl-cells"))
    for part in (text.where("event_id % 2 = 0"), text.where("event_id % 2 <> 0")):
        with staging():
            publish_batch(part, folder, "cells", encode_json(part))
        run_to_end(start_ingest(spark, spec))
    return spark.table(spec.target_table)


def stream_batches_once(spark, sf_dir):
    # micro-batches appended to a partitioned table, then all of them replayed
    # by the same stream from a lost checkpoint
    folder, name = scratch_dir(spark, "topics"), unique_table(spark, "events_once")
    _publish_events(spark, sf_dir, folder)
    ev = table(spark, sf_dir, "events")
    with staging():
        create_table(ev.select(*[c for c in ev.columns if c != "ts"]), name, path=scratch_dir(spark, "tbl-events-once"), partition_by=["event_type"])
    write = table_batch_writer(name, "events")
    for _ in range(2):
        run_to_end(start_microbatch(spark, TopicSource("events", folder=folder, max_files_per_trigger=2), EVENTS_SCHEMA, write,
                                    trigger="availableNow", checkpoint=scratch_dir(spark, "ckpt")))
    return spark.table(name)


def _checked_stream(spark, sf_dir):
    folder, good, rejects = scratch_dir(spark, "topics"), unique_table(spark, "events_good"), unique_table(spark, "events_bad")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    nth = F.col("event_id") % 50
    text = F.when(nth == 1, F.lit("bad{")).when(nth == 2, F.concat(F.lit('{"event_id": "x'), "event_id", F.lit('"}'))).otherwise(encode_json(ev))
    with staging():
        publish_batch(ev, folder, "checked", text)
        create_table(ev, good, path=scratch_dir(spark, "tbl-events-good"))
    spec = StreamIngest(source=TopicSource("checked", folder=folder, max_files_per_trigger=2), target_table=good, trigger="availableNow",
                        schema="event_id:long,user_id:long,event_type:string,value:double", checkpoint=scratch_dir(spark, "ckpt"))
    run_to_end(start_checked_ingest(spark, spec, rejects, name="checked"))
    return good, rejects


def stream_checked_rows(spark, sf_dir):
    return spark.table(_checked_stream(spark, sf_dir)[0])


def stream_rejects(spark, sf_dir):
    return spark.table(_checked_stream(spark, sf_dir)[1])


QUERIES = {
    "stream_batches_once": stream_batches_once,
    "stream_checked_rows": stream_checked_rows,
    "stream_rejects": stream_rejects,
    "stream_json_decode": stream_json_decode,
    "stream_sql_append": stream_sql_append,
    "stream_partitioned_append": stream_partitioned_append,
    "stream_microbatch_json": stream_microbatch_json,
    "json_timestamp_forms": json_timestamp_forms,
    "stream_bad_casts": stream_bad_casts,
}


def _null_if_error(col):
    return f"CASE WHEN event_type = 'error' THEN NULL ELSE {col} END AS {col}"


ORACLE = {
    "stream_batches_once": "SELECT event_id, user_id, event_type, value, props FROM events",
    "stream_checked_rows": "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 50 NOT IN (1, 2)",
    "stream_rejects": """SELECT 'checked' AS file,
       CASE WHEN event_id % 50 = 1 THEN 'bad{' ELSE '{"event_id": "x' || event_id || '"}' END AS text,
       CASE WHEN event_id % 50 = 1 THEN 'not JSON' ELSE 'value of event_id' END AS reason FROM events WHERE event_id % 50 IN (1, 2)""",
    "json_timestamp_forms": TIME_FORMS_SQL,
    "stream_bad_casts": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CAST(ts AS DATE) AS event_date FROM events""",
    "stream_json_decode": "SELECT " + ", ".join(_null_if_error(c) for c in (
        "event_id", "ts", "user_id", "event_type", "value", "props")) + " FROM events",
    "stream_sql_append": """SELECT event_id, user_id, event_type, value,
       CAST(ts AS DATE) AS event_date FROM events""",
    "stream_partitioned_append": """SELECT event_id, user_id, event_type, value,
       CAST(ts AS DATE) AS event_date FROM events""",
    "stream_microbatch_json": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
}
