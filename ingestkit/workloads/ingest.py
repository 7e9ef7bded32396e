"""Batch ingest workloads: delimited files -> schema -> SQL -> tables.

Each workload first stages one of the provided tables as delimited text
under the session's work root (a Spark write, so the input grows with the
table), then ingests it the way the file-to-table jobs do, and returns
what a reader of the target table sees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ingestkit.functions.schema_text import all_string_schema, apply_schema
from ingestkit.functions.rejects import load_checked, read_delimited_checked
from ingestkit.plans.ingest import BatchIngest, ingest_batch, ingest_frame
from ingestkit.plans.sql import run_sql
from ingestkit.session import scratch_dir, unique_table
from ingestkit.sinks.content import append_with_content_check
from ingestkit.sinks.publish import append_once, pack_small_files, replace_partitions, replace_table
from ingestkit.sinks.tables import append_with_reconcile, compact_table, create_table
from ingestkit.sources.delimited import read_delimited, write_delimited
from ingestkit.workloads.common import register_views, staging, table

ORDERS_SCHEMA = ("o_orderkey:long,o_custkey:long,o_orderstatus:string,o_totalprice:double,"
                 "o_orderdate:date,o_orderpriority:string")
EVENTS_SCHEMA = ("event_id:long,ts:timestamp,user_id:long,event_type:string,value:double,"
                 "props:string")
LINEITEM_SCHEMA = ("l_orderkey:long,l_partkey:long,l_suppkey:long,l_linenumber:integer,"
                   "l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,"
                   "l_returnflag:string,l_linestatus:string,l_shipdate:date")


def _orders_csv(spark, sf_dir, *, sep="|", header=True):
    path = scratch_dir(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    with staging():
        write_delimited(orders, path, sep=sep, header=header)
    return path


def csv_schema_on_read(spark, sf_dir):
    path = _orders_csv(spark, sf_dir)
    return read_delimited(spark, path, ORDERS_SCHEMA, header=True, sep="|")


def csv_quote_off(spark, sf_dir):
    # a field holding the separator is quoted on write; reading with quoting
    # off splits it in two and keeps the quote characters
    path = scratch_dir(spark, "part-csv")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(", ", "p_brand", "p_type").alias("label"),
        "p_size", "p_retailprice")
    with staging():
        write_delimited(part, path, sep=",")
    return read_delimited(spark, path, "p_partkey:long,brand:string,ptype:string,"
                          "p_size:integer,p_retailprice:double", sep=",", quote="")


def apply_schema_text(spark, sf_dir):
    # raw text first (every column a string), then the typed schema text
    path = scratch_dir(spark, "events-text")
    with staging():
        write_delimited(table(spark, sf_dir, "events"), path, sep=",")
    raw = read_delimited(spark, path, all_string_schema(EVENTS_SCHEMA), sep=",")
    typed = apply_schema(raw, EVENTS_SCHEMA)
    # "timestamp" reads in the session zone; hand back the wall-clock value
    return typed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# The same instants in several text forms, by event; the forms carry what
# they can: seconds, milliseconds, microseconds or the day.
TIMESTAMP_FORMS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS",
                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd"]


def event_time_forms(events):
    """event_id and the event's time as text, its form chosen by the id."""
    text = F.lit(None).cast("string")
    for i, form in enumerate(TIMESTAMP_FORMS):
        text = F.when(F.col("event_id") % len(TIMESTAMP_FORMS) == i, F.date_format("ts", form)).otherwise(text)
    return events.select("event_id", text.alias("ts"))


def csv_timestamp_forms(spark, sf_dir):
    path = scratch_dir(spark, "event-times")
    with staging():
        write_delimited(event_time_forms(table(spark, sf_dir, "events")), path)
    read = read_delimited(spark, path, "event_id:long,ts:timestamp")
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


GSOD_STYLE_SQL = """
SELECT CAST(event_id AS BIGINT) AS event_id,
       CAST(ts AS DATE) AS rep_date,
       name,
       event_type,
       CAST(value AS DOUBLE) AS value
FROM genericTempView
"""


def gsod_style_cast(spark, sf_dir):
    # wide all-string source with a header, quoted names holding the
    # separator, and unparseable cells
    path = scratch_dir(spark, "events-wide")
    ev = table(spark, sf_dir, "events")
    wide = ev.select(
        "event_id", "ts", "user_id",
        F.concat_ws(", ", "event_type", F.col("user_id").cast("string")).alias("name"),
        "event_type",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
         .otherwise(F.col("value").cast("string")).alias("value"),
        "props", F.lit("x").alias("pad1"), F.lit("y").alias("pad2"))
    with staging():
        write_delimited(wide, path, sep=",", header=True)
    spec = BatchIngest(source_path=path, schema=",".join(
        f"{c}:string" for c in wide.columns), target_table="unused", header=True,
        statement=GSOD_STYLE_SQL)
    return ingest_frame(spark, spec)


PREPARED_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
       l_extendedprice AS price, l_shipdate
FROM genericTempView
"""


def prepared_sql_batch(spark, sf_dir):
    path = scratch_dir(spark, "lineitem-csv")
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    with staging():
        write_delimited(li, path, sep=",")
    spec = BatchIngest(source_path=path, schema=LINEITEM_SCHEMA,
                       target_table=unique_table(spark, "lineitem_slim"), statement=PREPARED_SQL)
    create_table(ingest_frame(spark, spec), spec.target_table,
                 path=scratch_dir(spark, "tbl-lineitem-slim"))
    ingest_batch(spark, spec).collect()
    return spark.table(spec.target_table)


def append_reconcile(spark, sf_dir):
    path = _orders_csv(spark, sf_dir)
    spec = BatchIngest(source_path=path, schema=ORDERS_SCHEMA, header=True, delimiter="|",
                       target_table=unique_table(spark, "orders_load"))
    create_table(ingest_frame(spark, spec), spec.target_table,
                 path=scratch_dir(spark, "tbl-orders-load"))
    ingest_batch(spark, spec).collect()          # first load
    report = ingest_batch(spark, spec)           # second load of the same file
    return report.drop("table_name")


def append_reconcile_touched(spark, sf_dir):
    # orders by year; the second load brings the orders of two years again and
    # counts the partitions it writes to only
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    name = unique_table(spark, "orders_by_year")
    with staging():
        create_table(orders, name, path=scratch_dir(spark, "tbl-orders-year"), partition_by=["o_year"], empty=False)
    again = orders.where("o_year IN (1995, 1996)")
    return append_with_reconcile(again, name, partition_cols=["o_year"], scope="touched").drop("table_name")


def orc_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "part-csv")
    with staging():
        write_delimited(table(spark, sf_dir, "part"), path, sep=",")
    spec = BatchIngest(source_path=path, target_table=unique_table(spark, "part_orc"),
                       schema="p_partkey:long,p_name:string,p_brand:string,p_type:string,"
                              "p_size:integer,p_retailprice:double",
                       mode="overwrite", table_format="orc",
                       table_path=scratch_dir(spark, "tbl-part-orc"))
    ingest_batch(spark, spec).collect()
    ingest_batch(spark, spec).collect()          # replace, not add
    return spark.table(spec.target_table)


PARTITION_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
       year(o_orderdate) AS o_year, o_orderstatus
FROM genericTempView
"""


def partitioned_append(spark, sf_dir):
    path = _orders_csv(spark, sf_dir)
    spec = BatchIngest(source_path=path, schema=ORDERS_SCHEMA, header=True, delimiter="|",
                       target_table=unique_table(spark, "orders_part"), statement=PARTITION_SQL,
                       partition_cols=["o_year", "o_orderstatus"])
    create_table(ingest_frame(spark, spec), spec.target_table,
                 path=scratch_dir(spark, "tbl-orders-part"), partition_by=spec.partition_cols)
    ingest_batch(spark, spec).collect()
    return spark.table(spec.target_table)


def compact_table_q(spark, sf_dir):
    name = unique_table(spark, "orders_small_files")
    orders = table(spark, sf_dir, "orders")
    # many small files, as left behind by frequent small appends
    with staging():
        orders.repartition(64).write.format("parquet").option(
            "path", scratch_dir(spark, "tbl-orders-small")).saveAsTable(name)
    compact_table(spark, name, target_file_bytes=1024 * 1024)
    return spark.table(name)


def pack_small_files_q(spark, sf_dir):
    # small files in every partition, merged without touching large ones
    name = unique_table(spark, "orders_packed")
    orders = table(spark, sf_dir, "orders")
    with staging():
        orders.repartition(24).write.partitionBy("o_orderstatus").format("parquet").option(
            "path", scratch_dir(spark, "tbl-orders-packed")).saveAsTable(name)
    pack_small_files(spark, name, target_file_bytes=256 * 1024)
    return spark.table(name)


def orc_publish_versions(spark, sf_dir):
    # a table replaced by pointer, first by all parts, then by the larger ones
    part = table(spark, sf_dir, "part")
    name, root = unique_table(spark, "part_versions"), scratch_dir(spark, "tbl-part-versions")
    for rows in (part, part.where("p_size > 10")):
        replace_table(rows, name, root=root)
    return spark.table(name)


def publish_partitions(spark, sf_dir):
    # two of three partitions replaced by pointer
    orders = table(spark, sf_dir, "orders")
    name = unique_table(spark, "orders_published")
    with staging():
        create_table(orders, name, path=scratch_dir(spark, "tbl-orders-published"), partition_by=["o_orderstatus"], empty=False)
    replace_partitions(orders.where("o_orderstatus in ('O', 'P')").withColumn("o_totalprice", -F.col("o_totalprice")), name)
    return spark.table(name)


def append_content_check(spark, sf_dir):
    # the second load's content, partition by partition
    orders = table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    name = unique_table(spark, "orders_checked")
    with staging():
        create_table(orders, name, path=scratch_dir(spark, "tbl-orders-checked"), partition_by=["o_year"], empty=False)
    return append_with_content_check(orders.where("o_year >= 1994"), name, ["o_year"])


def append_runs_once(spark, sf_dir):
    # two runs, the first one repeated
    orders = table(spark, sf_dir, "orders")
    name = unique_table(spark, "orders_runs")
    with staging():
        create_table(orders, name, path=scratch_dir(spark, "tbl-orders-runs"), partition_by=["o_orderpriority"])
    for run, rows in (("low", "o_totalprice < 100000"), ("high", "o_totalprice >= 100000"), ("low", "o_totalprice < 100000")):
        append_once(orders.where(rows), name, run)
    return spark.table(name)


def _events_with_bad_lines(spark, sf_dir):
    """Lines of events: every 50th lacks a cell, every 50th has one too many,
    every 50th an id that is no number."""
    ev = table(spark, sf_dir, "events")
    cells = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.coalesce("event_type", F.lit("")),
             F.coalesce(F.col("value").cast("string"), F.lit(""))]
    nth = F.col("event_id") % 50
    line = (F.when(nth == 1, F.concat_ws("|", *cells[:3])).when(nth == 2, F.concat_ws("|", *cells, F.lit("more")))
            .when(nth == 3, F.concat_ws("|", F.concat(F.lit("x"), cells[0]), *cells[1:])).otherwise(F.concat_ws("|", *cells)))
    path = scratch_dir(spark, "events-lines")
    with staging():
        ev.select(line.alias("value")).write.text(path)
    return read_delimited_checked(spark, path, "event_id:long,user_id:long,event_type:string,value:double", sep="|")


def _load_events(spark, sf_dir):
    good, rejects = unique_table(spark, "events_good"), unique_table(spark, "events_rejects")
    checked = _events_with_bad_lines(spark, sf_dir)
    create_table(checked.drop("_reject"), good, path=scratch_dir(spark, "tbl-events-good"))
    report = load_checked(checked, lambda rows: rows.write.mode("append").saveAsTable(good), rejects)
    return good, rejects, report


def csv_checked_rows(spark, sf_dir):
    return spark.table(_load_events(spark, sf_dir)[0])


def csv_rejects(spark, sf_dir):
    return spark.table(_load_events(spark, sf_dir)[1]).select("text", "reason")


SQL_ON_TABLES = """
SELECT o.o_orderpriority, l.l_returnflag, count(*) AS n_lines,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderpriority, l.l_returnflag
"""

SQL_TOP_K = """
SELECT o_orderkey, o_custkey, o_totalprice
FROM orders
ORDER BY o_totalprice DESC, o_orderkey
LIMIT 10
"""


def sql_on_tables(spark, sf_dir):
    return run_sql(spark, SQL_ON_TABLES, views=register_views(spark, sf_dir, ["orders", "lineitem"]))


def sql_top_k(spark, sf_dir):
    return run_sql(spark, SQL_TOP_K, views=register_views(spark, sf_dir, ["orders"]))


QUERIES = {
    "csv_schema_on_read": csv_schema_on_read,
    "csv_quote_off": csv_quote_off,
    "apply_schema_text": apply_schema_text,
    "gsod_style_cast": gsod_style_cast,
    "prepared_sql_batch": prepared_sql_batch,
    "csv_timestamp_forms": csv_timestamp_forms,
    "append_reconcile": append_reconcile,
    "append_reconcile_touched": append_reconcile_touched,
    "orc_overwrite": orc_overwrite,
    "partitioned_append": partitioned_append,
    "compact_table": compact_table_q,
    "pack_small_files": pack_small_files_q,
    "orc_publish_versions": orc_publish_versions,
    "publish_partitions": publish_partitions,
    "append_content_check": append_content_check,
    "append_runs_once": append_runs_once,
    "csv_checked_rows": csv_checked_rows,
    "csv_rejects": csv_rejects,
    "sql_on_tables": sql_on_tables,
    "sql_top_k": sql_top_k,
}

_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""

TIME_FORMS_SQL = """SELECT event_id, CASE event_id % 5
       WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
       WHEN 2 THEN date_trunc('millisecond', ts) WHEN 3 THEN ts
       ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS ts FROM events"""

ORACLE = {
    "csv_timestamp_forms": TIME_FORMS_SQL,
    "append_reconcile_touched": """SELECT count(*) AS source_rows, count(*) AS target_rows_before,
       2 * count(*) AS target_rows_after, count(*) AS rows_loaded, TRUE AS reconciled
       FROM orders WHERE year(o_orderdate) IN (1995, 1996)""",
    "csv_schema_on_read": _ORDERS,
    "csv_quote_off": """SELECT p_partkey, '"' || p_brand AS brand, ' ' || p_type || '"' AS ptype,
       p_size, p_retailprice FROM part""",
    "apply_schema_text": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "gsod_style_cast": """SELECT event_id, CAST(ts AS DATE) AS rep_date,
       event_type || ', ' || CAST(user_id AS VARCHAR) AS name, event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events""",
    "prepared_sql_batch": """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
       l_extendedprice AS price, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
    "append_reconcile": """SELECT count(*) AS source_rows, count(*) AS target_rows_before,
       2 * count(*) AS target_rows_after, count(*) AS rows_loaded, TRUE AS reconciled FROM orders""",
    "orc_overwrite": "SELECT * FROM part",
    "partitioned_append": """SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS o_year, o_orderstatus FROM orders""",
    "compact_table": "SELECT * FROM orders",
    "pack_small_files": "SELECT * FROM orders",
    "orc_publish_versions": "SELECT * FROM part WHERE p_size > 10",
    "publish_partitions": """SELECT * REPLACE (CASE WHEN o_orderstatus IN ('O', 'P') THEN -o_totalprice ELSE o_totalprice END AS o_totalprice)
       FROM orders""",
    "append_content_check": """SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS source_rows, count(*) AS loaded_rows,
       TRUE AS equal FROM orders WHERE year(o_orderdate) >= 1994 GROUP BY 1""",
    "append_runs_once": "SELECT * FROM orders",
    "csv_checked_rows": "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 50 NOT IN (1, 2, 3)",
    "csv_rejects": """WITH cells AS (
         SELECT event_id % 50 AS nth, event_id::VARCHAR AS id, user_id::VARCHAR AS u, coalesce(event_type, '') AS t,
                CASE WHEN value IS NULL THEN '' ELSE value::VARCHAR END AS v FROM events)
       SELECT CASE nth WHEN 1 THEN concat_ws('|', id, u, t) WHEN 2 THEN concat_ws('|', id, u, t, v, 'more')
                       ELSE concat_ws('|', 'x' || id, u, t, v) END AS text,
              CASE nth WHEN 3 THEN 'value of event_id' ELSE 'columns' END AS reason FROM cells WHERE nth IN (1, 2, 3)""",
    "sql_on_tables": SQL_ON_TABLES,
    "sql_top_k": SQL_TOP_K,
}
