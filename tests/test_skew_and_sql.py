"""AQE splits a hot key on the streamed side; SQL runner with a database."""

from collections import Counter

import pytest

from ingestkit.operators.joins import split_outer_join
from ingestkit.plans.sql import run_sql
from ingestkit.session import scoped_conf, scratch_database, unique_table


def test_hot_key_is_split_by_aqe(spark):
    # a third of the left rows share one key; thresholds scaled down so the
    # small test data counts as skewed
    left = spark.range(60000).selectExpr("CASE WHEN id < 20000 THEN 1 ELSE id END AS k", "id AS v")
    right = spark.range(100000).selectExpr("id AS rk", "id * 2 AS rv")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    with scoped_conf(spark, conf):
        out = split_outer_join(left, right, ["k"], ["rk"])
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
        want = Counter(tuple(r) for r in left.join(right, left.k == right.rk, "full").collect())
    assert "isSkewJoin=true" in final.replace(" ", "") or "skew=true" in final
    assert Counter(tuple(r) for r in rows) == want


def test_run_sql_in_a_database(spark):
    db = scratch_database(spark)
    name = unique_table(spark, "sqlrun", db)
    spark.range(3).write.saveAsTable(name)
    short = name.split(".")[1]
    before = spark.catalog.currentDatabase()
    got = run_sql(spark, f"SELECT count(*) AS n FROM {short}", database=db).collect()[0].n
    assert got == 3 and spark.catalog.currentDatabase() == before
    tables = [r.tableName for r in run_sql(spark, "SHOW TABLES", database=db).collect()]
    assert short in tables
    dbs = [r[0] for r in run_sql(spark, "SHOW DATABASES").collect()]
    assert db in dbs


def test_statement_lines_keep_apart(spark):
    from ingestkit.plans.sql import load_statement, transform
    text = load_statement(["SELECT id AS temp", "FROM genericTempView;"])
    assert text == "SELECT id AS temp\nFROM genericTempView"
    assert [r.temp for r in transform(spark.range(2), text).collect()] == [0, 1]


def test_bad_cells_of_a_supplied_cast_become_null(spark):
    from pyspark.errors import PySparkException

    from ingestkit.plans.sql import transform
    rows = spark.createDataFrame([("1.5",), ("n/a",)], "v string")
    got = transform(rows, "SELECT CAST(v AS DOUBLE) AS v FROM genericTempView").collect()
    assert [r.v for r in got] == [1.5, None]
    with pytest.raises(PySparkException):
        transform(rows, "SELECT CAST(v AS DOUBLE) AS v FROM genericTempView", null_on_bad_cast=False).collect()
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_views_are_bound_for_one_statement(spark):
    spark.range(7).createOrReplaceTempView("taken")
    first = run_sql(spark, "SELECT count(*) AS n FROM taken", views={"taken": spark.range(2)})
    second = run_sql(spark, "SELECT count(*) AS n FROM taken", views={"taken": spark.range(3)})
    assert (first.collect()[0].n, second.collect()[0].n) == (2, 3)
    assert spark.table("taken").count() == 7
    run_sql(spark, "SELECT 1 AS x FROM fresh", views={"fresh": spark.range(1)})
    assert not spark.catalog.tableExists("fresh")
