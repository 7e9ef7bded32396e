"""Content reconciliation, reject routing, run-time pruning, heavy keys, Avro arguments."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ingestkit.functions.rejects import decode_json_checked, load_checked, read_delimited_checked, split_rejects
from ingestkit.operators.joins import full_outer_join, heavy_keys, spread_outer_join
from ingestkit.operators.merge import merge_new_rows
from ingestkit.session import scoped_conf, scratch_dir, unique_table
from ingestkit.sinks import content
from ingestkit.sinks.tables import create_table

ROWS = [(1, "a", None, {"k": 1}, 0), (1, "a", None, {"k": 1}, 0), (2, None, 1.5, None, 0), (3, "c", -0.5, {}, 1), (None, None, None, None, None)]
SCHEMA = "id long, s string, d double, m map<string,int>, p int"


@pytest.mark.parametrize(("change", "bad"), [
    (lambda rows: rows, set()), (lambda rows: rows[1:], {0}), (lambda rows: [*rows, rows[0]], {0}),
    (lambda rows: [(1, "A", None, {"k": 1}, 0), *rows[1:]], {0}), (lambda rows: rows[:-1], {None}),
    (lambda rows: [r if r[0] != 2 else (2, None, None, {}, 0) for r in rows], {0}), (lambda rows: [*rows, (9, "n", None, None, 7)], {7}),
    (lambda rows: [*rows[:3], (3, "c", -0.5, {}, 0), rows[4]], {0, 1})])
def test_content_names_the_partition(spark, change, bad):
    source, loaded = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(change(ROWS), SCHEMA)
    found = content.compare_content(source, loaded, ["p"]).collect()
    assert {r.p for r in found if not r.equal} == bad
    whole = content.compare_content(source, loaded, []).collect()
    assert len(whole) == 1 and whole[0].equal == (not bad) and whole[0].source_rows == len(ROWS)


def test_nulls_do_not_change_places(spark):
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert [r.equal for r in content.compare_content(a, b, []).collect()] == [False]


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_content_of_a_load(spark, monkeypatch, parts):
    name = unique_table(spark, "content")
    df = spark.range(100).selectExpr("id", "CAST(id % 4 AS INT) AS p")
    create_table(df, name, path=scratch_dir(spark, "tbl-content"), partition_by=parts or None, empty=False)
    good = content.append_with_content_check(df, name).collect()
    assert len(good) == (4 if parts else 1) and all(r.equal and r.source_rows == r.loaded_rows for r in good)
    # a write that loses, doubles and changes rows on the way
    append = content.append_partitioned if parts else content.append_table

    def faulty(rows, *a):
        rows = rows.where("id <> 1").union(rows.where("id = 2")).withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")))
        append(rows, *a)
    monkeypatch.setattr(content, "append_partitioned" if parts else "append_table", faulty)
    found = content.append_with_content_check(df, name).collect()
    assert {(r.p if parts else None) for r in found if not r.equal} == ({1, 2, 3} if parts else {None})


def _lines(spark, lines):
    path = scratch_dir(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_lines_that_do_not_fit(spark):
    lines = ["1,a,1.5", "2,b", "3,c,2.5,x", "x4,d,3.5", "5,e,y", "6,,", ",f,1", "7,\"g,h\",2"]
    path = _lines(spark, lines)
    checked = read_delimited_checked(spark, path, "id:long,s:string,d:double")
    good, rejects = split_rejects(checked)
    assert [tuple(r) for r in good.orderBy(F.col("id").asc_nulls_last()).collect()] == [
        (1, "a", 1.5), (6, None, None), (7, "g,h", 2.0), (None, "f", 1.0)]
    got = {r.text: r.reason for r in rejects.collect()}
    assert got == {"2,b": "columns", "3,c,2.5,x": "columns", "x4,d,3.5": "value of id", "5,e,y": "value of d"}
    assert all(path.split("/")[-1] in r.file for r in rejects.collect())
    into, bad = unique_table(spark, "good"), unique_table(spark, "bad")
    create_table(good, into, path=scratch_dir(spark, "tbl-good"))
    for n in (1, 2):
        r = load_checked(checked, lambda rows: rows.write.mode("append").saveAsTable(into), bad).first()
        assert tuple(r) == (8, 4, 4)
        assert spark.table(into).count() == 4 * n and spark.table(bad).count() == 4 * n
    clean = read_delimited_checked(spark, _lines(spark, lines[:1]), "id:long,s:string,d:double")
    none = unique_table(spark, "none")
    assert tuple(load_checked(clean, lambda rows: rows.write.mode("append").saveAsTable(into), none).first()) == (1, 1, 0)
    assert not spark.catalog.tableExists(none)


def test_messages_that_do_not_fit(spark):
    texts = ['{"id": 1, "s": "a"}', "bad{", '{"id": "x", "s": "b"}', None, "{}", '{"id": 2, "more": 1}', "", "[1, 2]"]
    df = spark.createDataFrame([(t, "t1") for t in texts], "value string, topic string")
    good, rejects = split_rejects(decode_json_checked(df, "id:long,s:string", keep=("topic",)))
    assert good.count() + rejects.count() == len(texts)
    reasons = {r.text: (r.reason, r.file) for r in rejects.collect()}
    assert reasons["bad{"] == ("not JSON", "t1") and reasons['{"id": "x", "s": "b"}'] == ("value of id", "t1")
    assert {(1, "a"), (2, None), (None, None)} <= {(r.id, r.s) for r in good.collect()}


def _metrics(df, wanted):
    """Sums of a metric over the nodes of the plan that ran."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.finalPhysicalPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        metric = node.metrics().get(wanted)
        if metric.isDefined():
            found.append((name, int(metric.get().value())))
    return found


def test_merge_reads_and_shuffles_less_of_the_target(spark):
    name = unique_table(spark, "target")
    rows = spark.range(40000).selectExpr("id AS k", "CAST(id % 8 AS INT) AS p", "DATE_ADD(DATE '2021-01-01', CAST(id % 8 AS INT)) AS d")
    create_table(rows, name, path=scratch_dir(spark, "tbl-target"), partition_by=["p"], empty=False)
    source = spark.range(39980, 40020).selectExpr("id AS k", "CAST(id % 4 AS INT) AS p", "DATE '2021-02-01' AS d").where("p in (1, 3)")
    want = sorted(map(str, merge_new_rows(spark.table(name), source, ["k", "p"], order_by=["d"]).collect()))
    assert 10 < len(want) < 20
    shuffled, read = {}, {}
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for how, options in {"plain": {}, "pruned": {"partition_keys": ["p"], "key_filter": True}}.items():
            added = merge_new_rows(spark.table(name), source, ["k", "p"], order_by=["d"], **options)
            assert sorted(map(str, added.collect())) == want
            shuffled[how] = sum(n for node, n in _metrics(added, "shuffleBytesWritten") if node == "Exchange")
            read[how] = max(n for node, n in _metrics(added, "numPartitions") if "Scan" in node)
    assert read == {"plain": 8, "pruned": 2}
    assert shuffled["pruned"] * 5 < shuffled["plain"]
    with pytest.raises(ValueError, match="merge keys"):
        merge_new_rows(spark.table(name), source, ["k"], order_by=["d"], partition_keys=["p"])
    arrays = spark.createDataFrame([([1],)], "k array<int>")
    with pytest.raises(ValueError, match="array"):
        merge_new_rows(arrays, arrays, ["k"], order_by=["k"])


def test_key_filter_loses_no_match(spark):
    target = spark.range(3000).selectExpr("IF(id = 0, NULL, id) AS k", "DATE '2021-01-01' AS d")
    source = spark.range(0, 3000, 3).selectExpr("IF(id = 0, NULL, id) AS k", "DATE '2021-01-01' AS d")
    assert merge_new_rows(target, source, ["k"], order_by=["d"], key_filter=True).count() == 0
    assert merge_new_rows(target.where("false"), source, ["k"], order_by=["d"], key_filter=True).count() == 1000
    assert merge_new_rows(target, source.where("false"), ["k"], order_by=["d"], key_filter=True).count() == 0


def _same(a, b):
    return Counter(map(str, a.collect())) == Counter(map(str, b.collect()))


@pytest.mark.parametrize("hot_side", ["left", "right", "both", "none"])
def test_heavy_keys_are_spread(spark, hot_side):
    big = spark.range(6000).selectExpr("id AS l", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 900 END AS lk")
    flat = spark.range(0, 1200).selectExpr("id AS l", "CASE WHEN id % 50 = 1 THEN NULL ELSE id END AS lk")
    left = big if hot_side in ("left", "both") else flat
    right = (big if hot_side == "right" else flat).selectExpr("l AS r", "lk AS rk")
    if hot_side == "both":
        right = right.selectExpr("r", "IF(r < 60, 7, rk) AS rk")
    args = (left, right, ["lk"], ["rk"])
    assert bool({**heavy_keys(left, ["lk"], 0.01), **heavy_keys(right, ["rk"], 0.01)}) == (hot_side != "none")
    assert _same(spread_outer_join(*args), full_outer_join(*args))


def test_no_task_holds_the_heavy_key(spark):
    left = spark.range(60000).selectExpr("id AS l", "IF(id % 3 = 0, -1, id) AS lk").repartition(8)
    right = spark.range(-1, 60000).selectExpr("id AS rk", "id * 2 AS r")
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                             "spark.sql.shuffle.partitions": "64"}):
        out = spread_outer_join(left, right, ["lk"], ["rk"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60000 + 20000 and max(sizes) < 0.05 * sum(sizes)
        plain = full_outer_join(left, right, ["lk"], ["rk"])
        assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) > 20000


def test_avro_is_decoded_with_the_writers_schema(spark, monkeypatch):
    from pyspark.sql.avro import functions as A

    from ingestkit.functions import avro
    calls = []
    monkeypatch.setattr(avro, "_require_module", lambda: None)
    monkeypatch.setattr(A, "from_avro", lambda *a: calls.append(a))
    avro.from_avro(F.col("value"), "written", "read", "PERMISSIVE")
    avro.from_avro(F.col("value"), "written")
    assert [c[1:] for c in calls] == [("written", {"mode": "PERMISSIVE", "avroSchema": "read"}), ("written", {"mode": "FAILFAST"})]
    assert re.search("Avro module", avro.__doc__)
