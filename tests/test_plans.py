"""Ranking and nesting plans, including groups far above the usual size."""

import re

from pyspark.sql import functions as F

from catalith.operators.usage import containing
from catalith.plans.nesting import _in_parts, attach, nest
from catalith.plans.ranking import first_per_key, frequencies, newest_per_key, top_per_group


def test_hot_parent_is_split_and_stays_whole(spark):
    child = spark.range(1000).selectExpr("CASE WHEN id < 700 THEN 'hot' ELSE concat('k', id % 7) END AS k", "id AS v")
    nested = nest(child, ["k"], ["v"], "vs", max_items=50)
    rows = nested.collect()
    hot = [r for r in rows if r["k"] == "hot"]
    assert len(hot) == 14 and sum(len(r["vs"]) for r in rows) == 1000
    assert sorted(x["v"] for r in hot for x in r["vs"]) == list(range(700))
    assert all([x["v"] for x in r["vs"]] == sorted(x["v"] for x in r["vs"]) for r in rows)
    hot.sort(key=lambda r: r["part"])
    assert [x["v"] for r in hot for x in r["vs"]] == list(range(700))  # consecutive ranges
    assert all(r["part"] == 0 for r in rows if r["k"] != "hot")
    parents = spark.createDataFrame([("k1",), ("none",)], "k string")
    out = {r["k"]: (r["part"], len(r["vs"])) for r in attach(parents, {"vs": nested}, ["k"]).collect()}
    assert out["none"] == (0, 0) and out["k1"][0] == 0


def test_repeated_items_and_missing_keys_are_split(spark):
    rows = [(None, 7)] * 260 + [(None, i) for i in range(90)] + [("a", None)] * 3 + [("b", i % 40) for i in range(200)]
    child = spark.createDataFrame(rows, "k string, v int").repartition(4)
    got = sorted(nest(child, ["k"], ["v"], "vs", max_items=50).collect(), key=lambda r: (r["k"] or "", r["part"]))
    order = lambda vs: sorted(vs, key=lambda v: (v is not None, v))
    for key in (None, "a", "b"):
        parts = [r for r in got if r["k"] == key]
        assert [r["part"] for r in parts] == list(range(len(parts))) and all(len(r["vs"]) == 50 for r in parts[:-1])
        assert [x["v"] for r in parts for x in r["vs"]] == order(v for k, v in rows if k == key)
    unique = nest(child, ["k"], ["v"], "vs", max_items=50, distinct=True).where("k IS NULL").collect()
    assert sorted(len(r["vs"]) for r in unique) == [40, 50]


def test_a_third_of_all_rows_spreads_over_tasks(spark):
    """The rows of the hot parent are numbered in many tasks, and no window is over raw rows of a parent."""
    child = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 5000 END AS k", "id AS v")
    once = child.select("k", F.struct("v").alias("__item"), F.lit(1).cast("long").alias("__times"))
    large = spark.createDataFrame([(-1, 10_000)], "k long, __kinds long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = _in_parts(once, large, ["k"], 1000).withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 6 and max(tasks) < 5000
    nested = nest(child, ["k"], ["v"], "vs", max_items=1000)
    rows = {(r["k"], r["part"]): [x["v"] for x in r["vs"]] for r in nested.where("k = -1").collect()}
    assert [v for part in range(10) for v in rows[-1, part]] == list(range(0, 30_000, 3))


def test_two_lists_do_not_multiply_parts(spark):
    child = spark.range(130).selectExpr("'p' AS k", "id AS v")
    more = spark.range(70).selectExpr("'p' AS k", "id AS v")
    parents = spark.createDataFrame([("p",), ("q",)], "k string")
    out = attach(parents, {"a": nest(child, ["k"], ["v"], "a", 50), "b": nest(more, ["k"], ["v"], "b", 50)}, ["k"]).collect()
    got = sorted((r["k"], r["part"], len(r["a"]), len(r["b"])) for r in out)
    assert got == [("p", 0, 50, 50), ("p", 1, 50, 20), ("p", 2, 30, 0), ("q", 0, 0, 0)]


def test_top_per_group_beyond_the_group_limit(spark):
    df = spark.range(6000).selectExpr("id % 2 AS g", "id AS v")
    for n in (3, 1500):
        rows = top_per_group(df, ["g"], [F.col("v").desc()], n).groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("m")).collect()
        assert {(r["g"], r["n"], r["m"]) for r in rows} == {(0, n, 5998 - 2 * (n - 1)), (1, n, 5999 - 2 * (n - 1))}


def test_top_per_group_cuts_before_the_shuffle(spark):
    plan = top_per_group(spark.range(10).selectExpr("id % 2 AS g", "id AS v"), ["g"], [F.col("v")], 3)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_per_key_picks_and_frequencies(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert sorted(map(tuple, newest_per_key(df, ["k"], ["o"]).collect())) == [("a", 2, "y"), ("b", 1, "z")]
    assert sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect())) == [("a", 1, None), ("b", 1, "z")]
    assert [tuple(r) for r in frequencies(df, ["k"], 1).collect()] == [("a", 2)]


def test_substring_join_equals_brute_force(spark):
    values = ["small ring", "RING", "a", "über%", "", None, "ringring", "x_y"]
    terms = ["ring", "R", "ÜB", "%", "ngr", "zzz", "", "x_", "small ring"]
    left = spark.createDataFrame([(v,) for v in values], "v string")
    right = spark.createDataFrame([(t,) for t in terms], "t string")
    found = containing(left, "v", right, "t")
    want = sorted((v, t) for v in values if v for t in terms if t and t.lower() in v.lower())
    assert sorted((r["v"], r["t"]) for r in found.select("v", "t").distinct().collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_wide_steps_get_more_tasks_with_larger_files(spark, tmp_path, monkeypatch):
    from catalith.operators import fk, graph, loads
    from catalith.plans import sizing

    spark.range(1000).selectExpr("concat('a', id) AS src", "concat('b', id) AS dst", "'t' AS type").write.parquet(str(tmp_path / "edges"))
    edges = spark.read.parquet(str(tmp_path / "edges"))
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sizing.task_count(edges) == sizing.task_count(spark.range(3)) == own
    size = sum(f.stat().st_size for f in (tmp_path / "edges").glob("*.parquet"))
    monkeypatch.setattr(sizing, "TASK_BYTES", 100)
    tasks = -(-size // 100)
    assert sizing.task_count(edges) == tasks > own

    def steps(df):
        return re.findall(r"hashpartitioning\((\w+)#\d+L?[^)]*, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())

    wide = {(name, str(tasks)) for name in ("src", "dst", "id")}
    assert wide <= set(steps(graph.with_known_ends(edges, edges.select(F.col("src").alias("id")))))
    records = edges.selectExpr("src AS node_id", "src AS id", "type AS labels", "dst AS rel_id", "type AS rel_type", "src AS start_id", "dst AS end_id", "dst AS seq")
    nodes, links = graph.graph_entities(records, ["seq"])
    assert ("entity_id", str(tasks)) in steps(nodes) and ("relationship_id", str(tasks)) in steps(links)
    used = edges.selectExpr("src AS statement_id", "dst AS table_id", "type AS ref_type")
    said = edges.selectExpr("src AS statement_id", "dst AS proc_id", "type AS statement_type", "1 AS start_line")
    procedures = edges.selectExpr("dst AS proc_id", "src AS procedure_name", "type AS procedure_type")
    shown = fk.table_references(used, said, procedures, edges.selectExpr("dst AS table_id", "src AS name"))
    assert shown.count() == 1000 and ("statement_id", str(tasks)) in steps(shown)
    usage = edges.selectExpr("src AS query_id", "dst AS column_id", "type AS usage_type")
    named = edges.selectExpr("src AS query_id", "type AS db", "type AS schema", "type AS table", "dst AS name", "type AS purpose")
    rebuilt = loads.usage_rebuild(
        usage.selectExpr("query_id", "column_id AS table_id"), usage, usage.where("query_id = 'a1'"), named, named,
        edges.selectExpr("type AS db", "type AS schema_name", "dst AS name", "src AS original_name", "dst AS table_id"),
        edges.selectExpr("dst AS column_id", "concat('t.t.', dst) AS fqn"),
    )
    assert {("key", str(tasks)), ("query_id", str(tasks))} <= set(steps(rebuilt["column_usage"]))
