"""Merge policies, scoped replace and cascading delete on hand-made rows."""

import random

from pyspark.sql import functions as F

from catalith.operators import graph, loads
from catalith.operators import merge as M

KEEP = "keep"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_every_policy_folds_all_changes_of_a_key(spark):
    schema = "k string, a string, b string, c string, d string, n long, s string, f string, m map<string,string>"
    current = spark.createDataFrame(
        [("x", "a0", "b0", "c0", "d0", 5, "ddl", "N/A", {"p": "0", "q": "0"}), ("y", "a", "b", "c", "d", 1, "user", "text", None)], schema
    )
    changes = spark.createDataFrame(
        [
            ("x", "a1", "b1", None, "", 0, "user", "", {"p": "1"}, 1),
            ("x", None, "b2", "c2", "d2", 0, "user", "first", {"r": None}, 2),
            ("x", None, "b3", None, "", 0, "user", "second", None, 3),
            ("z", "z1", "zb", None, "", 0, "ddl", None, {"a": "1"}, 1),
            ("z", "z2", "zc", "zd", None, 0, "user", "N/A", {"a": "2"}, 2),
        ],
        schema + ", seq int",
    )
    policies = {
        "a": M.incoming(),
        "b": M.keep(),
        "c": M.coalesce_incoming(),
        "d": M.non_empty(),
        "n": M.counter(),
        "s": M.sticky("ddl"),
        "f": M.fill_if_missing(),
        "m": M.map_merge(),
    }
    out = {r["k"]: r for r in M.merge_upsert(current, changes, ["k"], policies, ["seq"]).collect()}
    x, y, z = out["x"], out["y"], out["z"]
    assert (x["a"], x["b"], x["c"], x["d"], x["n"], x["s"], x["f"]) == (None, "b0", "c2", "d2", 8, "ddl", "first")
    assert x["m"] == {"p": "1", "q": "0", "r": None} and x[M.ACTION] == "update"
    assert (y["a"], y["n"], y["m"], y[M.ACTION]) == ("a", 1, None, "keep")
    assert (z["a"], z["b"], z["c"], z["d"], z["n"], z["s"], z["f"]) == ("z2", "zb", "zd", "", 2, "ddl", "N/A")
    assert z["m"] == {"a": "2"} and z[M.ACTION] == "insert"


def test_null_key_always_inserts(spark):
    current = spark.createDataFrame([("v", None, "c", 1, 3, True)], "natural_value string, column_fqn string, code_value string, column_id long, usage_count long, verified boolean")
    changes = spark.createDataFrame(
        [("v", None, "d", None, True, 1), ("v", None, "e", None, True, 2)],
        "natural_value string, column_fqn string, code_value string, column_id long, verified boolean, seq int",
    )
    out = loads.merge_value_mappings(current, changes, ["seq"])
    assert rows(out, "code_value", "usage_count", M.ACTION) == [("c", 3, "keep"), ("d", 1, "insert"), ("e", 1, "insert")]


def test_counter_twice_adds_two_and_changes_nothing_else(spark):
    current = spark.createDataFrame([("q", "sql", 4, None)], "id string, sql_query string, execution_count long, last_used_at timestamp")
    change = spark.createDataFrame([("q", "sql", 1)], "id string, sql_query string, seq int")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    once = loads.merge_query_embeddings(current, change, "id", ["seq"], ts).drop(M.ACTION)
    twice = loads.merge_query_embeddings(once, change, "id", ["seq"], ts)
    assert rows(twice, "sql_query", "execution_count") == [("sql", 6)]


def test_partial_update_moves_the_timestamp_only_on_change(spark):
    current = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, name string, status string").withColumn("updated_at", F.lit(None).cast("timestamp"))
    changes = spark.createDataFrame([(1, None, "new", 1), (2, None, None, 1), (3, "x", "y", 1)], "id int, name string, status string, seq int")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    some = M.partial_update(current, changes, ["id"], ["name", "status"], ["seq"], ts)
    assert rows(some, "id", "name", "status", F.col("updated_at").isNotNull()) == [(1, "a", "new", True), (2, "c", "d", False)]
    every = M.partial_update(current, changes, ["id"], ["name", "status"], ["seq"], ts, stamp_always=True)
    assert rows(every, "id", F.col("updated_at").isNotNull()) == [(1, True), (2, True)]


def test_replace_scope_and_insert_only(spark):
    current = spark.createDataFrame([("s1", 1), ("s2", 2)], "scope string, v int")
    fresh = spark.createDataFrame([("s1", 9)], "scope string, v int")
    assert rows(M.replace_scope(current, fresh, ["scope"]), "scope", "v") == [("s1", 9), ("s2", 2)]
    out = M.insert_only(current, fresh.unionByName(spark.createDataFrame([("s3", 4), ("s3", 3)], "scope string, v int")), ["scope"], ["v"])
    assert rows(out, "scope", "v", M.ACTION) == [("s1", 1, KEEP), ("s2", 2, KEEP), ("s3", 3, "insert")]
    assert rows(M.action_counts(out), M.ACTION, "row_count") == [("insert", 1), (KEEP, 2)]


def test_delete_cascade_follows_the_tree_and_nulls_soft_links(spark):
    frames = {
        "parent": spark.createDataFrame([(1,), (2,)], "id int"),
        "child": spark.createDataFrame([(10, 1), (20, 2)], "cid int, id int"),
        "leaf": spark.createDataFrame([(100, 10, 20), (200, 20, 20)], "lid int, a int, b int"),
        "note": spark.createDataFrame([(7, 1), (8, 2), (9, None)], "nid int, id int"),
    }
    tree = [("child", {"id": "id"}, "parent"), ("leaf", {"a": "cid"}, "child"), ("leaf", {"b": "cid"}, "child"), ("?note", {"id": "id"}, "parent")]
    left = M.delete_cascade(frames, "parent", spark.createDataFrame([(1,)], "id int"), ["id"], tree)
    assert rows(left["parent"], "id") == [(2,)]
    assert rows(left["child"], "cid") == [(20,)]
    assert rows(left["leaf"], "lid") == [(200,)]
    assert rows(left["note"], "nid", "id") == [(7, None), (8, 2), (9, None)]


def test_ddl_counts_and_stub_table(spark):
    schema = {
        "schemas": "db string, name string, datasource string",
        "tables": "db string, schema_name string, name string, description string, description_source string, table_type string, datasource string",
        "columns": "fqn string, name string, dtype string, description string, description_source string, nullable boolean, is_primary_key boolean, pk_constraint string, datasource string, table_db string, table_schema string, table_name string",
        "relationships": "from_db string, from_schema string, from_table string, to_db string, to_schema string, to_table string, rel_type string, source_column string, target_column string, source string",
    }
    store = {k: spark.createDataFrame([], v) for k, v in schema.items()}
    schemas = spark.createDataFrame([("d", "s", "ds", 1)], schema["schemas"] + ", seq int")
    tables = spark.createDataFrame([("d", "s", t, "", "", "BASE TABLE", "ds", i) for i, t in enumerate("ab")], schema["tables"] + ", seq int")
    columns = spark.createDataFrame(
        [(f"d.s.a.{c}", c, "int", "", "", True, False, "", "", "d", "s", "a", i) for i, c in enumerate("xyz")], schema["columns"] + ", seq int"
    )
    fks = spark.createDataFrame(
        [("d", "s", "a", "x", "d", "s", "b", "x", 1), ("d", "s", "a", "y", "d", "s", "ghost", "id", 2), ("d", "s", "nowhere", "y", "d", "s", "b", "id", 3)],
        "from_db string, from_schema string, from_table string, from_column string, to_db string, to_schema string, to_table string, to_column string, seq int",
    )
    out = loads.merge_ddl(store, schemas, tables, columns, fks)
    assert [out[k].count() for k in ("schemas", "tables", "columns", "relationships")] == [1, 3, 3, 2]
    assert rows(out["tables"].where("name = 'ghost'"), "name", "description", M.ACTION) == [("ghost", None, "insert")]


def test_replace_schema_equals_a_plain_rewrite(spark):
    rnd = random.Random(3)
    schemas = ["s1", "s2", "s3", None]
    nodes = [(f"n{i}", rnd.choice(["KPI", "x"]), schemas[i % 4]) for i in range(24)]
    edges = [(f"n{rnd.randrange(26)}", f"n{rnd.randrange(26)}", "T", rnd.choice(schemas)) for _ in range(120)] + [(None, "n1", "T", "s2")]
    fresh = [("n0", "KPI", "s1"), ("f1", "odd", "s1"), ("f1", "odd", "s3"), ("f2", None, "s3"), ("f3", "KPI", None)]
    names = ["n0", "n1", "f1", "f2", "f3", None]
    fresh_edges = [(a, c, "N", s) for a in names for c in names for s in ("s1", "s3", None)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in (
        (nodes, "id string, label string, schema_id string"), (edges, "src string, dst string, type string, schema_id string"),
        (fresh, "id string, label string, schema_id string"), (fresh_edges, "src string, dst string, type string, schema_id string"),
    )]
    got_nodes, got_edges = graph.replace_schema(*frames)
    gone = {i for i, _, s in nodes if s in ("s1", "s3")}
    want_nodes = [n for n in nodes if n[2] not in ("s1", "s3")] + [(i, "KPI" if k == "KPI" else graph.TYPE_LABEL, s) for i, k, s in fresh]
    known = {(s, i) for i, _, s in fresh if s}
    want_edges = [e for e in edges if e[3] not in ("s1", "s3") and e[0] not in gone and e[1] not in gone]
    want_edges += [e for e in fresh_edges if {(e[3], e[0]), (e[3], e[1])} <= known]
    order = lambda rows: sorted(map(str, map(tuple, rows)))
    assert order(got_nodes.collect()) == order(want_nodes) and order(got_edges.collect()) == order(want_edges)
