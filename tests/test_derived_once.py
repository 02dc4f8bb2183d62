"""Frames that a query uses several times are derived once."""

import json

from pyspark.sql import functions as F

from bindings import load
from catalith.operators.graph import graph_export
from catalith.operators.loads import merge_relationships
from catalith.plans.nesting import nest

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nest_reads_the_children_once(spark):
    child = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    nested = nest(child, ["k"], ["v"], "vs")
    assert "Range" not in plan_of(nested)
    assert plan_of(nested).count("Relation [") == 1
    assert {r["k"]: [x["v"] for x in r["vs"]] for r in nested.collect()} == {k: list(range(k, 100, 7)) for k in range(7)}


def test_system_views_share_the_named_columns(spark):
    for name in ("harvest_flags", "catalog_assemble"):
        assert "l_partkey" not in plan_of(load.QUERIES[name](spark, SF))


def test_export_takes_only_rows_with_lists_apart(spark):
    tables = spark.createDataFrame(
        [(1, "a", [0.0] * 127, [1.0]), (2, None, [0.0] * 128, None), (3, "c", None, [1.0])], "table_id long, name string, sizes array<double>, Vector array<double>"
    ).withColumn("extra", F.parse_json(F.expr("CASE WHEN table_id = 3 THEN to_json(sequence(1, 130)) ELSE '[1]' END")))
    columns = spark.createDataFrame([(7, 1, "[1,2]")], "column_id long, table_id long, name string")
    links = spark.createDataFrame([], "rel_id long, from_table_id long, to_table_id long, rel_type string, source_column string, target_column string")
    nodes, _ = graph_export(tables, columns, links)
    shown = {r["node_id"]: json.loads(r["p"]) for r in nodes.select("node_id", F.to_json("properties").alias("p")).collect()}
    assert sorted(shown["1"]) == ["extra", "name", "sizes"] and len(shown["1"]["sizes"]) == 127
    assert shown["2"] == {"extra": [1], "name": None}
    assert shown["3"] == {"name": "c", "sizes": None}
    assert shown["col:7"] == {"name": "[1,2]"}
    assert "map_filter" not in plan_of(graph_export(tables.select("table_id", "name"), columns, links)[0])


def test_merged_relationships_look_the_ends_up_once(spark):
    plan = plan_of(load.QUERIES["merge_relationships"](spark, SF))
    assert "l_partkey" not in plan and "p_partkey" not in plan


def test_rejected_relationships_keep_their_row_beside_a_known_one(spark):
    tables = spark.createDataFrame([(1, "s", "a"), (2, "s", "b")], "table_id long, schema_name string, name string")
    told = "from_schema string, from_table string, from_column string, to_schema string, to_table string, to_column string, rel_type string, seq string"
    asked = [("s", "a", "x", "s", "b", "y", "ONE_TO_ONE", "7"), ("s", "a", "x", "s", "gone", "y", "ONE_TO_ONE", "7"), ("s", "a", "x", None, "b", "y", "ODD", "8"), ("s", "a", "x", "s", "b", "y", None, "9")]
    known = spark.createDataFrame([], "from_table_id long, to_table_id long, rel_type string, source_column string, target_column string, source string, description string")
    rows = spark.createDataFrame(asked, told).withColumn("description", F.lit("d"))
    merged, rejected = merge_relationships(known, tables, rows)
    assert [(r["from_table_id"], r["to_table_id"]) for r in merged.collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in rejected.collect()) == [("7", "table not found"), ("8", "type not allowed"), ("9", "type not allowed")]


def test_saved_lineage_reads_the_events_and_the_stored_edges_once(spark):
    plan = plan_of(load.QUERIES["save_lineage_edges"](spark, SF))
    assert "l_orderkey" not in plan and plan.count("Join FullOuter") == 1 and "Join LeftOuter" not in plan


def test_relation_details_joins_the_keys_once(spark):
    assert "l_partkey" not in plan_of(load.QUERIES["relation_details"](spark, SF))


def test_related_tables_count_columns_without_expanded_rows(spark):
    for name in ("related_tables", "related_tables_columns", "related_tables_scored"):
        plan = plan_of(load.QUERIES[name](spark, SF))
        assert "Expand" not in plan and ("l_partkey" not in plan or name == "related_tables_scored")
