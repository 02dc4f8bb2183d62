"""Lineage of processes and the tables they read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.operators import merge as M

# Fixed values.
PROCESS, DATA_SOURCE = "ETLProcess", "DataSource"
FLOW, TRANSFORM = "DATA_FLOW_TO", "TRANSFORMS_TO"
UNKNOWN_OPERATION = "UNKNOWN"


def lineage_nodes(events: DataFrame) -> DataFrame:
    """``(name, node_type, source_type)`` of processes and tables; a table on both sides is a TARGET.

    ``events(proc, tbl, side)``.
    """
    processes = events.select(F.col("proc").alias("name")).distinct().select(
        "name", F.lit(PROCESS).alias("node_type"), F.lit(None).cast("string").alias("source_type")
    )
    # 'TARGET' is the greater of the two words.
    tables = events.groupBy(F.col("tbl").alias("name")).agg(F.max("side").alias("source_type"))
    return processes.unionByName(tables.select("name", F.lit(DATA_SOURCE).alias("node_type"), "source_type"))


def lineage_edges(events: DataFrame) -> DataFrame:
    """Distinct edges source -> process, process -> target and source -> target.

    The source -> target pairs of a process are what is stored, so they are all
    made; both sides are distinct per process first, and adaptive execution splits
    the join of a process with very many tables.
    """
    once = events.select("proc", "tbl", "side").distinct()
    sources = once.where(F.col("side") == "SOURCE").select("proc", F.col("tbl").alias("src"))
    targets = once.where(F.col("side") == "TARGET").select("proc", F.col("tbl").alias("dst"))
    reads = sources.select("src", F.col("proc").alias("dst"), F.lit(FLOW).alias("edge_type"))
    writes = targets.select(F.col("proc").alias("src"), "dst", F.lit(TRANSFORM).alias("edge_type"))
    flows = sources.join(targets, "proc").select("src", "dst", F.lit(FLOW).alias("edge_type")).distinct()
    return reads.unionByName(writes).unionByName(flows)


def save_lineage(nodes: DataFrame, edges: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """Merge new lineage events into stored nodes and edges."""
    fresh = lineage_nodes(events)
    policies = {"source_type": M.coalesce_incoming()}
    merged = M.merge_upsert(nodes, fresh, ["name", "node_type"], policies, ["name"])
    added = M.insert_only(edges, lineage_edges(events), ["src", "dst", "edge_type"], ["src"])
    return {"nodes": merged, "edges": added}


def etl_table_refs(refs: DataFrame, tables: DataFrame, default_type: str = "ETL_READS") -> DataFrame:
    """``(ast_node_id, table_id, ref_type)`` of known tables; the lowest id per name wins."""
    first = tables.groupBy(F.col("name").alias("table_name")).agg(F.min("table_id").alias("table_id"))
    typed = refs.withColumn("ref_type", F.coalesce("ref_type", F.lit(default_type)))
    return typed.join(first, "table_name").select("ast_node_id", "table_id", "ref_type").distinct()


def lineage_graph(nodes: DataFrame) -> DataFrame:
    """Nodes with their shown type: the JSON type, else the source type, else SOURCE; processes are ETL.

    ``nodes(name, node_type, source_type, extra_props)`` with JSON text properties.
    """
    parsed = F.try_parse_json(F.coalesce("extra_props", F.lit("{}")))
    json_type = F.try_variant_get(parsed, "$.type", "string")
    shown = (
        F.when(F.col("node_type") == DATA_SOURCE, F.coalesce(json_type, "source_type", F.lit("SOURCE")))
        .when(F.col("node_type") == PROCESS, "ETL")
        .otherwise(F.col("node_type"))
    )
    return nodes.withColumn("type", shown).orderBy("node_type", "name")


def lineage_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: process, source, target and edge counts."""
    source = F.col("node_type") == DATA_SOURCE
    kind = (
        F.when(F.col("node_type") == PROCESS, "etl")
        .when(source & (F.col("source_type") == "SOURCE"), "source")
        .when(source & (F.col("source_type") == "TARGET"), "target")
    )
    kinds = nodes.select(kind.alias("kind")).unionByName(edges.select(F.lit("flow").alias("kind")))
    names = ("etl", "source", "target", "flow")
    return kinds.agg(*[F.count_if(F.col("kind") == n).alias(f"{n}_count") for n in names])
