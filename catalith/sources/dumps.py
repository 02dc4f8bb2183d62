"""Graph dumps: JSON nodes and edges in, JSON out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.sources.arrays import read_array

# Field names of the dump files.
NODE_SCHEMA = "id string, neo4j_id string, labels array<string>, properties map<string,string>"
EDGE_SCHEMA = "rel_id string, rel_type string, start_id string, end_id string, properties map<string,string>"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


def _nodes(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.coalesce("id", "neo4j_id").alias("id"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
        F.col("properties").alias("props"),
    )


def _edges(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("rel_id").alias("edge_id"),
        F.col("start_id").alias("src"),
        F.col("end_id").alias("dst"),
        F.col("rel_type").alias("type"),
        F.col("properties").alias("props"),
    )


def read_nodes(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """``(id, labels, props)``; JSON lines by default, ``array_file`` for one JSON array per file; both split."""
    return parse_nodes(read_array(spark, path)) if array_file else _nodes(spark.read.schema(NODE_SCHEMA).json(path))


def read_edges(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """``(edge_id, src, dst, type, props)``."""
    return parse_edges(read_array(spark, path)) if array_file else _edges(spark.read.schema(EDGE_SCHEMA).json(path))


def typed_nodes(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(id, labels, props)`` with the properties as VARIANT, so that every value keeps its type."""
    kind = NODE_SCHEMA.replace("map<string,string>", "variant")
    return _nodes(lines.select(F.from_json(column, kind).alias("j")).select("j.*"))


def parse_nodes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Nodes from JSON texts already in a frame."""
    return _nodes(lines.select(F.from_json(column, NODE_SCHEMA).alias("j")).select("j.*"))


def parse_edges(lines: DataFrame, column: str = "value") -> DataFrame:
    return _edges(lines.select(F.from_json(column, EDGE_SCHEMA).alias("j")).select("j.*"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines with ISO timestamps; arrays and maps stay nested."""
    df.write.option("timestampFormat", TIMESTAMP_FORMAT).json(path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Graph store as parquet, nodes partitioned by label and edges by type."""
    nodes.write.partitionBy("label").parquet(f"{path}/nodes")
    edges.write.partitionBy("type").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")
