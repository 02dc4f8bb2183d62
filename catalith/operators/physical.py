"""Physical graph layer of a catalog snapshot and its contract.

Flat snapshot frames: ``tables(meta_db_label, schema, name, comment, table_type,
source_engine)``, ``columns(meta_db_label, schema, table_name, column_name,
ordinal_position, dtype, is_nullable, column_default, col_comment, is_unique)``,
``primary_keys(.., table_name, column_name)``, ``foreign_keys(..)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.keys import column_fqn, column_vertex, database_vertex, table_vertex
from catalith.functions.text import blank
from catalith.functions.values import yes_no

# The frozen property sets of the vertex and edge kinds.
FROZEN_KEYS = {
    "Database": ("meta_db_label", "source_engine", "_meta_ingest", "_physical_vertex_id"),
    "Table": (
        "name",
        "schema",
        "description",
        "analyzed_description",
        "table_type",
        "db_exists",
        "datasource",
        "_meta_ingest",
        "_physical_vertex_id",
    ),
    "Column": (
        "name",
        "fqn",
        "dtype",
        "nullable",
        "is_primary_key",
        "description",
        "ordinal_position",
        "column_default",
        "is_unique",
        "_meta_ingest",
        "_physical_vertex_id",
    ),
    "FK_TO": ("constraint", "position"),
    "HAS_TABLE": (),
    "HAS_COLUMN": (),
}
SUMMARY_KINDS = {
    "Database": "database",
    "Table": "tables",
    "Column": "columns",
    "HAS_TABLE": "has_table",
    "HAS_COLUMN": "has_column",
    "FK_TO": "fk_to",
}
TRUE = "true"


def _props(kind: str, values: dict[str, Column]) -> Column:
    pairs: list[Column] = []
    for key in FROZEN_KEYS[kind]:
        pairs += [F.lit(key), F.coalesce(values[key].cast("string"), F.lit(""))]
    return F.create_map(*pairs)


def vertices(tables: DataFrame, columns: DataFrame, primary_keys: DataFrame | None = None) -> DataFrame:
    """``(id, label, meta_db_label, props)`` of the Database, Table and Column vertices.

    Without ``primary_keys`` the columns carry ``is_primary_key`` themselves, so they need no join.
    """
    db = F.col("meta_db_label")
    databases = tables.groupBy("meta_db_label").agg(F.max("source_engine").alias("source_engine"))
    database_rows = databases.select(
        database_vertex(db).alias("id"),
        F.lit("Database").alias("label"),
        "meta_db_label",
        _props(
            "Database",
            {
                "meta_db_label": db,
                "source_engine": F.coalesce("source_engine", F.lit("unknown")),
                "_meta_ingest": F.lit(TRUE),
                "_physical_vertex_id": database_vertex(db),
            },
        ).alias("props"),
    )
    table_id = table_vertex(db, "schema", "name")
    table_rows = tables.select(
        table_id.alias("id"),
        F.lit("Table").alias("label"),
        "meta_db_label",
        _props(
            "Table",
            {
                "name": F.col("name"),
                "schema": F.col("schema"),
                "description": blank("comment"),
                "analyzed_description": F.lit(""),
                "table_type": blank("table_type"),
                "db_exists": F.lit(TRUE),
                "datasource": db,
                "_meta_ingest": F.lit(TRUE),
                "_physical_vertex_id": table_id,
            },
        ).alias("props"),
    )
    keys = ["meta_db_label", "schema", "table_name", "column_name"]
    if primary_keys is None:
        flagged = columns.withColumn("pk", F.col("is_primary_key"))
    else:
        flagged = columns.join(primary_keys.select(*keys).distinct().withColumn("pk", F.lit(True)), keys, "left")
    column_id = column_vertex(db, "schema", "table_name", "column_name")
    column_rows = flagged.select(
        column_id.alias("id"),
        F.lit("Column").alias("label"),
        "meta_db_label",
        _props(
            "Column",
            {
                "name": F.col("column_name"),
                "fqn": column_fqn(db, "schema", "table_name", "column_name"),
                "dtype": F.col("dtype"),
                "nullable": yes_no("is_nullable"),
                "is_primary_key": F.coalesce("pk", F.lit(False)),
                "description": blank("col_comment"),
                "ordinal_position": F.coalesce("ordinal_position", F.lit(0)),
                "column_default": F.trim(blank("column_default")),
                "is_unique": F.coalesce("is_unique", F.lit(False)),
                "_meta_ingest": F.lit(TRUE),
                "_physical_vertex_id": column_id,
            },
        ).alias("props"),
    )
    return database_rows.unionByName(table_rows).unionByName(column_rows)


def physical_edges(tables: DataFrame, columns: DataFrame, fks: DataFrame) -> DataFrame:
    """``(src, dst, type, meta_db_label, props)`` of HAS_TABLE, HAS_COLUMN and FK_TO.

    A key counts when both ends are in the snapshot's schema and both tables are
    in the snapshot.
    """
    db = F.col("meta_db_label")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("props")
    has_table = tables.select(
        database_vertex(db).alias("src"), table_vertex(db, "schema", "name").alias("dst"), F.lit("HAS_TABLE").alias("type"), "meta_db_label", none
    )
    has_column = columns.select(
        table_vertex(db, "schema", "table_name").alias("src"),
        column_vertex(db, "schema", "table_name", "column_name").alias("dst"),
        F.lit("HAS_COLUMN").alias("type"),
        "meta_db_label",
        none,
    )
    known = tables.select("meta_db_label", "schema", "name").distinct()
    scoped = fks.where((F.col("from_schema") == F.col("schema")) & (F.col("to_schema") == F.col("schema")))
    for end in ("from_table", "to_table"):
        scoped = scoped.join(known.withColumnRenamed("name", end), ["meta_db_label", "schema", end], "left_semi")
    fk_rows = scoped.select(
        column_vertex(db, "schema", "from_table", "from_column").alias("src"),
        column_vertex(db, "schema", "to_table", "to_column").alias("dst"),
        F.lit("FK_TO").alias("type"),
        "meta_db_label",
        _props(
            "FK_TO", {"constraint": blank("constraint_name"), "position": F.coalesce("position", F.lit(1))}
        ).alias("props"),
    )
    return has_table.unionByName(has_column).unionByName(fk_rows)


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows per kind, zero where a kind is absent."""
    counted = (
        nodes.select(F.col("label").alias("k"))
        .unionByName(edges.select(F.col("type").alias("k")))
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    kinds = nodes.sparkSession.createDataFrame(list(SUMMARY_KINDS.items()), "k string, kind string")
    return kinds.join(counted, "k", "left").select("kind", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def refresh(
    nodes: DataFrame, edges: DataFrame, fresh_nodes: DataFrame, fresh_edges: DataFrame, scope: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """Replace the ingested physical layer: of the fresh labels only, or of every label with ``scope="all"``.

    Vertices without the ingest mark stay; edges of removed vertices go with them.
    """
    if scope not in ("label", "all"):
        raise ValueError("scope is 'label' or 'all'")
    marked = F.try_element_at("props", F.lit("_meta_ingest")) == TRUE
    ingested = nodes.where(marked)
    if scope == "label":
        labels = fresh_nodes.select("meta_db_label").distinct()
        ingested = ingested.join(labels, "meta_db_label", "left_semi")
    gone = ingested.select("id").distinct()
    kept_nodes = nodes.join(gone, "id", "left_anti")
    kept_edges = edges
    for end in ("src", "dst"):
        kept_edges = kept_edges.join(gone.withColumnRenamed("id", end), end, "left_anti")
    return kept_nodes.unionByName(fresh_nodes), kept_edges.unionByName(fresh_edges)


def contract_violations(rows: DataFrame, kind: str, key: str = "id") -> DataFrame:
    """Rows whose property keys differ from the frozen set of their kind, with missing and extra keys.

    ``rows(key, kind, props)``; ``kind`` names the label or type column.
    """
    frozen = F.create_map(
        *[x for k, v in FROZEN_KEYS.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]).cast("array<string>"))]
    )
    wanted = F.try_element_at(frozen, F.col(kind))
    missing = F.array_sort(F.array_except(wanted, F.map_keys("props")))
    extra = F.array_sort(F.array_except(F.map_keys("props"), wanted))
    checked = rows.where(wanted.isNotNull()).select(key, kind, missing.alias("missing"), extra.alias("extra"))
    return checked.where((F.size("missing") > 0) | (F.size("extra") > 0))
