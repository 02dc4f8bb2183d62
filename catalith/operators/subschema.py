"""Sub-schema of a question: table and column hits, their columns, keys and join hints, as prompt text.

A batch of requests is one lazy plan.  Vectors take part only in the two scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.keys import joined
from catalith.functions.text import blank, display_name, is_valid
from catalith.operators import fk
from catalith.operators.vector import DEFAULT_COLUMNS_K, DEFAULT_TABLES_K, vector_topk, vector_topk_with_parent
from catalith.plans.lineage_cut import cut
from catalith.plans.nesting import nest

# The prompt's headings and line formats.
TABLES_HEADING = "=== Available Tables ==="
FK_HEADING = "\n=== Foreign Key Relationships ==="
JOIN_HEADING = "\n=== Suggested Joins ==="
TABLE_LINE = "\nTable: %s.%s"
DESCRIPTION_LINE = "  Description: %s"
COLUMNS_LINE = "  Columns:"
COLUMN_LINE = "    - %s (%s, %s)"
COLUMN_DESCRIPTION = " - %s"
FK_LINE = "  %s.%s -> %s.%s"
HINT_LINE = "  %s"


def build_subschema(
    tables: DataFrame,
    columns: DataFrame,
    fks: DataFrame,
    table_vectors: DataFrame,
    column_vectors: DataFrame,
    requests: DataFrame,
    k_tables: int = DEFAULT_TABLES_K,
    k_columns: int = DEFAULT_COLUMNS_K,
    request_id: str = "qid",
) -> dict[str, DataFrame]:
    """Frames ``tables``, ``columns``, ``members``, ``table_columns``, ``fks`` of every request.

    ``table_vectors(table_id, embedding)``, ``column_vectors(column_id, table_id,
    embedding, is_valid)``.  ``members`` is the union of the hit tables and the
    parents of the hit columns that have a database, a schema and a name.
    """
    valid = tables.where(is_valid("is_valid"))
    searchable = table_vectors.join(valid.select("table_id"), "table_id", "left_semi")
    hits = vector_topk(searchable, requests, k_tables, id_col="table_id", request_id=request_id)
    shown = valid.select("table_id", "db", "schema_name", "name", display_name().alias("table_name"), "description")
    # Hits are a few rows per request and feed every later frame; they are kept, so
    # the vectors are scanned once.
    table_hits = cut(hits.join(shown, "table_id"))
    column_hits = vector_topk_with_parent(
        column_vectors,
        tables,
        requests,
        k_columns,
        id_col="column_id",
        request_id=request_id,
        parent_columns=("db", "schema_name", "name"),
        valid_parents_only=True,
    )
    column_hits = cut(column_hits)
    named = (F.length("db") > 0) & (F.length("schema_name") > 0) & (F.length("name") > 0)
    members = (
        table_hits.where(named)
        .select(F.col(request_id).alias("request_id"), "table_id")
        .unionByName(column_hits.where(named).select(F.col(request_id).alias("request_id"), "table_id"))
        .distinct()
    )
    # Both ends of a wanted key belong to a member table, so only their columns take part.
    own = columns.join(members.select("table_id").distinct(), "table_id", "left_semi")
    table_columns = own.join(members, "table_id")
    edges = fk.fk_edges(tables, own, fks)
    details = cut(fk.fk_details(edges, members, limit=None))
    return {
        "tables": table_hits,
        "columns": column_hits,
        "members": members,
        "table_columns": table_columns,
        "fks": fk.join_hints(details),
    }


def prompt_text(found: dict[str, DataFrame], request_id: str = "qid") -> DataFrame:
    """``(request_id, part, prompt)``: the text of every request, one part unless it is very long."""
    hits = found["tables"].withColumnRenamed(request_id, "request_id")
    owned = found["table_columns"].join(hits.select("request_id", "table_id", "rank"), ["request_id", "table_id"])

    def line(section: int, place, kind: int, key, text: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            (F.lit(place) if isinstance(place, int) else place).cast("int").alias("place"),
            F.lit(kind).alias("kind"),
            (F.lit(key) if isinstance(key, str) else key).alias("key"),
            text.alias("line"),
        )

    def lines(df: DataFrame, *made: Column) -> DataFrame:
        """Several lines per row; repeated headings fall together in the set below."""
        rows = df.select("request_id", F.explode(F.array(*made)).alias("l"))
        return rows.where(F.col("l.line").isNotNull()).select("request_id", "l.*")

    fmt, rank = F.format_string, F.col("rank")
    described = F.length("description") > 0
    table_lines = lines(
        hits,
        line(0, 0, 0, "", F.lit(TABLES_HEADING)),
        line(1, rank, 0, "", fmt(TABLE_LINE, F.col("schema_name"), F.col("table_name"))),
        line(1, rank, 1, "", F.when(described, fmt(DESCRIPTION_LINE, F.col("description")))),
    )
    null_text = F.when(F.coalesce("nullable", F.lit(False)), "NULL").otherwise("NOT NULL")
    column_line = F.concat(
        fmt(COLUMN_LINE, F.col("name"), blank("dtype"), null_text),
        F.when(described, fmt(COLUMN_DESCRIPTION, F.col("description"))).otherwise(""),
    )
    column_lines = lines(
        owned, line(1, rank, 2, "", F.lit(COLUMNS_LINE)), line(1, rank, 3, F.col("name"), column_line)
    )
    from_table, to_table = joined("from_schema_name", "from_table"), joined("to_schema_name", "to_table")
    key = F.concat_ws("\u0001", from_table, "from_column", to_table, "to_column")
    fk_line = fmt(FK_LINE, from_table, F.col("from_column"), to_table, F.col("to_column"))
    fk_lines = lines(
        found["fks"],
        line(2, 0, 0, "", F.lit(FK_HEADING)),
        line(2, 0, 1, key, fk_line),
        line(3, 0, 0, "", F.lit(JOIN_HEADING)),
        line(3, 0, 1, key, fmt(HINT_LINE, F.col("hint"))),
    )
    rows = table_lines.unionByName(column_lines).unionByName(fk_lines)
    nested = nest(rows, ["request_id"], ["section", "place", "kind", "key", "line"], "lines", distinct=True)
    return nested.select("request_id", "part", F.array_join(F.col("lines.line"), "\n").alias("prompt"))
