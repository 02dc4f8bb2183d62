"""Lookups over a table and column catalog.

Canonical frames: ``tables(table_id, db, schema_name, name, original_name,
description, is_valid)`` and ``columns(column_id, table_id, name, dtype, nullable,
is_primary_key, description, is_valid)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.keys import joined
from catalith.functions.text import (
    blank,
    clean_words,
    contains_any,
    cut_text,
    display_name,
    fold,
    is_valid,
    lacks_text,
    matches_keywords,
    strip_ws,
)
from catalith.plans.nesting import attach, nest
from catalith.plans.ranking import top_per_group

# Default result sizes.
ANCHOR_SCORE = 0.5
ANCHOR_LIMIT = 10
LIST_LIMIT = 100


def shown_tables(tables: DataFrame) -> DataFrame:
    """Blank-default projection of a table frame."""
    return tables.select(
        "table_id",
        blank("schema_name").alias("schema_name"),
        blank("name").alias("name"),
        blank("description").alias("description"),
    )


def valid_tables(tables: DataFrame) -> DataFrame:
    return tables.where(is_valid("is_valid"))


def cleaned_names(names: DataFrame, name_col: str = "name", request: str | None = None, cap: int | None = None) -> DataFrame:
    """Stripped, lowered, non-blank names; with ``request`` and ``cap`` at most so many names per request."""
    key = F.lower(strip_ws(blank(name_col)))
    if request is None:
        return names.select(key.alias("key")).where(F.length("key") > 0).distinct()
    keyed = names.select(request, key.alias("key")).where(F.length("key") > 0).distinct()
    return keyed if cap is None else top_per_group(keyed, [request], [F.col("key")], cap)


def tables_by_names(tables: DataFrame, names: DataFrame, name_col: str = "name", schema: str | None = None) -> DataFrame:
    """Valid tables whose lowered name is in ``names``."""
    rows = valid_tables(tables)
    if schema:
        rows = rows.where(fold("schema_name") == schema.lower())
    keyed = rows.withColumn("key", fold("name"))
    return shown_tables(keyed.join(cleaned_names(names, name_col), "key", "left_semi"))


def embedding_texts(tables: DataFrame, names: DataFrame, text_col: str, name_col: str = "name") -> DataFrame:
    """``(fqn, text)`` with the lowered ``schema.name`` key; a blank schema leaves no dot."""
    fqn = F.lower(F.concat_ws(".", F.nullif("schema_name", F.lit("")), F.col("name")))
    keyed = tables.withColumn("key", fold("name")).join(cleaned_names(names, name_col), "key", "left_semi")
    return keyed.where(F.length(text_col) > 0).select(fqn.alias("fqn"), F.col(text_col).alias("text"))


def columns_for_keys(tables: DataFrame, columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Columns of the tables named by ``(db, schema_name, name)`` rows of ``keys``."""
    wanted = tables.join(keys, ["db", "schema_name", "name"], "left_semi")
    shown = wanted.select("table_id", "db", "schema_name", F.col("name").alias("table_name"))
    picked = columns.select("table_id", F.col("name").alias("column_name"), "dtype", "nullable")
    return shown.join(picked, "table_id")


def alias_keys(tables: DataFrame) -> DataFrame:
    """``(key, table_id)``: one row per lowered name and original name of a table."""
    both = F.array_distinct(F.array(fold("name"), fold("original_name")))
    return tables.select("table_id", F.explode(both).alias("key")).where(F.length("key") > 0)


def match_alias(tables: DataFrame, names: DataFrame, name_col: str = "name") -> DataFrame:
    """``(key, table_id)`` for every wanted name that is a name or an original name.

    The OR of the two names is an equi-join on exploded alias keys.
    """
    return alias_keys(tables).join(cleaned_names(names, name_col), "key", "left_semi").distinct()


def first_match(tables: DataFrame) -> DataFrame:
    """One table per alias key, the lowest id; the dimension for single-row lookups."""
    return alias_keys(tables).groupBy("key").agg(F.min("table_id").alias("table_id"))


def tables_without_description(tables: DataFrame, schema: str | None = None) -> DataFrame:
    rows = tables.where(lacks_text("description"))
    if schema:
        rows = rows.where(F.col("schema_name") == schema)
    return rows.select("table_id", "db", "schema_name", "name").orderBy("name", "table_id")


def column_counts(columns: DataFrame) -> DataFrame:
    return columns.groupBy("table_id").agg(F.count(F.lit(1)).alias("column_count"))


def schema_tables(
    tables: DataFrame, columns: DataFrame, search: str | None = None, schema: str | None = None, limit: int | None = LIST_LIMIT
) -> DataFrame:
    """Tables matching a substring of name or description, with their column count."""
    rows = tables
    if schema:
        rows = rows.where(F.col("schema_name") == schema)
    if search:
        rows = rows.where(contains_any("name", [search]) | contains_any("description", [search]))
    if limit is not None:
        order = [F.col(c).asc_nulls_last() for c in ("db", "schema_name", "name", "table_id")]
        rows = rows.orderBy(*order).limit(limit)
    counted = rows.join(column_counts(columns), "table_id", "left")
    return counted.withColumn("column_count", F.coalesce("column_count", F.lit(0)))


def anchor_columns(
    tables: DataFrame,
    columns: DataFrame,
    substrings: Sequence[str] = (),
    keywords: Sequence[str] = (),
    per_table: int = ANCHOR_LIMIT,
    max_words: int | None = None,
) -> DataFrame:
    """Columns whose name has a substring, or whose name or description has a keyword; top by name per table.

    The two word lists are parameters of one request, so they are predicates on the
    scan and need no join; ``max_words`` cuts each of them, by default none is lost.
    """
    subs, words = clean_words(substrings, max_words), clean_words(keywords, max_words)
    match = contains_any("name", subs + words) | contains_any("description", words)
    hits = columns.where(is_valid("is_valid") & match)
    hits = top_per_group(hits, ["table_id"], [F.col("name"), F.col("column_id")], per_table)
    parents = valid_tables(tables).select(
        "table_id", blank("schema_name").alias("table_schema"), display_name().alias("table_name")
    )
    return hits.join(parents, "table_id").select(
        "table_schema",
        "table_name",
        F.col("name").alias("column_name"),
        "dtype",
        blank("description").alias("description"),
        F.lit(ANCHOR_SCORE).alias("score"),
    )


def queries_by_keyword(queries: DataFrame, text_col: str, keywords: Sequence[str], order: Sequence[Column], limit: int | None) -> DataFrame:
    """Rows whose text matches any keyword as a case-insensitive literal, first by ``order``."""
    hits = queries.where(matches_keywords(text_col, keywords))
    return hits if limit is None else hits.orderBy(*order).limit(limit)


def columns_by_prefix(tables: DataFrame, columns: DataFrame, prefix: str) -> DataFrame:
    """Columns whose ``db.schema.table.column`` name starts with ``prefix``."""
    names = tables.select("table_id", joined("db", "schema_name", "name").alias("table_fqn"))
    fqn = F.concat("table_fqn", F.lit("."), "name").alias("fqn")
    return columns.join(names, "table_id").select("column_id", fqn, "dtype").where(F.startswith("fqn", F.lit(prefix)))


def table_sample(tables: DataFrame) -> DataFrame:
    """Names and descriptions cut for display: 60, 40 and 200 characters."""
    return tables.select(
        "table_id",
        cut_text("name", 60).alias("name"),
        cut_text("schema_name", 40).alias("schema_name"),
        cut_text("description", 200).alias("description"),
    )


def list_entities(df: DataFrame, columns: Sequence[str], order: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Filtered listing in a given order, NULLs last."""
    rows = df if condition is None else df.where(condition)
    return rows.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def table_columns(tables: DataFrame, columns: DataFrame) -> DataFrame:
    names = tables.select("table_id", F.col("name").alias("table_name"), "schema_name")
    joined_rows = columns.select(
        "table_id", F.col("name").alias("column_name"), "dtype", "nullable", "is_primary_key", "description"
    ).join(names, "table_id")
    wanted = ["schema_name", "table_name", "column_name", "dtype", "nullable", "is_primary_key", "description"]
    return list_entities(joined_rows, wanted, ["schema_name", "table_name", "column_name"])


def table_schemas(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Valid tables with their valid columns nested in name order; tables without columns keep an empty array."""
    item = ["name", "dtype", "nullable", "is_primary_key", blank("description").alias("description")]
    nested = nest(columns.where(is_valid("is_valid")), ["table_id"], item, "columns")
    parents = valid_tables(tables).select(
        "table_id",
        blank("schema_name").alias("schema_name"),
        display_name().alias("table_name"),
        blank("description").alias("description"),
    )
    return attach(parents, {"columns": nested}, ["table_id"])


def exists_batch(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``wanted`` with a flag telling whether a row with the same keys exists."""
    found = rows.select(*keys).distinct().withColumn("__found", F.lit(True))
    return wanted.join(found, list(keys), "left").withColumn("exists", F.coalesce("__found", F.lit(False))).drop("__found")


def code_values(groups: DataFrame, codes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Names of code values inside their code group.

    ``groups(group_id, group_name)``, ``codes(group_id, code_value, code_name)``,
    ``wanted(group_name, code_value)``.
    """
    named = codes.join(groups, "group_id").select("group_name", "code_value", "code_name")
    return wanted.distinct().join(named, ["group_name", "code_value"])
