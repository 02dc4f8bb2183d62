"""Catalog snapshots: reading, normalising, validating and exploding.

A snapshot is one row per table, ``(meta_db_label, schema, source_engine, source
map, name, comment, table_type, columns array<struct>)``, written as JSON lines or
parquet, so a large catalog is never one document in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.text import blank, or_default
from catalith.functions.values import secret_keys, without_secrets
from catalith.sources.harvest import BASE_TABLE, DEFAULT_ENGINE

# Fixed values.
LABEL_PATTERN = "^[a-z0-9_]+$"
COLUMN_STRUCT = (
    "struct<column_name:string,ordinal_position:int,data_type:string,udt_name:string,character_maximum_length:int,"
    "numeric_precision:int,numeric_scale:int,is_nullable:string,column_default:string,col_comment:string,is_unique:boolean>"
)
FK_STRUCT = (
    "struct<constraint_name:string,from_schema:string,from_table:string,from_column:string,"
    "to_schema:string,to_table:string,to_column:string,position:int>"
)
DOCUMENT_SCHEMA = (
    "version int, contract_version string, meta_db_label string, schema string, source_engine string, source map<string,string>, "
    f"tables array<struct<name:string,comment:string,table_type:string,columns:array<{COLUMN_STRUCT}>>>, "
    f"primary_keys array<array<string>>, foreign_keys array<{FK_STRUCT}>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole-document snapshots, one JSON document per file."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path, multiLine=True)


def document_frames(documents: DataFrame) -> dict[str, DataFrame]:
    """Document snapshots as flat ``tables``, ``columns``, ``primary_keys`` and ``foreign_keys``."""
    scope = ["meta_db_label", "schema"]
    tables = documents.select(*scope, "source_engine", "source", F.explode("tables").alias("t"))
    flat = tables.select(*scope, "source_engine", "source", "t.name", "t.comment", "t.table_type", "t.columns")
    pks = documents.select(*scope, F.explode("primary_keys").alias("k"))
    return {
        "tables": flat.drop("columns"),
        "columns": explode_columns(flat),
        "primary_keys": pks.select(*scope, F.col("k")[0].alias("table_name"), F.col("k")[1].alias("column_name")),
        "foreign_keys": documents.select(*scope, F.explode("foreign_keys").alias("f")).select(*scope, "f.*"),
    }


def explode_columns(tables: DataFrame) -> DataFrame:
    """One row per column of a nested table frame."""
    scope = ["meta_db_label", "schema"]
    rows = tables.select(*scope, F.col("name").alias("table_name"), F.explode("columns").alias("c"))
    return rows.select(*scope, "table_name", "c.*")


def write_snapshot(tables: DataFrame, path: str) -> None:
    """JSON lines in gzip files, which are a tenth of the plain text and read back alike."""
    tables.write.json(path, compression="gzip")


def normalize(tables: DataFrame) -> DataFrame:
    """Default engine and table type, secrets removed from the source map."""
    rows = tables.withColumn("source_engine", or_default("source_engine", DEFAULT_ENGINE))
    rows = rows.withColumn("table_type", F.coalesce("table_type", F.lit(BASE_TABLE)))
    if "source" in rows.columns:
        rows = rows.withColumn("source", without_secrets("source"))
    return rows


def violations(snapshots: DataFrame) -> DataFrame:
    """One row per violated rule; ``snapshots(meta_db_label, schema, source_engine, source, table_count)``."""
    label = blank("meta_db_label")
    secrets = F.coalesce(secret_keys("source"), F.array().cast("array<string>"))
    rules: list[tuple[Column, Column]] = [
        (label == "", F.lit("label is empty")),
        ((label != "") & ~label.rlike(LABEL_PATTERN), F.lit("label has characters outside a-z, 0-9 and _")),
        (blank("schema") == "", F.lit("schema is empty")),
        (blank("source_engine") == "", F.lit("source engine is missing")),
        (F.coalesce("table_count", F.lit(0)) == 0, F.lit("no tables")),
        (F.size(secrets) > 0, F.concat(F.lit("secret keys: "), F.array_join(secrets, ","))),
    ]
    found = F.filter(F.array(*[F.when(bad, text) for bad, text in rules]), lambda v: v.isNotNull())
    return snapshots.select("meta_db_label", "schema", F.explode(found).alias("violation"))


def audit_lines(snapshots: DataFrame, target: str | None = None) -> DataFrame:
    """One line per snapshot for the ingest log, without user names or secrets."""

    def quoted(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None"))

    source = F.col("source")
    parts = [
        F.concat(F.lit("meta_db_label="), quoted(F.col("meta_db_label"))),
        F.concat(F.lit("schema="), quoted(F.col("schema"))),
        F.concat(F.lit("source_engine="), quoted(F.col("source_engine"))),
        F.concat(F.lit("source_host="), quoted(F.try_element_at(source, F.lit("host")))),
        F.concat(F.lit("source_port="), quoted(F.try_element_at(source, F.lit("port")))),
        F.concat(F.lit("source_dbname="), quoted(F.try_element_at(source, F.lit("dbname")))),
    ]
    if target is not None:
        parts.append(F.lit(f"target={target}"))
    return snapshots.select(F.concat(F.lit("ingest_audit: "), F.concat_ws(" ", *parts)).alias("line"))
