"""Declared schemas of the metadata stores.

Fixed values: column names follow the stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "tables": "table_id bigint, db string, schema_name string, name string, original_name string, description string, is_valid boolean",
    "columns": (
        "column_id bigint, table_id bigint, fqn string, name string, dtype string, nullable boolean, "
        "is_primary_key boolean, description string, is_valid boolean"
    ),
    "fk_constraints": "from_column_id bigint, to_column_id bigint, constraint_name string",
    "queries": (
        "query_id string, question string, sql_text string, status string, row_count int, execution_time_ms double, "
        "steps_count int, seen_count bigint, verified boolean, quality_gate string, steps_summary string, "
        "best_context_score double, created_at timestamp, last_seen_at timestamp"
    ),
    "query_table_usage": "query_id string, table_id bigint",
    "query_column_usage": "query_id string, column_id bigint, usage_type string",
    "value_mappings": (
        "mapping_id bigint, natural_value string, code_value string, column_id bigint, column_fqn string, "
        "usage_count bigint, verified boolean"
    ),
    "embeddings": "id string, dataset_name string, schema_name string, description string, embedding array<float>, metadata map<string,string>",
    "relationships": (
        "from_table_id bigint, to_table_id bigint, rel_type string, source_column string, target_column string, "
        "source string, description string"
    ),
    "lineage_nodes": "name string, node_type string, source_type string, extra_props string",
    "lineage_edges": "src string, dst string, edge_type string",
    "terms": "term_id bigint, glossary string, name string, description string, status string, updated_at timestamp",
    "calendar_days": "calendar string, day date, day_type string, reason string",
    "nodes": "id string, label string, labels array<string>, name string, props map<string,string>",
    "edges": "edge_id string, src string, dst string, type string, props map<string,string>",
    "ontology_schemas": (
        "id string, name string, description string, domain string, version int, schema_json string, updated_at timestamp"
    ),
    "ontology_schema_versions": "schema_id string, version int, schema_json string",
    "embedding_columns": (
        "id string, table_id string, column_name string, data_type string, description string, embedding array<float>, "
        "metadata map<string,string>, created_at timestamp, updated_at timestamp"
    ),
    "embedding_queries": (
        "id string, natural_query string, sql_query string, embedding array<float>, execution_count int, "
        "last_used_at timestamp, metadata map<string,string>, created_at timestamp"
    ),
    "embedding_ontology_nodes": (
        "id string, node_id string, node_name string, node_label string, description string, embedding array<float>, "
        "metadata map<string,string>, created_at timestamp, updated_at timestamp"
    ),
    "data_sources": "datasource_id bigint, name string, source string, created_at timestamp",
    "schemas": "schema_id bigint, db string, name string, datasource string",
    "schema_datasource": "schema_id bigint, datasource_id bigint",
    "column_relationships": (
        "from_column_id bigint, to_column_id bigint, rel_type string, source string, similarity float, "
        "match_ratio float, matched_count int, total_samples int"
    ),
    "ast_nodes": (
        "ast_node_id bigint, node_type string, name string, file_name string, directory string, start_line int, end_line int, "
        "parent_id bigint, datasource string, summary string, ai_description string, is_etl boolean, etl_operation string, "
        "stereotype string, embedding array<float>, extra_props variant, created_at timestamp"
    ),
    "ast_edges": "from_node_id bigint, to_node_id bigint, edge_type string, extra_props variant",
    "ast_table_refs": "ast_node_id bigint, table_id bigint, ref_type string",
    "user_stories": (
        "story_id bigint, ast_node_id bigint, title string, description string, acceptance_criteria string, "
        "extra_props variant, created_at timestamp"
    ),
    "etl_table_refs": "ast_node_id bigint, table_id bigint, ref_type string",
    "glossaries": "glossary_id bigint, name string, description string, type string, created_at timestamp, updated_at timestamp",
    "domains": "domain_id bigint, name string, description string",
    "owners": "owner_id bigint, name string, email string, role string",
    "tags": "tag_id bigint, name string, color string",
    "term_domains": "term_id bigint, domain_id bigint",
    "term_tags": "term_id bigint, tag_id bigint",
    "term_owners": "term_id bigint, owner_id bigint",
    "calendars": (
        "calendar_id bigint, name string, description string, year int, extra_props variant, "
        "created_at timestamp, updated_at timestamp"
    ),
    "holidays": "calendar_id bigint, date date, name string, holiday_type string",
}


def scan(spark: SparkSession, root: str, store: str) -> DataFrame:
    """A metadata store under ``root`` with its declared columns and types.

    Columns that the files lack are null and further ones are left out, as parquet reads
    by name; a filter or a choice of columns reaches the files.
    """
    return spark.read.schema(SCHEMAS[store]).parquet(f"{root}/{store}")


def save(rows: DataFrame, root: str, store: str) -> None:
    """Write ``rows`` as a new metadata store; columns are cast to the declared types."""
    declared = rows.sparkSession.createDataFrame([], SCHEMAS[store]).schema
    there = [F.col(f.name).cast(f.dataType) if f.dataType.typeName() != "variant" else F.col(f.name) for f in declared if f.name in rows.columns]
    rows.select(*there).write.parquet(f"{root}/{store}")
