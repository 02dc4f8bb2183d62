"""Load operators: each binds the generic merge to the column policies of one store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.keys import joined, usage_fqn
from catalith.functions.text import blank, fold, lacks_text
from catalith.functions.values import usage_type
from catalith.operators import merge as M
from catalith.operators.fk import RELATION_TYPES
from catalith.plans.lineage_cut import cut, stored
from catalith.plans.ranking import first_per_key
from catalith.plans.sizing import task_count

# Fixed values.
INFERRED_SOURCE, DDL_SOURCE, USER_SOURCE = "sample_data_inference", "ddl", "user"
DEFAULT_SCHEMA = "public"


def merge_embeddings(current: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str], kept: Sequence[str] = ()) -> DataFrame:
    """Embedding rows by id: the last change wins, ``kept`` columns stay as first written."""
    policies = {c: M.keep() if c in kept else M.incoming() for c in current.columns if c != key}
    return M.merge_upsert(current, changes, [key], policies, order_by)


def merge_query_embeddings(current: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str], run_ts: Column) -> DataFrame:
    """Query embeddings: as above, plus an execution counter and the last use."""
    policies = {c: M.incoming() for c in current.columns if c != key}
    policies["execution_count"] = M.counter()
    policies["last_used_at"] = M.now(run_ts)
    return M.merge_upsert(current, changes, [key], policies, order_by)


def merge_catalog(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Snapshot tables or columns: flags and texts replaced, metadata maps merged shallowly."""
    policies = {c: M.map_merge() if c == "metadata" else M.incoming() for c in current.columns if c not in keys}
    return M.merge_upsert(current, snapshot, keys, policies, order_by)


def merge_fk_pairs(current: DataFrame, pairs: DataFrame) -> DataFrame:
    """New FK column pairs are added, known ones stay."""
    return M.insert_only(current, pairs, ["from_column_id", "to_column_id"], ["constraint_name"])


DDL_KEYS = {"schemas": ["db", "name"], "tables": ["db", "schema_name", "name"], "columns": ["fqn"]}


def merge_ddl(
    store: dict[str, DataFrame], schemas: DataFrame, tables: DataFrame, columns: DataFrame, fks: DataFrame
) -> dict[str, DataFrame]:
    """Load parsed DDL into schema, table, column and relationship frames.

    An empty data source or primary-key constraint never overwrites one; tables
    named only as an FK target become stubs; FK rows are marked as coming from DDL.
    Every change frame carries ``seq``, its order in the load.
    """
    out: dict[str, DataFrame] = {}
    out["schemas"] = M.merge_upsert(store["schemas"], schemas, DDL_KEYS["schemas"], {"datasource": M.non_empty()}, ["seq"])
    table_policies = {
        "description": M.incoming(),
        "description_source": M.incoming(),
        "table_type": M.incoming(),
        "datasource": M.non_empty(),
    }
    loaded = M.merge_upsert(store["tables"], tables, DDL_KEYS["tables"], table_policies, ["seq"])
    column_policies = {
        c: M.incoming() for c in ("name", "dtype", "description", "description_source", "nullable", "is_primary_key")
    }
    column_policies |= {
        "pk_constraint": M.non_empty(),
        "datasource": M.non_empty(),
        "table_db": M.coalesce_incoming(),
        "table_schema": M.coalesce_incoming(),
        "table_name": M.coalesce_incoming(),
    }
    out["columns"] = M.merge_upsert(store["columns"], columns, DDL_KEYS["columns"], column_policies, ["seq"])

    key = ["db", "schema_name", "name"]
    known = store["tables"].select(*key).unionByName(tables.select(*key)).distinct()
    target = fks.select(
        F.col("to_db").alias("db"), blank("to_schema").alias("schema_name"), blank("to_table").alias("name")
    ).distinct()
    stubs = target.join(known, key, "left_anti")
    extra = [c for c in loaded.columns if c not in [*key, M.ACTION]]
    stub_rows = stubs.select(
        *key, *[F.lit(None).cast(loaded.schema[c].dataType).alias(c) for c in extra], F.lit("insert").alias(M.ACTION)
    )
    out["tables"] = loaded.unionByName(stub_rows)

    source = known.select(
        F.col("db").alias("from_db"), F.col("schema_name").alias("from_schema"), F.col("name").alias("from_table")
    )
    rows = fks.join(source, ["from_db", "from_schema", "from_table"], "left_semi").select(
        "from_db",
        "from_schema",
        "from_table",
        "to_db",
        blank("to_schema").alias("to_schema"),
        blank("to_table").alias("to_table"),
        F.lit("FK_TO_TABLE").alias("rel_type"),
        blank("from_column").alias("source_column"),
        blank("to_column").alias("target_column"),
        F.lit(DDL_SOURCE).alias("source"),
        "seq",
    )
    keys = [c for c in rows.columns if c not in ("source", "seq")]
    out["relationships"] = M.merge_upsert(store["relationships"], rows, keys, {"source": M.constant(DDL_SOURCE)}, ["seq"])
    return out


RELATION_KEYS = ["from_table_id", "to_table_id", "rel_type", "source_column", "target_column"]


def _known_ends(tables: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Rows whose two tables exist, with their ids; ``(schema, name)`` picks the lowest id.

    With ``how="left"`` the other rows stay, and ``from_known`` and ``to_known`` are set where a table exists.
    """
    ids = tables.groupBy(F.col("schema_name").alias("s"), F.col("name").alias("t")).agg(F.min("table_id").alias("id"))
    for end in ("from", "to"):
        side = ids.select(
            F.col("s").alias(f"{end}_schema"), F.col("t").alias(f"{end}_table"), F.col("id").alias(f"{end}_table_id"),
            *[F.lit(True).alias(f"{end}_known")] * (how == "left"),
        )
        rows = rows.join(side, [f"{end}_schema", f"{end}_table"], how)
    return rows


def merge_inferred_fks(relationships: DataFrame, columns: DataFrame, column_links: DataFrame, tables: DataFrame, found: DataFrame) -> dict[str, DataFrame]:
    """Inferred keys: a relationship known from DDL stays DDL; missing columns become stubs.

    ``found(from_schema, from_table, from_column, to_schema, to_table, to_column, seq)``.
    Keys with an unknown table are dropped.
    """
    # The resolved keys feed three results and are derived once.
    rows = cut(_known_ends(tables, found))
    changes = rows.select(
        "from_table_id",
        "to_table_id",
        F.lit("FK_TO_TABLE").alias("rel_type"),
        blank("from_column").alias("source_column"),
        blank("to_column").alias("target_column"),
        F.lit(INFERRED_SOURCE).alias("source"),
        "seq",
    )
    merged = M.merge_upsert(relationships, changes, RELATION_KEYS, {"source": M.sticky(DDL_SOURCE)}, ["seq"])

    def end(e: str) -> DataFrame:
        return rows.select(
            joined(f"{e}_schema", f"{e}_table", f"{e}_column").alias("fqn"),
            F.col(f"{e}_table_id").alias("table_id"),
            blank(f"{e}_column").alias("name"),
            "seq",
        )

    policies = {"table_id": M.coalesce_incoming(), "name": M.keep()}
    stubs = M.merge_upsert(columns, end("from").unionByName(end("to")), ["fqn"], policies, ["seq"])
    links = rows.select(
        joined("from_schema", "from_table", "from_column").alias("from_fqn"),
        joined("to_schema", "to_table", "to_column").alias("to_fqn"),
        F.lit("FK_TO_COLUMN").alias("rel_type"),
        F.lit(INFERRED_SOURCE).alias("source"),
        "seq",
    )
    added = M.insert_only(column_links, links, ["from_fqn", "to_fqn", "rel_type"], ["seq"])
    return {"relationships": merged, "columns": stubs, "column_links": added}


def fill_descriptions(current: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Missing descriptions are filled and tagged; present ones and unknown keys stay untouched."""
    tagged = changes.withColumn("description_source", F.lit(INFERRED_SOURCE))
    lacking = current.where(lacks_text("description"))
    fillable = tagged.join(lacking.select(*keys), list(keys), "left_semi")
    policies = {"description": M.fill_if_missing(), "description_source": M.incoming()}
    return M.merge_upsert(current, fillable, keys, policies, order_by, insert=False)


def override_descriptions(current: DataFrame, changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """User descriptions by table name; a row with a NULL schema takes any schema's change.

    ``changes(name, schema_name, description)``.
    """
    ordered = F.struct(*order_by)
    exact = changes.groupBy("name", "schema_name").agg(
        F.max_by("description", ordered).alias("__d"), F.max(ordered).alias("__o")
    )
    loose = exact.groupBy("name").agg(F.max_by("__d", "__o").alias("__any"), F.lit(True).alias("__has_any"))
    hit = exact.select("name", "schema_name", "__d", F.lit(True).alias("__has"))
    rows = current.join(hit, ["name", "schema_name"], "left").join(loose, "name", "left")
    no_schema = F.col("schema_name").isNull() & F.coalesce("__has_any", F.lit(False))
    touched = F.coalesce("__has", F.lit(False)) | no_schema
    return rows.select(
        *[F.col(c) for c in current.columns if c not in ("description", "description_source")],
        F.when(F.col("__has"), F.col("__d")).when(no_schema, F.col("__any")).otherwise(F.col("description")).alias("description"),
        F.when(touched, F.lit(USER_SOURCE)).otherwise(F.col("description_source")).alias("description_source"),
        F.when(touched, "update").otherwise("keep").alias(M.ACTION),
    )


def merge_relationships(relationships: DataFrame, tables: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User relationships ``(merged, rejected)``; a bad type or an unknown table is a rejected row.

    ``asked(from_schema, from_table, from_column, to_schema, to_table, to_column,
    rel_type, description, seq)``.  The asked rows are looked up once, and both results read
    what was found.
    """
    allowed = F.coalesce(F.col("rel_type").isin(*RELATION_TYPES), F.lit(False))
    found = F.col("from_known").isNotNull() & F.col("to_known").isNotNull()
    reason = F.when(~allowed, "type not allowed").when(~found, "table not found").alias("reason")
    told = ["from_table_id", "to_table_id", "rel_type", "from_column", "to_column", "description", "seq"]
    looked_up = stored(_known_ends(tables, asked, "left").select(*told, reason), "asked")
    changes = looked_up.where("reason IS NULL").select(
        "from_table_id",
        "to_table_id",
        "rel_type",
        F.col("from_column").alias("source_column"),
        F.col("to_column").alias("target_column"),
        F.lit(USER_SOURCE).alias("source"),
        "description",
        "seq",
    )
    policies = {"source": M.incoming(), "description": M.incoming()}
    merged = M.merge_upsert(relationships, changes, RELATION_KEYS, policies, ["seq"])
    return merged, looked_up.where("reason IS NOT NULL").select("seq", "reason")


def merge_value_mappings(current: DataFrame, changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Value mappings: code and verification replaced, column id kept when unknown, usage counted."""
    policies = {
        "code_value": M.incoming(),
        "column_id": M.coalesce_incoming(),
        "usage_count": M.counter(),
        "verified": M.incoming(),
    }
    return M.merge_upsert(current, changes, ["natural_value", "column_fqn"], policies, order_by)


def mappings_by_column_name(changes: DataFrame, columns: DataFrame) -> DataFrame:
    """Resolve mappings given by bare column name; unknown names are skipped, the lowest id wins.

    ``columns(column_id, fqn, name)``.
    """
    named = columns.select(fold("name").alias("__key"), "column_id", blank("fqn").alias("column_fqn"))
    first = first_per_key(named, ["__key"], ["column_id"])
    return changes.withColumn("__key", fold("column_name")).join(first, "__key").drop("__key", "column_name")


def merge_schema_documents(schemas: DataFrame, versions: DataFrame, documents: DataFrame, run_ts: Column) -> dict[str, DataFrame]:
    """Schema documents: the last version is current, every (schema, version) is kept once.

    ``documents(id, name, description, domain, version, schema_json, seq)``.
    """
    policies = {c: M.incoming() for c in ("name", "description", "domain", "version", "schema_json")}
    policies["updated_at"] = M.now(run_ts)
    current = M.merge_upsert(schemas, documents, ["id"], policies, ["seq"])
    history = M.insert_only(
        versions, documents.select(F.col("id").alias("schema_id"), "version", "schema_json", "seq"), ["schema_id", "version"], ["seq"]
    )
    return {"schemas": current, "versions": history}


def schema_versions(versions: DataFrame) -> DataFrame:
    return versions.orderBy("schema_id", F.col("version").desc())


def merge_calendar_days(current: DataFrame, changes: DataFrame, order_by: Sequence[str], text: str = "reason") -> DataFrame:
    """Calendar days: the reason (or name) is replaced, the day type stays."""
    return M.merge_upsert(current, changes, ["calendar", "day"], {text: M.incoming(), "day_type": M.keep()}, order_by)


def usage_rebuild(
    table_usage: DataFrame,
    column_usage: DataFrame,
    rewritten: DataFrame,
    named_tables: DataFrame,
    named_columns: DataFrame,
    tables: DataFrame,
    columns: DataFrame,
) -> dict[str, DataFrame]:
    """Usage rows of rewritten queries are dropped and derived again from the names they mention.

    ``rewritten(query_id)``, ``named_tables(query_id, db, schema, name)``,
    ``named_columns(query_id, schema, table, name, purpose)``, ``columns(column_id,
    fqn)``.  A table matches by name or original name inside (db, schema); the
    lowest id wins.
    """
    tasks = task_count(table_usage, column_usage, named_columns, columns)
    ids = rewritten.select("query_id").repartition(tasks, "query_id").distinct()
    named = named_tables.select(
        "query_id", fold("db").alias("db"), fold(F.trim("schema")).alias("schema"), fold(F.trim("name")).alias("key")
    ).where((F.length("schema") > 0) & (F.length("key") > 0))
    aliases = tables.select(
        fold("db").alias("db"),
        fold("schema_name").alias("schema"),
        F.explode(F.array_distinct(F.array(fold("name"), fold("original_name")))).alias("key"),
        "table_id",
    )
    dimension = aliases.where(F.length("key") > 0).groupBy("db", "schema", "key").agg(F.min("table_id").alias("table_id"))
    fresh_tables = named.join(dimension, ["db", "schema", "key"]).select("query_id", "table_id").distinct()

    used = named_columns.select(
        "query_id",
        F.lower(usage_fqn(F.trim("schema"), F.trim("table"), F.trim("name"))).alias("key"),
        usage_type("purpose").alias("usage_type"),
        F.trim("table").alias("t"),
        F.trim("name").alias("n"),
    ).where((F.length("t") > 0) & (F.length("n") > 0))
    keyed = columns.select(fold("fqn").alias("key"), "column_id").repartition(tasks, "key")
    by_fqn = keyed.groupBy("key").agg(F.min("column_id").alias("column_id"))
    matched = used.select("query_id", "key", "usage_type").repartition(tasks, "key").join(by_fqn, "key")
    fresh_columns = matched.select("query_id", "column_id", "usage_type").repartition(tasks, "query_id", "column_id").distinct()
    return {
        "table_usage": table_usage.repartition(tasks, "query_id").join(ids, "query_id", "left_anti").unionByName(fresh_tables),
        "column_usage": column_usage.repartition(tasks, "query_id").join(ids, "query_id", "left_anti").unionByName(fresh_columns),
    }


def dump_to_tables(existing_tables: DataFrame, existing_columns: DataFrame, nodes: DataFrame) -> dict[str, DataFrame]:
    """Route dumped nodes by label into catalog tables and columns, known keys untouched.

    ``nodes(id, labels, props map)``.  Catalog labels are ``Table`` and
    ``Fabric_Table`` (columns alike); ``Analyzer_*`` labels go to the analyzer
    frames, whose columns need no parent.  A catalog column needs a table of its
    ``table_name``; the lowest key wins when several match.
    """
    labelled = nodes.select("id", F.explode("labels").alias("label"), "props")

    def prop(name: str, default: str = "") -> Column:
        return F.coalesce(F.try_element_at("props", F.lit(name)), F.lit(default))

    def table_rows(labels: Sequence[str]) -> DataFrame:
        return labelled.where(F.col("label").isin(*labels)).select(
            prop("db").alias("db"),
            prop("schema", DEFAULT_SCHEMA).alias("schema_name"),
            prop("name").alias("name"),
            prop("description").alias("description"),
            "id",
        )

    def column_rows(labels: Sequence[str]) -> DataFrame:
        return labelled.where(F.col("label").isin(*labels)).select(
            prop("fqn").alias("fqn"),
            prop("name").alias("name"),
            prop("type").alias("dtype"),
            prop("table_name").alias("table_name"),
            "id",
        ).where(F.length("fqn") > 0)

    key = ["db", "schema_name", "name"]
    tables = M.insert_only(existing_tables, table_rows(["Fabric_Table", "Table"]), key, ["id"]).drop(M.ACTION)
    parents = tables.groupBy(F.col("name").alias("table_name")).agg(F.min(F.struct(*key)).alias("parent"))
    attached = column_rows(["Fabric_Column", "Column"]).join(parents, "table_name")
    rows = attached.select("fqn", "name", "dtype", F.col("parent.db").alias("db"), F.col("parent.schema_name").alias("schema_name"), "table_name", "id")
    columns = M.insert_only(existing_columns, rows, ["fqn"], ["id"]).drop(M.ACTION)
    analyzer = table_rows(["Analyzer_Table"])
    return {
        "tables": tables,
        "columns": columns,
        "analyzer_tables": first_per_key(analyzer, key, ["id"]).drop("id"),
        "analyzer_columns": first_per_key(column_rows(["Analyzer_Column"]), ["fqn"], ["id"]).drop("id"),
    }

