"""Labelled property graph as two frames.

``nodes(id, label, name, ..)`` and ``edges(src, dst, type, ..)``; stores write them
partitioned by label and type, so label scans and typed joins read only their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import contains_any
from catalith.functions.values import VECTOR_KEYS, VECTOR_LENGTH, json_or_empty, primary_label, safe_properties, typed_without_vectors
from catalith.operators import merge as M
from catalith.plans.lineage_cut import stored
from catalith.plans.nesting import attach, nest
from catalith.plans.ranking import first_per_key
from catalith.plans.sizing import task_count

# Label and edge vocabulary of the model layer.
LAYERS = ("KPI", "Measure", "Driver", "Process", "Resource")
TYPE_LABEL = "OntologyType"
STRUCTURAL_EDGE = "HAS_NODE"
LINK_DEFAULTS = {"lag": 0, "importance": 0.0, "correlationScore": 0.0, "grangerPValue": 1.0, "confidence": 0.0}


# ---------------------------------------------------------------- load


def graph_load(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dumped nodes and edges as ``(nodes, edges, skipped)``.

    ``nodes(id, labels, props)``, ``edges(edge_id, src, dst, type, props)``.  The
    last label names the node, property keys are sanitised, NaN becomes NULL and
    is dropped; edges with a missing end are skipped.
    """
    no_nan = F.map_filter("props", lambda _k, v: F.lower(v) != "nan")
    loaded = nodes.select(
        "id", primary_label("labels").alias("label"), "labels", safe_properties(no_nan).alias("props")
    )
    kept, skipped = edge_resolution(edges, loaded)
    return loaded, kept, skipped


def edge_resolution(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with both ends known, and the rest; the ends are looked up once for both."""
    tagged = stored(with_known_ends(edges, nodes), "edges")
    return tagged.where("known").drop("known"), tagged.where("NOT known").drop("known")


def with_known_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with a flag telling whether both ends exist."""
    tasks = task_count(edges, nodes)
    ids = nodes.select("id").repartition(tasks, "id").distinct()
    rows = edges
    for end in ("src", "dst"):
        rows = rows.repartition(tasks, end).join(ids.select(F.col("id").alias(end), F.lit(True).alias(f"__{end}")), end, "left")
    known = F.col("__src").isNotNull() & F.col("__dst").isNotNull()
    return rows.select(*edges.columns, known.alias("known"))


# ---------------------------------------------------------------- scans


def nodes_by_label(nodes: DataFrame, labels: Sequence[str], columns: Sequence[str | Column] = ("id", "label", "name")) -> DataFrame:
    return nodes.where(F.col("label").isin(*labels)).select(*columns)


def edges_with_ends(edges: DataFrame, nodes: DataFrame, exclude: str = STRUCTURAL_EDGE) -> DataFrame:
    """Edges with the names of both ends; the structural type is left out."""
    rows = edges.where(F.col("type") != exclude)
    for end in ("src", "dst"):
        side = nodes.select(F.col("id").alias(end), F.col("name").alias(f"{end}_name"), F.col("label").alias(f"{end}_label"))
        rows = rows.join(side, end)
    return rows


def node_lookup(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    return nodes.join(ids.select("id").distinct(), "id", "left_semi")


def node_search(nodes: DataFrame, text: str, label: str | None = None, limit: int | None = 20) -> DataFrame:
    """Nodes whose name contains ``text``, ordered by id."""
    rows = nodes.where(contains_any("name", [text]))
    if label:
        rows = rows.where(F.col("label") == label)
    return rows if limit is None else rows.orderBy("id").limit(limit)


def property_keys(nodes: DataFrame) -> DataFrame:
    """Sorted property names of every vertex."""
    return nodes.select("id", F.array_sort(F.map_keys("props")).alias("keys"))


def connected(edges: DataFrame, nodes: DataFrame, edge_type: str, targets: DataFrame) -> DataFrame:
    """Source nodes of ``edge_type`` edges into the target ids."""
    hit = edges.where(F.col("type") == edge_type).join(targets.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")
    return nodes.join(hit.select(F.col("src").alias("id"), "dst").distinct(), "id")


def node_enrich(nodes: DataFrame, datasets: DataFrame, terms: DataFrame, source: str = "data_source") -> DataFrame:
    """Nodes with the dataset and the standard term named by their unquoted data source.

    ``datasets(name, dataset_description, table_type)``, ``terms(physical_name, term_name)``.
    """
    key = F.trim(F.col(source), F.lit('"'))
    keyed = nodes.withColumn("__key", key)
    found = datasets.select(F.col("name").alias("__key"), "dataset_description", "table_type")
    named = terms.select(F.col("physical_name").alias("__key"), "term_name")
    return keyed.join(found, "__key", "left").join(named, "__key", "left").drop("__key")


# ---------------------------------------------------------------- counts and reports


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes per label and edges per type, each with its total row."""

    def counted(df: DataFrame, kind: str, column: str) -> DataFrame:
        rolled = df.rollup(column).agg(F.count(F.lit(1)).alias("row_count"), F.grouping(column).alias("g"))
        key = F.when(F.col("g") == 1, F.lit("*")).otherwise(F.col(column))
        return rolled.select(F.lit(kind).alias("kind"), key.alias("key"), "row_count")

    return counted(nodes, "node", "label").unionByName(counted(edges, "edge", "type"))


def schema_report(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Label combinations, single labels and edge types with counts; ``nodes`` carries ``labels``."""
    combos = nodes.groupBy(F.array_join("labels", "+").alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    labels = nodes.select(F.explode("labels").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("row_count"))
    types = edges.groupBy(F.col("type").alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    parts = [("combination", combos), ("label", labels), ("type", types)]
    out = None
    for kind, df in parts:
        rows = df.select(F.lit(kind).alias("kind"), "key", "row_count")
        out = rows if out is None else out.unionByName(rows)
    return out


def chain_counts(edges: DataFrame, chains: Sequence[Sequence[str]]) -> DataFrame:
    """Number of paths along each type chain, no edge used twice.

    Paths are never built: the number of chain continuations per node is
    aggregated from the far end.  A two-edge chain of one type may not reuse a
    self loop, which is taken off.
    """
    out = None
    for chain in chains:
        if len(chain) > 2:
            raise ValueError("chains have one or two edge types")
        last = edges.where(F.col("type") == chain[-1])
        if len(chain) == 1:
            total = last.agg(F.count(F.lit(1)).alias("paths"))
        else:
            onward = last.groupBy(F.col("src").alias("mid")).agg(F.count(F.lit(1)).alias("n_out"))
            first = edges.where(F.col("type") == chain[0])
            inward = first.groupBy(F.col("dst").alias("mid")).agg(
                F.count(F.lit(1)).alias("n_in"),
                F.count_if((F.col("src") == F.col("dst")) & F.lit(chain[0] == chain[1])).alias("loops"),
            )
            product = F.col("n_in") * F.col("n_out") - F.col("loops")
            total = inward.join(onward, "mid").agg(F.coalesce(F.sum(product), F.lit(0)).alias("paths"))
        rows = total.select(F.lit("-".join(chain)).alias("chain"), "paths")
        out = rows if out is None else out.unionByName(rows)
    return out


def schema_node_counts(schemas: DataFrame, edges: DataFrame, edge_type: str = STRUCTURAL_EDGE) -> DataFrame:
    """Schemas with the number of nodes they own and a flag for a stored document."""
    counted = edges.where(F.col("type") == edge_type).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("node_count"))
    rows = schemas.join(counted, "id", "left")
    return rows.select(
        *[c for c in schemas.columns if c != "document"],
        F.coalesce("node_count", F.lit(0)).alias("node_count"),
        (F.length("document") > 0).alias("has_json"),
    ).withColumn("has_json", F.coalesce("has_json", F.lit(False)))


# ---------------------------------------------------------------- documents and entities


def scenario_list(scenarios: DataFrame, links: DataFrame | None = None, json_columns: Sequence[str] = ()) -> DataFrame:
    """Scenarios of the linked schemas with their JSON columns decoded, ``[]`` when malformed."""
    rows = scenarios if links is None else scenarios.join(links, "scenario_id")
    return rows.select(*[json_or_empty(c).alias(c) if c in json_columns else F.col(c) for c in rows.columns])


LINK_PROPERTIES = ("lag", "featureName", "importance", "correlationScore")


def model_dag(models: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Models with their read fields and predicted fields nested; models without links keep empty arrays.

    ``models(model_id, ..)``; ``edges`` of type ``READS_FIELD`` point at models,
    ``PREDICTS_FIELD`` away from them, with a ``field`` column; the link properties that
    the edges have (lag, feature name, importance, correlation) go with each field.
    """
    names = nodes.select(F.col("id").alias("node_id"), F.col("name").alias("node_name"))
    carried = ["field", *[c for c in LINK_PROPERTIES if c in edges.columns]]
    reads = edges.where(F.col("type") == "READS_FIELD").select(F.col("dst").alias("model_id"), F.col("src").alias("node_id"), *carried)
    predicts = edges.where(F.col("type") == "PREDICTS_FIELD").select(F.col("src").alias("model_id"), F.col("dst").alias("node_id"), *carried)
    nested = {}
    for name, part in (("inputs", reads), ("outputs", predicts)):
        nested[name] = nest(part.join(names, "node_id"), ["model_id"], ["node_id", "node_name", *carried], name)
    return attach(models, nested, ["model_id"])


def field_links(links: DataFrame) -> DataFrame:
    """Model field links with their number defaults; a given zero stays a zero."""
    reads = F.col("linkType") == "READS_FIELD"
    known = links.where(F.col("linkType").isin("READS_FIELD", "PREDICTS_FIELD"))
    numbers = [F.coalesce(c, F.lit(d)).alias(c) for c, d in LINK_DEFAULTS.items() if c in links.columns]
    rest = [c for c in links.columns if c not in LINK_DEFAULTS and c != "featureName"]
    feature = F.when(reads, F.coalesce("featureName", "field")).alias("featureName")
    return known.select(*rest, feature, *numbers)


def _exported(rows: DataFrame, ids: Sequence[str]) -> Column:
    """All other columns of a row as a VARIANT object, without vectors.

    Only arrays and variants can be as long as a vector, so only rows with such a value
    are taken apart; the types of the others tell that nothing is left out.
    """
    names = [c for c in rows.columns if c not in ids and c.lower() not in VECTOR_KEYS]
    whole = F.to_variant_object(F.struct(*names))
    lists = [c for c in names if rows.schema[c].dataType.typeName() in ("array", "variant")]
    if not lists:
        return whole
    sizes = [F.size(c) if rows.schema[c].dataType.typeName() == "array" else F.json_array_length(F.to_json(c)) for c in lists]
    longest = F.greatest(F.lit(0), *[F.coalesce(n, F.lit(0)) for n in sizes])
    return F.when(longest < VECTOR_LENGTH, whole).otherwise(typed_without_vectors(whole))


def graph_export(tables: DataFrame, columns: DataFrame, relationships: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole catalog as graph rows ``(nodes, relationships)`` with generated ids.

    ``relationships(rel_id, from_table_id, to_table_id, rel_type, source_column, target_column)``.
    Properties are VARIANT objects with all other columns of a row, but for vectors.
    """
    table_nodes = tables.select(
        F.col("table_id").cast("string").alias("node_id"),
        F.lit("Analyzer_Table").alias("label"),
        _exported(tables, ["table_id"]).alias("properties"),
    )
    column_nodes = columns.select(
        F.concat(F.lit("col:"), F.col("column_id").cast("string")).alias("node_id"),
        F.lit("Analyzer_Column").alias("label"),
        _exported(columns, ["column_id", "table_id"]).alias("properties"),
    )
    tid, cid = F.col("table_id").cast("string"), F.col("column_id").cast("string")
    owns = columns.where(F.col("table_id").isNotNull()).select(
        F.concat(F.lit("hc:"), tid, F.lit(":"), cid).alias("relationship_id"),
        F.lit("HAS_COLUMN").alias("type"),
        tid.alias("start_id"),
        F.concat(F.lit("col:"), cid).alias("end_id"),
        F.parse_json(F.lit("{}")).alias("properties"),
    )
    related = relationships.select(
        F.concat(F.lit("rel:"), F.col("rel_id").cast("string")).alias("relationship_id"),
        F.col("rel_type").alias("type"),
        F.col("from_table_id").cast("string").alias("start_id"),
        F.col("to_table_id").cast("string").alias("end_id"),
        F.to_variant_object(F.struct(F.col("source_column").alias("sourceColumn"), F.col("target_column").alias("targetColumn"))).alias("properties"),
    )
    return table_nodes.unionByName(column_nodes), owns.unionByName(related)


def graph_entities(records: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Result rows split into distinct nodes and distinct relationships, the first row per id wins.

    ``records(node_id, id, labels, rel_id, rel_type, start_id, end_id)``.  The rows of an id
    meet in one task, where they are sorted, on disk if they are very many.
    """
    tasks = task_count(records)
    node_id = F.coalesce("node_id", "id").cast("string")
    nodes = records.select(node_id.alias("entity_id"), F.coalesce("labels", F.lit("")).alias("labels"), *order)
    rels = records.select(
        F.col("rel_id").cast("string").alias("relationship_id"),
        F.coalesce("rel_type", F.lit("")).alias("type"),
        F.coalesce("start_id", F.lit("")).alias("start_id"),
        F.coalesce("end_id", F.lit("")).alias("end_id"),
        *order,
    )
    named = nodes.where(F.col("entity_id").isNotNull()).repartition(tasks, "entity_id")
    linked = rels.where(F.col("relationship_id").isNotNull()).repartition(tasks, "relationship_id")
    first_nodes = first_per_key(named, ["entity_id"], order)
    first_rels = first_per_key(linked, ["relationship_id"], order)
    return first_nodes.drop(*order), first_rels.drop(*order)


# ---------------------------------------------------------------- writes


def merge_nodes(nodes: DataFrame, changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Match-or-create by id: properties merge shallowly, label and name follow the last change."""
    policies = {c: M.map_merge() if c == "props" else M.incoming() for c in nodes.columns if c != "id"}
    return M.merge_upsert(nodes, changes, ["id"], policies, order_by)


def update_node_props(nodes: DataFrame, changes: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Property updates of known nodes; unknown ids are ignored."""
    return M.merge_upsert(nodes, changes, ["id"], {"props": M.map_merge()}, order_by, insert=False)


def replace_schema(
    nodes: DataFrame, edges: DataFrame, fresh_nodes: DataFrame, fresh_edges: DataFrame, scope: str = "schema_id"
) -> tuple[DataFrame, DataFrame]:
    """Replace the nodes and edges of every schema in ``fresh_nodes``.

    A layer outside the vocabulary becomes the type label; fresh edges need both
    ends among the fresh nodes of their schema; old edges that touch a removed
    node go with it.
    """
    label = F.when(F.col("label").isin(*LAYERS), F.col("label")).otherwise(TYPE_LABEL)
    fresh = fresh_nodes.withColumn("label", label).select(*nodes.columns)
    cleared = fresh.select(scope).distinct().withColumn("__hit", F.lit(True))
    hit = F.col("__hit").isNotNull()
    tagged = (
        nodes.join(cleared, scope, "left")
        .select(*nodes.columns, hit.alias("__removed"), F.lit(False).alias("__fresh"))
        .unionByName(fresh.withColumns({"__removed": F.lit(False), "__fresh": F.lit(True)}))
    )
    # an id with the schemas in which it is fresh, and whether it was removed anywhere
    ends = (
        tagged.where("__removed OR __fresh")
        .groupBy("id")
        .agg(F.max("__removed").alias("removed"), F.collect_set(F.when(F.col("__fresh"), F.col(scope))).alias("scopes"))
    )
    links = edges.withColumn("__new", F.lit(False)).unionByName(fresh_edges.select(*edges.columns).withColumn("__new", F.lit(True)))
    links = links.join(cleared, scope, "left").withColumn("__old", hit).drop("__hit")
    inside, touched = F.col("__new"), F.col("__old")
    for end in ("src", "dst"):
        links = links.join(ends.select(F.col("id").alias(end), F.struct("removed", "scopes").alias(f"__{end}")), end, "left")
        inside = inside & F.array_contains(F.col(f"__{end}.scopes"), F.col(scope))
        touched = touched | F.coalesce(F.col(f"__{end}.removed"), F.lit(False))
    kept = F.when(F.col("__new"), F.coalesce(inside, F.lit(False))).otherwise(~touched)
    return tagged.where("NOT __removed").select(*nodes.columns), links.where(kept).select(*edges.columns)


def detach_delete(nodes: DataFrame, edges: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete nodes by id together with their incident edges."""
    ids = doomed.select("id").distinct()
    left = edges
    for end in ("src", "dst"):
        left = left.join(ids.withColumnRenamed("id", end), end, "left_anti")
    return nodes.join(ids, "id", "left_anti"), left
