"""Foreign-key joins over the catalog.

``fks(from_column_id, to_column_id, constraint_name)`` point at ``columns``.
Every OR over the two ends of a key is written as two directions of one row,
so all joins are equi-joins that adaptive execution can broadcast or split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.keys import joined, node_key
from catalith.functions.text import blank, display_name, is_valid
from catalith.plans.lineage_cut import stored
from catalith.plans.nesting import nest
from catalith.plans.ranking import top_per_group
from catalith.plans.sizing import task_count

# Fixed values.
RELATION_TYPES = ("FK_TO_TABLE", "ONE_TO_ONE", "ONE_TO_MANY", "MANY_TO_ONE", "MANY_TO_MANY")
FK_PATH = "HAS_COLUMN → FK_TO → HAS_COLUMN"
PATH_RANKS = {FK_PATH: 100}
DEFAULT_PATH_RANK = 1
PATH_LABELS = {FK_PATH: "외래키 관계"}
NO_DESCRIPTION = "설명 없음"
FIXED_RELATED_SCORE = 0.97
SCORE_BASE, SCORE_STEP, SCORE_CAP = 0.9, 0.02, 0.09
FK_PATH_LIMIT, FK_DETAIL_LIMIT, NEIGHBOR_LIMIT, RELATED_LIMIT = 20, 30, 100, 5


def fk_edges(tables: DataFrame, columns: DataFrame, fks: DataFrame, valid_only: bool = False) -> DataFrame:
    """One row per FK column pair with both columns and both tables resolved."""
    cols = columns.where(is_valid("is_valid")) if valid_only else columns
    tabs = tables.where(is_valid("is_valid")) if valid_only else tables
    named = cols.select(
        "column_id", "table_id", F.col("name").alias("column"), F.col("description").alias("column_description")
    )
    shown = tabs.select(
        "table_id",
        "schema_name",
        "db",
        "name",
        display_name().alias("table"),
        F.col("description").alias("description"),
    )
    full = named.join(shown, "table_id")

    def side(prefix: str) -> DataFrame:
        return full.select(*[F.col(c).alias(f"{prefix}_{c}") for c in full.columns])

    return (
        fks.select("from_column_id", "to_column_id", "constraint_name")
        .join(side("from"), "from_column_id")
        .join(side("to"), "to_column_id")
    )


ENDS = ("table_id", "schema_name", "db", "name", "table", "description", "column_id", "column", "column_description")


def edges_once(edges: DataFrame, ends: Sequence[str]) -> DataFrame:
    """The edges with these columns of both ends, stored: their joins run once for all uses."""
    return stored(edges.select(*[f"{side}_{c}" for side in ("from", "to") for c in ends]), "fk-edges")


def oriented(edges: DataFrame) -> DataFrame:
    """Every edge twice, seen from its seed table: outgoing first, then incoming."""
    ends = [c for c in ENDS if f"from_{c}" in edges.columns]
    names = [c for c in ("constraint_name",) if c in edges.columns]

    def seen(seed: str, other: str, priority: int) -> Column:
        return F.struct(
            *[F.col(f"{seed}_{c}").alias(f"seed_{c}") for c in ends],
            *[F.col(f"{other}_{c}").alias(f"other_{c}") for c in ends],
            *[F.col(c).alias(c) for c in names],
            F.lit(priority).alias("priority"),
        )

    # both directions from one row: the joins behind the edges run once
    return edges.select(F.explode(F.array(seen("from", "to", 0), seen("to", "from", 1))).alias("e")).select("e.*")


def within(edges: DataFrame, members: DataFrame, request: str = "request_id") -> DataFrame:
    """Edges with both ends in the table set of a request; ``members(request_id, table_id)``."""
    sets = members.select(request, "table_id").distinct()
    left = edges.join(sets.withColumnRenamed("table_id", "from_table_id"), "from_table_id")
    return left.join(sets.withColumnRenamed("table_id", "to_table_id"), [request, "to_table_id"], "left_semi")


def fk_paths(edges: DataFrame, members: DataFrame, limit: int = FK_PATH_LIMIT, max_hops: int = 1) -> DataFrame:
    """FK paths between different tables of a request's set, shortest first, at most ``limit`` per request."""
    direct = within(edges, members).where(F.col("from_table_id") != F.col("to_table_id"))
    hops = direct.select("request_id", "from_table_id", "to_table_id").distinct()
    known = hops.withColumn("best", F.struct(F.lit(1).alias("hops"), F.array("from_table_id", "to_table_id").alias("path")))
    step = hops.select(F.col("request_id").alias("__request"), F.col("from_table_id").alias("__at"), F.col("to_table_id").alias("next_id"))
    pair = ["request_id", "from_table_id", "to_table_id"]
    for depth in range(2, max_hops + 1):
        # a pair stays and is carried one key further; the best of a pair is kept, so pairs are derived once a hop
        last = (F.col("best.hops") == depth - 1) & (F.col("request_id") == F.col("__request")) & (F.col("to_table_id") == F.col("__at"))
        own = F.struct("to_table_id", "best")
        path = F.array_append("best.path", F.col("next_id"))
        further = F.struct(F.col("next_id").alias("to_table_id"), F.struct(F.lit(depth).alias("hops"), path.alias("path")).alias("best"))
        again = F.col("next_id").isNull() | F.array_contains("best.path", F.col("next_id"))
        grown = known.join(step, last, "left").select("request_id", "from_table_id", F.explode(F.when(again, F.array(own)).otherwise(F.array(own, further))).alias("e"))
        known = grown.select("request_id", "from_table_id", "e.*").groupBy(*pair).agg(F.min("best").alias("best"))
    known = known.select(*pair, "best.hops", "best.path")
    order = [F.col("hops"), F.col("from_table_id"), F.col("to_table_id")]
    return top_per_group(known, ["request_id"], order, limit)


def fk_details(edges: DataFrame, members: DataFrame, limit: int | None = FK_DETAIL_LIMIT) -> DataFrame:
    """FK column pairs inside each request's table set, ordered, at most ``limit`` per request."""
    order = ["from_schema_name", "from_table", "to_schema_name", "to_table", "from_column", "to_column"]
    wanted = ["request_id", *order, "constraint_name", "from_column_id", "to_column_id"]
    rows = within(edges, members).select(*wanted)
    if limit is None:
        return rows
    total = [F.col(c).asc_nulls_last() for c in [*order, "from_column_id", "to_column_id"]]
    return top_per_group(rows, ["request_id"], total, limit)


def fk_relations(edges: DataFrame, limit: int, seeds: DataFrame | None = None) -> DataFrame:
    """Relations of every seed: outgoing keys first, incoming ones fill the rest up to ``limit``."""
    seen = oriented(edges)
    if seeds is not None:
        seen = seen.join(seeds.select(F.col("table_id").alias("seed_table_id")).distinct(), "seed_table_id", "left_semi")
    rows = seen.select(
        "seed_table_id",
        F.col("other_table_id").alias("related_table_id"),
        F.col("other_schema_name").alias("related_schema"),
        F.col("other_table").alias("related_table"),
        F.when(F.col("priority") == 0, "foreign_key").otherwise("referenced_by").alias("relation_type"),
        F.col("seed_column").alias("from_column"),
        F.col("other_column").alias("to_column"),
        F.col("other_description").alias("related_description"),
        "priority",
    ).distinct()
    order = ["priority", "related_table", "from_column", "to_column", "related_table_id"]
    return top_per_group(rows, ["seed_table_id"], [F.col(c) for c in order], limit).drop("priority")


def sorted_relations(relations: DataFrame) -> DataFrame:
    """Presentation order of ``fk_relations``; NULL sorts as blank."""
    keys = ["related_schema", "related_table", "from_column", "to_column", "relation_type"]
    return relations.orderBy("seed_table_id", *[blank(k) for k in keys])


def neighbors_any(edges: DataFrame, limit: int | None = NEIGHBOR_LIMIT) -> DataFrame:
    """Distinct neighbours of every table whatever the key direction, without itself; at most ``limit`` by name."""
    rows = (
        oriented(edges)
        .where(F.col("seed_table_id") != F.col("other_table_id"))
        .select(
            "seed_table_id",
            F.col("other_table_id").alias("related_table_id"),
            F.col("other_schema_name").alias("related_schema"),
            F.col("other_table").alias("related_table"),
            F.coalesce("other_description", F.lit(NO_DESCRIPTION)).alias("related_description"),
        )
        .distinct()
    )
    return rows if limit is None else top_per_group(rows, ["seed_table_id"], [F.col("related_table"), F.col("related_table_id")], limit)


def neighbors_out(edges: DataFrame, tables: DataFrame, seeds: DataFrame, limit: int) -> DataFrame:
    """Valid tables one outgoing key away from a request's seeds; ``seeds(request_id, table_id)``."""
    asked = seeds.select("request_id", F.col("table_id").alias("from_table_id")).distinct()
    ids = edges.select("from_table_id", "to_table_id").distinct().join(asked, "from_table_id")
    targets = ids.select("request_id", F.col("to_table_id").alias("table_id")).distinct()
    valid = tables.where(is_valid("is_valid")).select(
        "table_id",
        blank("schema_name").alias("schema_name"),
        blank("name").alias("name"),
        blank("description").alias("description"),
    )
    rows = targets.join(valid, "table_id")
    return top_per_group(rows, ["request_id"], [F.col("schema_name"), F.col("name"), F.col("table_id")], limit)


def column_fk(edges: DataFrame, limit: int) -> DataFrame:
    """Referenced columns of every column that is the source of a key."""
    rows = edges.select(
        "from_column_id",
        F.col("to_table").alias("referenced_table"),
        F.col("to_schema_name").alias("referenced_schema"),
        F.col("to_column").alias("referenced_column"),
        "constraint_name",
        "to_column_id",
    )
    order = [F.col("referenced_table"), F.col("referenced_column"), F.col("to_column_id")]
    return top_per_group(rows, ["from_column_id"], order, limit).drop("to_column_id")


def relation_details(edges: DataFrame, limit: int) -> DataFrame:
    """FK relations plus neighbours not among them, scored by path rank, filling up to ``limit``."""
    edges = edges_once(edges, ["table_id", "schema_name", "table", "description", "column"])
    relations = stored(fk_relations(edges, limit), "fk-relations")
    taken = relations.groupBy("seed_table_id").agg(F.count(F.lit(1)).alias("taken"))
    known = relations.select("seed_table_id", "related_schema", "related_table").distinct()
    rank = F.lit(PATH_RANKS.get(FK_PATH, DEFAULT_PATH_RANK))
    extra = (
        neighbors_any(edges, limit=None)
        .join(known, ["seed_table_id", "related_schema", "related_table"], "left_anti")
        .withColumn("score", rank)
        .withColumn("relation_type", F.lit(PATH_LABELS.get(FK_PATH)))
    )
    window = Window.partitionBy("seed_table_id").orderBy(
        F.col("score").desc(), F.col("related_table"), F.col("related_table_id")
    )
    placed = extra.withColumn("place", F.row_number().over(window)).where(F.col("place") <= limit)
    filled = placed.join(taken, "seed_table_id", "left").where(
        F.col("place") <= F.lit(limit) - F.coalesce("taken", F.lit(0))
    )
    shared = ["seed_table_id", "related_schema", "related_table", "relation_type"]
    fk_part = relations.select(
        *shared, "from_column", "to_column", F.lit(None).cast("int").alias("score"), F.lit("fk").alias("part")
    )
    extra_part = filled.select(
        *shared,
        F.lit(None).cast("string").alias("from_column"),
        F.lit(None).cast("string").alias("to_column"),
        "score",
        F.lit("additional").alias("part"),
    )
    return fk_part.unionByName(extra_part)


def related_tables(
    edges: DataFrame,
    limit: int = RELATED_LIMIT,
    loaded: DataFrame | None = None,
    mode: str = "robo",
    scored: bool = False,
    datasource: str | None = None,
    lists: bool = False,
) -> DataFrame:
    """Related tables of every seed with orientation, key count and score.

    Outgoing keys decide the orientation when both directions exist.  Tables in
    ``loaded(seed_table_id, related_table_id)`` are left out before the limit and
    counted in ``excluded``.  ``lists`` adds the sorted columns on both sides and the data
    source of the related table; a list is at most as long as a table is wide.
    """
    seen = oriented(edges)
    if datasource is not None:
        seen = seen.where((F.col("seed_db") == datasource) & (F.col("other_db") == datasource))
    source_column = F.when(F.col("priority") == 0, F.col("seed_column")).otherwise(F.col("other_column"))
    target_column = F.when(F.col("priority") == 0, F.col("other_column")).otherwise(F.col("seed_column"))
    # A key from a table to itself is one key seen from one seed.
    once = seen.where((F.col("seed_table_id") != F.col("other_table_id")) | (F.col("priority") == 0))
    # Sets of one pair's columns, which are no more than a table is wide: one pass, no row is expanded.
    sides = [F.collect_set(f"{s}_column") for s in ("source", "target")]
    grouped = (
        once.withColumn("source_column", source_column)
        .withColumn("target_column", target_column)
        .groupBy("seed_table_id", F.col("other_table_id").alias("related_table_id"))
        .agg(
            F.min("priority").alias("priority"),
            F.first("other_name").alias("related_table"),
            F.first("other_schema_name").alias("related_schema"),
            F.first("other_db").alias("related_db"),
            F.greatest(*[F.size(s) for s in sides]).cast("long").alias("fk_count"),
            *[F.array_sort(s).alias(f"{n}_columns") for n, s in zip(("source", "target"), sides) if lists],
        )
    )
    if scored:
        raw = F.lit(SCORE_BASE) + F.least(F.col("fk_count") * SCORE_STEP, F.lit(SCORE_CAP))
        score = F.round(raw, 2)
    else:
        score = F.lit(FIXED_RELATED_SCORE)
    source = F.col("related_db") if scored else F.lit("")
    shown = grouped.select(
        "seed_table_id",
        "related_table_id",
        "related_table",
        F.coalesce("related_schema", F.lit("public")).alias("related_schema"),
        node_key(mode, source, F.col("related_schema"), F.col("related_table")).alias("node_key"),
        F.when(F.col("priority") == 0, "FK_OUT").otherwise("FK_IN").alias("relation_type"),
        score.alias("score"),
        "fk_count",
        *["source_columns", "target_columns", blank("related_db").alias("datasource")] * lists,
    )
    if loaded is not None:
        pairs = loaded.select("seed_table_id", "related_table_id").distinct().withColumn("there", F.lit(1))
        marked = stored(shown.join(pairs, ["seed_table_id", "related_table_id"], "left"), "related")
        counts = marked.groupBy("seed_table_id").agg(F.count("there").alias("excluded"))
        left_over = marked.where(F.col("there").isNull()).drop("there")
        shown = left_over.join(counts, "seed_table_id").select(*shown.columns, "excluded")
    order = [F.col("score").desc(), F.col("related_table_id").asc()]
    top = top_per_group(shown, ["seed_table_id"], order, limit)
    return top if loaded is not None else top.withColumn("excluded", F.lit(0))


def related_pairs(edges: DataFrame) -> DataFrame:
    """Column pairs of every (from table, to table), nested in order."""
    item = [F.col("from_column").alias("source"), F.col("to_column").alias("target")]
    return nest(edges, ["from_name", "to_name"], item, "column_pairs")


def join_hints(details: DataFrame) -> DataFrame:
    """``JOIN ..`` text of every FK pair; tables are shown with their schema."""
    from_table = joined("from_schema_name", "from_table")
    to_table = joined("to_schema_name", "to_table")
    hint = F.format_string("JOIN %s ON %s.%s = %s.%s", to_table, from_table, F.col("from_column"), to_table, F.col("to_column"))
    return details.withColumn("hint", hint)


def co_referenced(refs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Tables used under the same procedure as a seed table.

    ``refs(proc, table_id)``.  References and (seed, procedure) pairs are made
    distinct before they meet, and only procedures of the seeds take part.
    """
    once = refs.select("proc", "table_id").distinct()
    wanted = seeds.select(F.col("table_id").alias("seed_table_id")).distinct()
    procs = once.join(wanted, once["table_id"] == wanted["seed_table_id"]).select("seed_table_id", "proc")
    pairs = procs.join(once, "proc").where(F.col("seed_table_id") != F.col("table_id"))
    return pairs.select("seed_table_id", F.col("table_id").alias("related_table_id")).distinct()


def table_references(refs: DataFrame, statements: DataFrame, procedures: DataFrame, tables: DataFrame) -> DataFrame:
    """Where every table is used: its statement and, if known, the enclosing procedure.

    ``refs(statement_id, table_id, ref_type)``, ``statements(statement_id, proc_id,
    statement_type, start_line)``, ``procedures(proc_id, procedure_name, procedure_type)``.
    """
    tasks = task_count(refs, statements)
    named = tables.select("table_id", F.col("name").alias("table_name"))
    used = refs.join(named, "table_id").select("statement_id", "table_name", "ref_type").repartition(tasks, "statement_id")
    rows = used.join(statements.repartition(tasks, "statement_id"), "statement_id").join(procedures, "proc_id", "left")
    shown = ["table_name", "procedure_name", "procedure_type", "start_line", F.col("ref_type").alias("access_type"), "statement_type"]
    return rows.select(*shown).repartition(tasks, "table_name", "procedure_name", "start_line").distinct()


def schema_relationships(relationships: DataFrame, tables: DataFrame) -> DataFrame:
    """Listed relationships of the allowed types with both table names.

    ``relationships(from_table_id, to_table_id, rel_type, source_column, target_column)``.
    """
    names = tables.select("table_id", "name", "schema_name")

    def side(prefix: str) -> DataFrame:
        return names.select(
            F.col("table_id").alias(f"{prefix}_table_id"),
            F.col("name").alias(f"{prefix}_table"),
            F.col("schema_name").alias(f"{prefix}_schema"),
        )

    allowed = relationships.where(F.col("rel_type").isin(*RELATION_TYPES))
    rows = allowed.join(side("from"), "from_table_id").join(side("to"), "to_table_id")
    return rows.select(
        "from_schema", "from_table", "source_column", "to_schema", "to_table", "target_column", "rel_type"
    ).orderBy("from_table", "to_table", "source_column", "target_column")


def existing_fk_set(edges: DataFrame) -> DataFrame:
    """Distinct ``(from, to)`` table and column names, blank for NULL."""
    return edges.select(
        F.concat("from_schema_name", F.lit("."), "from_name").alias("f"),
        F.concat("to_schema_name", F.lit("."), "to_name").alias("t"),
        blank("from_column").alias("from_column"),
        blank("to_column").alias("to_column"),
    ).select(blank("f").alias("from_table"), blank("t").alias("to_table"), "from_column", "to_column").distinct()


def fk_in_scope(fks: DataFrame, tables: DataFrame) -> DataFrame:
    """Keys inside one schema whose two tables are in the snapshot.

    ``fks(from_schema, from_table, from_column, to_schema, to_table, to_column)``,
    ``tables(schema_name, name)``.
    """
    known = tables.select("schema_name", "name").distinct()
    same = fks.where(F.col("from_schema") == F.col("to_schema"))
    for end in ("from", "to"):
        side = known.select(F.col("schema_name").alias(f"{end}_schema"), F.col("name").alias(f"{end}_table"))
        same = same.join(side, [f"{end}_schema", f"{end}_table"], "left_semi")
    return same


def table_importance(tables: DataFrame, columns: DataFrame, fks: DataFrame) -> DataFrame:
    """Number of FK rows touching every table; a key with both ends on one column counts once."""
    ends = fks.select(F.explode(F.array_distinct(F.array("from_column_id", "to_column_id"))).alias("column_id"))
    per_column = ends.groupBy("column_id").agg(F.count(F.lit(1)).alias("n"))
    counted = (
        columns.select("column_id", "table_id")
        .join(per_column, "column_id")
        .groupBy("table_id")
        .agg(F.sum("n").alias("importance"))
    )
    rows = tables.select("table_id", "schema_name", "name", "description").join(counted, "table_id", "left")
    return rows.withColumn("importance", F.coalesce("importance", F.lit(0)))
