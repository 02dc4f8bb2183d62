"""Bindings of the catalog lookups and foreign-key joins (families B and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query
from bindings.views import Bound, duck
from catalith.functions.text import is_valid
from catalith.operators import catalog, fk

CAT = ("V_tab", "V_col", "V_fk")
EDGES = """, E AS (SELECT f.constraint_name,
c1.column_id AS from_column_id, c1.table_id AS from_table_id, c1.name AS from_column, t1.name AS from_name, coalesce(t1.original_name, t1.name) AS from_table, t1.schema_name AS from_schema, t1.db AS from_db, t1.description AS from_description,
c2.column_id AS to_column_id, c2.table_id AS to_table_id, c2.name AS to_column, t2.name AS to_name, coalesce(t2.original_name, t2.name) AS to_table, t2.schema_name AS to_schema, t2.db AS to_db, t2.description AS to_description,
coalesce(t1.is_valid, true) AND coalesce(t2.is_valid, true) AND coalesce(c1.is_valid, true) AND coalesce(c2.is_valid, true) AS all_valid
FROM V_fk f JOIN V_col c1 ON c1.column_id = f.from_column_id JOIN V_col c2 ON c2.column_id = f.to_column_id
JOIN V_tab t1 ON t1.table_id = c1.table_id JOIN V_tab t2 ON t2.table_id = c2.table_id) """
SEEN = """, O AS (
SELECT from_table_id AS seed, to_table_id AS other, to_schema AS other_schema, to_table AS other_table, to_name AS other_name, to_db AS other_db, from_db AS seed_db, to_description AS other_description, from_column AS seed_column, to_column AS other_column, from_column AS source_column, to_column AS target_column, 0 AS priority FROM E
UNION ALL SELECT to_table_id, from_table_id, from_schema, from_table, from_name, from_db, to_db, from_description, to_column, from_column, from_column, to_column, 1 FROM E) """
FILL = """, R AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY priority, other_table, seed_column, other_column, other) AS rn
FROM (SELECT DISTINCT seed, other, other_schema, other_table, other_description, seed_column, other_column, priority FROM O) AS d) AS x WHERE rn <= 5) """
ANY = """, N AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY other_table, other) AS rn
FROM (SELECT DISTINCT seed, other, other_schema, other_table, coalesce(other_description, '설명 없음') AS other_description FROM O WHERE seed <> other) AS d) AS x WHERE rn <= 100) """


def edges(b: Bound, valid_only: bool = False):
    return fk.fk_edges(b.V_tab, b.V_col, b.V_fk, valid_only)


def members(b: Bound):
    return b.V_tab.select(F.col("db").alias("request_id"), "table_id")


def lineage_names(b: Bound):
    return b.V_lin.where("side = 'SOURCE'").select(F.concat(F.lit(" \t"), F.upper("tbl"), F.lit("\n")).alias("name"))


# ---------------------------------------------------------------- filters


@query(
    "tables_by_names",
    duck("V_tab", "V_lin")
    + """SELECT table_id, coalesce(schema_name, '') AS schema_name, coalesce(name, '') AS name, coalesce(description, '') AS description FROM V_tab
WHERE coalesce(is_valid, true) AND lower(name) IN (SELECT lower(tbl) FROM V_lin WHERE side = 'SOURCE')""",
)
def tables_by_names(b: Bound):
    return catalog.tables_by_names(b.V_tab, lineage_names(b))


@query(
    "embedding_texts",
    duck("V_tab", "V_lin")
    + """SELECT lower(CASE WHEN schema_name <> '' THEN concat(schema_name, '.', name) ELSE name END) AS fqn, description AS text FROM V_tab
WHERE description <> '' AND lower(name) IN (SELECT lower(tbl) FROM V_lin WHERE side = 'SOURCE')""",
)
def embedding_texts(b: Bound):
    return catalog.embedding_texts(b.V_tab, lineage_names(b), "description")


@query(
    "columns_for_keys",
    duck("V_tab", "V_col")
    + """SELECT t.table_id, t.db, t.schema_name, t.name AS table_name, c.name AS column_name, c.dtype, c.nullable FROM V_tab t JOIN V_col c ON c.table_id = t.table_id
WHERE EXISTS (SELECT 1 FROM V_tab k WHERE k.db = t.db AND k.schema_name = t.schema_name AND k.name = t.name AND k.original_name IS NOT NULL)""",
)
def columns_for_keys(b: Bound):
    keys = b.V_tab.where("original_name IS NOT NULL").select("db", "schema_name", "name")
    return catalog.columns_for_keys(b.V_tab, b.V_col, keys)


@query(
    "match_alias",
    duck("V_tab")
    + """, w AS (SELECT DISTINCT lower(n) AS key FROM (SELECT concat('T', CAST(l_partkey AS VARCHAR), '_orig') AS n FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT concat('t', CAST(l_partkey AS VARCHAR)) FROM lineitem WHERE l_returnflag = 'N') AS x)
SELECT DISTINCT w.key, t.table_id FROM w JOIN V_tab t ON lower(t.name) = w.key OR lower(coalesce(t.original_name, '')) = w.key""",
)
def match_alias(b: Bound):
    originals = b.lineitem.where("l_returnflag = 'R'").select(F.expr("concat('T', l_partkey, '_orig')").alias("name"))
    plain = b.lineitem.where("l_returnflag = 'N'").select(F.expr("concat('t', l_partkey)").alias("name"))
    return catalog.match_alias(b.V_tab, originals.unionByName(plain))


@query(
    "valid_tables",
    duck("V_tab") + "SELECT table_id, coalesce(original_name, name) AS display, coalesce(description, '') AS description FROM V_tab WHERE coalesce(is_valid, true)",
)
def valid_tables(b: Bound):
    rows = catalog.valid_tables(b.V_tab)
    return rows.select(
        "table_id",
        F.coalesce("original_name", "name").alias("display"),
        F.coalesce("description", F.lit("")).alias("description"),
    )


@query(
    "tables_without_description",
    duck("V_tab") + "SELECT table_id, db, schema_name, name FROM V_tab WHERE description IS NULL OR description = '' OR description = 'N/A'",
)
def tables_without_description(b: Bound):
    return catalog.tables_without_description(b.V_tab)


@query(
    "schema_tables_search",
    duck("V_tab", "V_col")
    + """SELECT t.table_id, t.name, t.schema_name, t.description, coalesce(n.column_count, 0) AS column_count FROM
(SELECT * FROM V_tab WHERE contains(lower(name), 'ring') OR contains(lower(coalesce(description, '')), 'ring') ORDER BY db NULLS LAST, schema_name NULLS LAST, name, table_id LIMIT 100) AS t
LEFT JOIN (SELECT table_id, count(*) AS column_count FROM V_col GROUP BY table_id) AS n ON n.table_id = t.table_id""",
)
def schema_tables_search(b: Bound):
    rows = catalog.schema_tables(b.V_tab, b.V_col, search="Ring")
    return rows.select("table_id", "name", "schema_name", "description", "column_count")


@query(
    "anchor_columns",
    duck("V_tab", "V_col")
    + """SELECT coalesce(t.schema_name, '') AS table_schema, coalesce(t.original_name, t.name) AS table_name, c.name AS column_name, c.dtype, coalesce(c.description, '') AS description, CAST(0.5 AS DOUBLE) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY name, column_id) AS rn FROM V_col WHERE coalesce(is_valid, true)
AND (contains(lower(name), 'c1') OR contains(lower(name), 'c_7') OR contains(lower(name), 'flag a') OR contains(lower(coalesce(description, '')), 'flag a'))) AS c
JOIN V_tab t ON t.table_id = c.table_id WHERE c.rn <= 10 AND coalesce(t.is_valid, true)""",
)
def anchor_columns(b: Bound):
    return catalog.anchor_columns(b.V_tab, b.V_col, substrings=[" C1 ", "c_7", None], keywords=["Flag A", " "])


WORDS = ["the.", "ÉONPA", "ention", "$(x)"]


@query(
    "queries_by_keyword",
    r"SELECT doc_id, source FROM documents WHERE regexp_matches(text, 'the\.|ÉONPA|ention|\$\(x\)', 'i') ORDER BY doc_id DESC LIMIT 20",
)
def queries_by_keyword(b: Bound):
    hits = catalog.queries_by_keyword(b.documents, "text", WORDS, [F.col("doc_id").desc()], 20)
    return hits.select("doc_id", "source")


@query(
    "queries_by_keyword_all",
    r"SELECT doc_id, source FROM documents WHERE regexp_matches(text, 'the\.|ÉONPA|ention|\$\(x\)', 'i')",
)
def queries_by_keyword_all(b: Bound):
    return catalog.queries_by_keyword(b.documents, "text", WORDS, [], None).select("doc_id", "source")


@query(
    "columns_by_prefix",
    duck("V_tab", "V_col")
    + """SELECT c.column_id, concat(t.db, '.', t.schema_name, '.', t.name, '.', c.name) AS fqn, c.dtype FROM V_col c JOIN V_tab t ON t.table_id = c.table_id WHERE starts_with(t.db, 'Brand#1')""",
)
def columns_by_prefix(b: Bound):
    return catalog.columns_by_prefix(b.V_tab, b.V_col, "Brand#1")


@query(
    "table_sample",
    duck("V_tab")
    + "SELECT table_id, substring(name, 1, 60) AS name, substring(coalesce(schema_name, ''), 1, 40) AS schema_name, substring(coalesce(description, ''), 1, 200) AS description FROM V_tab",
)
def table_sample(b: Bound):
    return catalog.table_sample(b.V_tab)


@query(
    "table_columns",
    duck("V_tab", "V_col")
    + "SELECT t.schema_name, t.name AS table_name, c.name AS column_name, c.dtype, c.nullable, c.is_primary_key, c.description FROM V_col c JOIN V_tab t ON t.table_id = c.table_id",
)
def table_columns(b: Bound):
    return catalog.table_columns(b.V_tab, b.V_col)


@query(
    "exists_batch",
    duck("V_col")
    + "SELECT p_partkey AS table_id, concat('c', CAST(p_size AS VARCHAR)) AS name, EXISTS (SELECT 1 FROM V_col c WHERE c.table_id = p_partkey AND c.name = concat('c', CAST(p_size AS VARCHAR))) AS \"exists\" FROM part",
)
def exists_batch(b: Bound):
    wanted = b.part.select(F.col("p_partkey").alias("table_id"), F.expr("concat('c', p_size)").alias("name"))
    return catalog.exists_batch(b.V_col, wanted, ["table_id", "name"])


@query(
    "code_values",
    """SELECT r.r_name AS group_name, n.n_nationkey AS code_value, n.n_name AS code_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE EXISTS (SELECT 1 FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = n.n_nationkey AND o.o_orderstatus = 'P')""".replace(
        "n.n_nationkey AS code_value", "CAST(n.n_nationkey AS BIGINT) AS code_value"
    ),
)
def code_values(b: Bound):
    groups = b.region.select(F.col("r_regionkey").alias("group_id"), F.col("r_name").alias("group_name"))
    codes = b.nation.select(
        F.col("n_regionkey").alias("group_id"), F.col("n_nationkey").alias("code_value"), F.col("n_name").alias("code_name")
    )
    buyers = b.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    wanted = b.customer.join(buyers, "c_custkey", "left_semi").select(F.col("c_nationkey").alias("code_value")).distinct()
    named = wanted.join(codes.join(groups, "group_id"), "code_value").select("group_name", "code_value")
    return catalog.code_values(groups, codes, named)


# ---------------------------------------------------------------- nested schemas


@query(
    "table_schemas",
    duck("V_tab", "V_col")
    + """SELECT t.table_id, coalesce(t.schema_name, '') AS schema_name, coalesce(t.original_name, t.name) AS table_name, coalesce(t.description, '') AS description, CAST(0 AS BIGINT) AS part,
coalesce(string_agg(concat(c.name, ':', c.dtype, ':', CAST(c.nullable AS VARCHAR), ':', CAST(c.is_primary_key AS VARCHAR), ':', coalesce(c.description, '')), '|' ORDER BY c.name), '') AS columns
FROM V_tab t LEFT JOIN V_col c ON c.table_id = t.table_id AND coalesce(c.is_valid, true) WHERE coalesce(t.is_valid, true) GROUP BY ALL""",
)
def table_schemas(b: Bound):
    rows = catalog.table_schemas(b.V_tab, b.V_col)
    text = F.transform(
        "columns", lambda c: F.concat_ws(":", c["name"], c["dtype"], c["nullable"].cast("string"), c["is_primary_key"].cast("string"), c["description"])
    )
    return rows.withColumn("columns", F.array_join(text, "|"))


# ---------------------------------------------------------------- foreign keys


@query(
    "fk_paths",
    duck(*CAT)
    + EDGES
    + """SELECT request_id, from_table_id, to_table_id, CAST(1 AS BIGINT) AS hops FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY from_table_id, to_table_id) AS rn
FROM (SELECT DISTINCT from_db AS request_id, from_table_id, to_table_id FROM E WHERE from_db = to_db AND from_table_id <> to_table_id) AS d) AS x WHERE rn <= 20""",
)
def fk_paths(b: Bound):
    return fk.fk_paths(edges(b), members(b)).drop("path")


@query(
    "fk_paths_two_hops",
    duck(*CAT)
    + EDGES
    + """, h AS (SELECT DISTINCT from_db AS r, from_table_id AS f, to_table_id AS t FROM E WHERE from_db = to_db AND from_table_id <> to_table_id),
p AS (SELECT r, f, t, 1 AS hops, CAST(f AS VARCHAR) || '>' || CAST(t AS VARCHAR) AS path FROM h),
q AS (SELECT a.r, a.f, c.t, 2 AS hops, min({'a': a.f, 'b': a.t, 'c': c.t}) AS m FROM h a JOIN h c ON c.r = a.r AND c.f = a.t WHERE c.t <> a.f AND NOT EXISTS (SELECT 1 FROM h x WHERE x.r = a.r AND x.f = a.f AND x.t = c.t) GROUP BY a.r, a.f, c.t),
u AS (SELECT * FROM p UNION ALL SELECT r, f, t, hops, concat(CAST(m.a AS VARCHAR), '>', CAST(m.b AS VARCHAR), '>', CAST(m.c AS VARCHAR)) FROM q)
SELECT r AS request_id, f AS from_table_id, t AS to_table_id, CAST(hops AS BIGINT) AS hops, path FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY hops, f, t) AS rn FROM u) AS x WHERE rn <= 500""",
)
def fk_paths_two_hops(b: Bound):
    found = fk.fk_paths(edges(b), members(b), limit=500, max_hops=2)
    return found.withColumn("path", F.array_join(F.transform("path", lambda x: x.cast("string")), ">"))


DETAIL = """SELECT request_id, from_schema AS from_schema_name, from_table, to_schema AS to_schema_name, to_table, from_column, to_column, constraint_name{extra} FROM (SELECT E.*, from_db AS request_id, row_number() OVER (PARTITION BY from_db
ORDER BY from_schema, from_table, to_schema, to_table, from_column, to_column, from_column_id, to_column_id) AS rn FROM E WHERE from_db = to_db AND {cond}) AS x WHERE rn <= 30"""


@query("fk_details", duck(*CAT) + EDGES + DETAIL.format(extra="", cond="all_valid"))
def fk_details(b: Bound):
    return fk.fk_details(edges(b, valid_only=True), members(b)).drop("from_column_id", "to_column_id")


@query("fk_details_all", duck(*CAT) + EDGES + "SELECT from_db AS request_id, from_table, to_table, from_column, to_column, constraint_name FROM E WHERE from_db = to_db")
def fk_details_all(b: Bound):
    rows = fk.fk_details(edges(b), members(b), limit=None)
    return rows.select("request_id", "from_table", "to_table", "from_column", "to_column", "constraint_name")


@query(
    "join_hints",
    duck(*CAT)
    + EDGES
    + "SELECT request_id, concat('JOIN ', ts, '.', to_table, ' ON ', fs, '.', from_table, '.', from_column, ' = ', ts, '.', to_table, '.', to_column) AS hint FROM (SELECT request_id, from_schema_name AS fs, to_schema_name AS ts, from_table, to_table, from_column, to_column FROM ("
    + DETAIL.format(extra="", cond="all_valid")
    + ") AS d) AS e",
)
def join_hints(b: Bound):
    return fk.join_hints(fk.fk_details(edges(b, valid_only=True), members(b))).select("request_id", "hint")


@query(
    "fk_relations_fill",
    duck(*CAT)
    + EDGES
    + SEEN
    + FILL
    + """SELECT seed AS seed_table_id, other AS related_table_id, other_schema AS related_schema, other_table AS related_table, CASE WHEN priority = 0 THEN 'foreign_key' ELSE 'referenced_by' END AS relation_type,
seed_column AS from_column, other_column AS to_column, other_description AS related_description FROM R""",
)
def fk_relations_fill(b: Bound):
    return fk.sorted_relations(fk.fk_relations(edges(b), 5))


@query(
    "fk_neighbors_any",
    duck(*CAT)
    + EDGES
    + SEEN
    + ANY
    + "SELECT seed AS seed_table_id, other AS related_table_id, other_schema AS related_schema, other_table AS related_table, other_description AS related_description FROM N",
)
def fk_neighbors_any(b: Bound):
    return fk.neighbors_any(edges(b))


@query(
    "fk_neighbors_out",
    duck(*CAT)
    + EDGES
    + """SELECT request_id, table_id, schema_name, name, description FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY schema_name, name, table_id) AS rn FROM
(SELECT DISTINCT E.from_db AS request_id, t.table_id, coalesce(t.schema_name, '') AS schema_name, coalesce(t.name, '') AS name, coalesce(t.description, '') AS description FROM E JOIN V_tab t ON t.table_id = E.to_table_id WHERE coalesce(t.is_valid, true)) AS d) AS x WHERE rn <= 25""",
)
def fk_neighbors_out(b: Bound):
    return fk.neighbors_out(edges(b), b.V_tab, members(b), 25)


@query(
    "column_fk",
    duck(*CAT)
    + EDGES
    + """SELECT from_column_id, to_table AS referenced_table, to_schema AS referenced_schema, to_column AS referenced_column, constraint_name FROM
(SELECT *, row_number() OVER (PARTITION BY from_column_id ORDER BY to_table, to_column, to_column_id) AS rn FROM E) AS x WHERE rn <= 5""",
)
def column_fk(b: Bound):
    return fk.column_fk(edges(b), 5)


@query(
    "relation_details",
    duck(*CAT)
    + EDGES
    + SEEN
    + FILL.replace("rn <= 5", "rn <= 8")
    + ANY
    + """, k AS (SELECT seed, count(*) AS taken FROM R GROUP BY seed),
x AS (SELECT n.*, row_number() OVER (PARTITION BY n.seed ORDER BY n.other_table, n.other) AS place FROM N n WHERE NOT EXISTS (SELECT 1 FROM R WHERE R.seed = n.seed AND R.other_schema = n.other_schema AND R.other_table = n.other_table))
SELECT seed AS seed_table_id, other_schema AS related_schema, other_table AS related_table, CASE WHEN priority = 0 THEN 'foreign_key' ELSE 'referenced_by' END AS relation_type, seed_column AS from_column, other_column AS to_column, CAST(NULL AS BIGINT) AS score, 'fk' AS part FROM R
UNION ALL SELECT x.seed, other_schema, other_table, '외래키 관계', NULL, NULL, 100, 'additional' FROM x LEFT JOIN k ON k.seed = x.seed WHERE place <= 8 - coalesce(taken, 0)""",
)
def relation_details(b: Bound):
    return fk.relation_details(edges(b), 8)


RELATED = """, G AS (SELECT seed, other, min(priority) AS priority, any_value(other_name) AS other_name, any_value(other_schema) AS other_schema, any_value(other_db) AS other_db, greatest(count(DISTINCT source_column), count(DISTINCT target_column)) AS fk_count
FROM O WHERE (seed <> other OR priority = 0) AND {cond} GROUP BY seed, other),
L AS (SELECT DISTINCT seed, other FROM O WHERE other_description = '' AND {loaded}),
F AS (SELECT *, {score} AS score, row_number() OVER (PARTITION BY seed ORDER BY {score} DESC, other) AS rn FROM G WHERE NOT EXISTS (SELECT 1 FROM L WHERE L.seed = G.seed AND L.other = G.other)),
X AS (SELECT G.seed, count(*) AS n FROM G JOIN L ON L.seed = G.seed AND L.other = G.other GROUP BY G.seed)
SELECT F.seed AS seed_table_id, other AS related_table_id, other_name AS related_table, coalesce(other_schema, 'public') AS related_schema, concat('{mode}:', {ds}, ':', other_schema, ':', other_name) AS node_key,
CASE WHEN priority = 0 THEN 'FK_OUT' ELSE 'FK_IN' END AS relation_type, CAST(F.score AS DOUBLE) AS score, fk_count, coalesce(X.n, 0) AS excluded FROM F LEFT JOIN X ON X.seed = F.seed WHERE rn <= 5"""

RELATED_ENDS = ("table_id", "schema_name", "db", "name", "description", "column")


@query(
    "related_tables",
    duck(*CAT) + EDGES + SEEN + RELATED.format(cond="true", loaded="true", score="0.97", mode="robo", ds="''"),
)
def related_tables(b: Bound):
    rows = fk.edges_once(edges(b), RELATED_ENDS)
    loaded = fk.oriented(rows).where("other_description = ''")
    return fk.related_tables(
        rows, loaded=loaded.select("seed_table_id", F.col("other_table_id").alias("related_table_id"))
    )


@query(
    "related_tables_scored",
    duck(*CAT)
    + EDGES
    + SEEN
    + RELATED.format(cond="true", loaded="false", score="round(0.9 + least(fk_count * 0.02, 0.09), 2)", mode="text2sql", ds="other_db"),
)
def related_tables_scored(b: Bound):
    return fk.related_tables(edges(b), mode="text2sql", scored=True)


LISTS = RELATED.replace(
    " AS fk_count\nFROM O",
    " AS fk_count, string_agg(DISTINCT source_column, ',' ORDER BY source_column) AS source_columns, string_agg(DISTINCT target_column, ',' ORDER BY target_column) AS target_columns\nFROM O",
).replace("fk_count, coalesce(X.n, 0)", "fk_count, source_columns, target_columns, coalesce(other_db, '') AS datasource, coalesce(X.n, 0)")


@query(
    "related_tables_columns",
    duck(*CAT)
    + EDGES
    + SEEN
    + LISTS.format(cond="true", loaded="true", score="round(0.9 + least(fk_count * 0.02, 0.09), 2)", mode="text2sql", ds="other_db"),
)
def related_tables_columns(b: Bound):
    """Scored related tables with the columns on both sides and the data source."""
    rows = fk.edges_once(edges(b), RELATED_ENDS)
    loaded = fk.oriented(rows).where("other_description = ''").select("seed_table_id", F.col("other_table_id").alias("related_table_id"))
    found = fk.related_tables(rows, loaded=loaded, mode="text2sql", scored=True, lists=True)
    return found.withColumns({c: F.array_join(c, ",") for c in ("source_columns", "target_columns")})


@query(
    "related_pairs",
    duck(*CAT)
    + EDGES
    + """SELECT from_name, to_name, CAST(0 AS BIGINT) AS part, string_agg(concat(from_column, '=', to_column), '|' ORDER BY from_column, to_column) AS column_pairs FROM E GROUP BY from_name, to_name""",
)
def related_pairs(b: Bound):
    pairs = F.transform("column_pairs", lambda p: F.concat_ws("=", p["source"], p["target"]))
    return fk.related_pairs(edges(b)).withColumn("column_pairs", F.array_join(pairs, "|"))


IMPORTANCE = """, C AS (SELECT c.table_id, count(*) AS n FROM (SELECT from_column_id AS column_id FROM V_fk UNION ALL SELECT to_column_id FROM V_fk WHERE to_column_id <> from_column_id) AS e JOIN V_col c ON c.column_id = e.column_id GROUP BY c.table_id) """


@query(
    "table_importance",
    duck(*CAT)
    + IMPORTANCE
    + "SELECT t.table_id, t.schema_name, t.name, t.description, CAST(coalesce(C.n, 0) AS BIGINT) AS importance FROM V_tab t LEFT JOIN C ON C.table_id = t.table_id",
)
def table_importance(b: Bound):
    return fk.table_importance(b.V_tab, b.V_col, b.V_fk).orderBy(F.col("importance").desc(), "table_id")


@query(
    "co_referenced",
    duck("V_qt", *CAT)
    + IMPORTANCE
    + """, s AS (SELECT t.table_id FROM V_tab t LEFT JOIN C ON C.table_id = t.table_id ORDER BY coalesce(C.n, 0) DESC, t.table_id LIMIT 20)
SELECT DISTINCT s.table_id AS seed_table_id, b.table_id AS related_table_id FROM s JOIN V_qt a ON a.table_id = s.table_id JOIN V_qt b ON b.query_id = a.query_id AND b.table_id <> a.table_id""",
)
def co_referenced(b: Bound):
    ranked = fk.table_importance(b.V_tab, b.V_col, b.V_fk)
    seeds = ranked.orderBy(F.col("importance").desc(), "table_id").limit(20)
    return fk.co_referenced(b.V_qt.withColumnRenamed("query_id", "proc"), seeds)


@query(
    "table_references",
    duck("V_tab")
    + """SELECT DISTINCT t.name AS table_name, c.c_name AS procedure_name, c.c_mktsegment AS procedure_type, l.l_linenumber::BIGINT AS start_line, l.l_returnflag AS access_type, o.o_orderstatus AS statement_type
FROM lineitem l JOIN V_tab t ON t.table_id = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) AS c ON c.c_custkey = o.o_custkey""",
)
def table_references(b: Bound):
    refs = b.lineitem.select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("statement_id"),
        F.col("l_partkey").alias("table_id"),
        F.col("l_returnflag").alias("ref_type"),
    ).distinct()
    heads = b.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    statements = (
        b.lineitem.select("l_orderkey", "l_linenumber")
        .distinct()
        .join(heads, "l_orderkey")
        .select(
            F.concat_ws("/", "l_orderkey", "l_linenumber").alias("statement_id"),
            F.col("o_custkey").alias("proc_id"),
            F.col("o_orderstatus").alias("statement_type"),
            F.col("l_linenumber").alias("start_line"),
        )
    )
    procedures = b.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("proc_id"),
        F.col("c_name").alias("procedure_name"),
        F.col("c_mktsegment").alias("procedure_type"),
    )
    return fk.table_references(refs, statements, procedures, b.V_tab)


@query(
    "schema_relationships",
    duck(*CAT)
    + EDGES
    + """SELECT from_schema, from_name AS from_table, from_column AS source_column, to_schema, to_name AS to_table, to_column AS target_column, rel_type FROM
(SELECT E.*, CASE c.dtype WHEN 'A' THEN 'FK_TO_TABLE' WHEN 'N' THEN 'ONE_TO_MANY' ELSE 'CUSTOM' END AS rel_type FROM E JOIN V_col c ON c.column_id = E.from_column_id) AS x WHERE rel_type <> 'CUSTOM'""",
)
def schema_relationships(b: Bound):
    return fk.schema_relationships(relationships(b), b.V_tab)


def relationships(b: Bound):
    """Typed table relationships of the key pairs, the type following the source column's type."""
    cols = b.V_col
    source = cols.select(
        F.col("column_id").alias("from_column_id"),
        F.col("table_id").alias("from_table_id"),
        F.col("name").alias("source_column"),
        F.expr("CASE dtype WHEN 'A' THEN 'FK_TO_TABLE' WHEN 'N' THEN 'ONE_TO_MANY' ELSE 'CUSTOM' END").alias("rel_type"),
    )
    target = cols.select(
        F.col("column_id").alias("to_column_id"), F.col("table_id").alias("to_table_id"), F.col("name").alias("target_column")
    )
    return b.V_fk.join(source, "from_column_id").join(target, "to_column_id")


@query(
    "existing_fk_set",
    duck(*CAT)
    + EDGES
    + "SELECT DISTINCT concat(from_schema, '.', from_name) AS from_table, concat(to_schema, '.', to_name) AS to_table, from_column, to_column FROM E",
)
def existing_fk_set(b: Bound):
    return fk.existing_fk_set(edges(b))


@query(
    "fk_in_scope",
    duck(*CAT)
    + EDGES
    + """SELECT from_schema, from_name AS from_table, from_column, to_name AS to_table, to_column FROM E WHERE from_schema = to_schema
AND from_table_id IN (SELECT table_id FROM V_tab WHERE coalesce(is_valid, true)) AND to_table_id IN (SELECT table_id FROM V_tab WHERE coalesce(is_valid, true))""",
)
def fk_in_scope(b: Bound):
    named = edges(b).select(
        F.col("from_schema_name").alias("from_schema"),
        F.col("from_name").alias("from_table"),
        "from_column",
        F.col("to_schema_name").alias("to_schema"),
        F.col("to_name").alias("to_table"),
        "to_column",
    )
    return fk.fk_in_scope(named, b.V_tab.where(is_valid("is_valid"))).drop("to_schema")
