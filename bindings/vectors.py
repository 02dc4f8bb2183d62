"""Bindings of the vector operators (family V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.logs import scratch
from bindings.registry import query
from bindings.views import Bound, duck
from catalith.functions.vectors import format_vector, parse_vector
from catalith.operators import vector
from catalith.sources import cells

def r6():
    return F.round("similarity", 6).alias("similarity")

SIM = "round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(r.vector AS DOUBLE[])), 12)"


def ranked(k: int, frm: str = "V_emb e, V_req r", where: str = "true", by: str = "r.qid", extra: str = "") -> str:
    return f"""SELECT * FROM (SELECT r.qid, e.vec_id{extra}, {SIM} AS sim, row_number() OVER (PARTITION BY {by} ORDER BY {SIM} DESC, e.vec_id) AS rank
FROM {frm} WHERE {where}) AS t WHERE rank <= {k}"""


@query(
    "vec_topk",
    duck("V_emb", "V_req") + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(5)}) AS x",
)
def vec_topk(b: Bound):
    return vector.vector_topk(b.V_emb, b.V_req, 5, id_col="vec_id").select("qid", "vec_id", r6(), "rank")


@query(
    "vec_topk_filtered",
    duck("V_emb", "V_req", "V_tab")
    + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(5, 'V_emb e JOIN V_tab t ON t.table_id = e.vec_id JOIN V_req r ON r.qid = e.grp', 'coalesce(t.is_valid, true)')}) AS x",
)
def vec_topk_filtered(b: Bound):
    flags = b.V_tab.select(F.col("table_id").alias("vec_id"), "is_valid")
    corpus = b.V_emb.join(flags, "vec_id")
    asked = b.V_req.withColumn("groups", F.array(F.col("qid").cast("string")))
    hits = vector.vector_topk_filtered(corpus, asked, 5, id_col="vec_id", group_col="grp", request_groups="groups")
    return hits.select("qid", "vec_id", r6(), "rank")


@query(
    "vec_topk_parent",
    duck("V_emb", "V_req", "V_tab")
    + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank, name, description FROM ({ranked(10, 'V_emb e LEFT JOIN V_tab t ON t.table_id = e.vec_id, V_req r', 'true', 'r.qid', ', t.name, t.description')}) AS x",
)
def vec_topk_parent(b: Bound):
    children = b.V_emb.withColumn("table_id", F.col("vec_id"))
    hits = vector.vector_topk_with_parent(
        children, b.V_tab, b.V_req, 10, id_col="vec_id", parent_columns=("name", "description")
    )
    return hits.select("qid", "vec_id", r6(), "rank", "name", "description")


@query(
    "vec_topk_parent_valid",
    duck("V_emb", "V_req", "V_tab")
    + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank, name FROM ({ranked(10, 'V_emb e JOIN V_tab t ON t.table_id = e.vec_id, V_req r', 'coalesce(t.is_valid, true)', 'r.qid', ', t.name')}) AS x",
)
def vec_topk_parent_valid(b: Bound):
    children = b.V_emb.withColumn("table_id", F.col("vec_id"))
    hits = vector.vector_topk_with_parent(
        children, b.V_tab, b.V_req, 10, id_col="vec_id", parent_columns=("name",), valid_parents_only=True
    )
    return hits.select("qid", "vec_id", r6(), "rank", "name")


@query(
    "vec_topk_threshold",
    duck("V_emb", "V_req")
    + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(3, where=SIM + ' >= 0.85')}) AS x",
)
def vec_topk_threshold(b: Bound):
    return vector.similar_cached(b.V_emb, b.V_req, id_col="vec_id").select("qid", "vec_id", r6(), "rank")


@query(
    "vec_topk_floor",
    duck("V_emb", "V_req")
    + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(20, where=SIM + ' >= 0.35')}) AS x",
)
def vec_topk_floor(b: Bound):
    """A lower floor than the cache-hit default, which few request vectors reach."""
    hits = vector.similar_cached(b.V_emb, b.V_req, 20, 0.35, id_col="vec_id")
    return hits.select("qid", "vec_id", r6(), "rank")


@query(
    "vec_topk_postfilter",
    duck("V_emb", "V_req", "V_tab")
    + f"""SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 4) AS similarity, rank, name, CASE WHEN schema_name <> '' THEN schema_name ELSE 'public' END AS schema_name, substring(description, 1, 200) AS description
FROM ({ranked(10, 'V_emb e JOIN V_tab t ON t.table_id = e.vec_id, V_req r', "t.description <> ''", 'r.qid', ', t.name, t.schema_name, t.description')}) AS x WHERE sim >= 0.3""",
)
def vec_topk_postfilter(b: Bound):
    tables = b.V_tab.withColumnRenamed("table_id", "vec_id").join(b.V_emb.select("vec_id", "embedding"), "vec_id")
    hits = vector.semantic_table_search(tables, b.V_req, id_col="vec_id")
    return hits.select("qid", "vec_id", "similarity", "rank", "name", "schema_name", "description")


@query(
    "vec_topk_per_group",
    duck("V_emb", "V_req")
    + f"SELECT CAST(qid AS BIGINT) AS qid, CAST(grp AS BIGINT) AS grp, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(3, by='r.qid, e.grp', extra=', e.grp')}) AS x",
)
def vec_topk_per_group(b: Bound):
    hits = vector.vector_topk_per_group(b.V_emb, b.V_req, 3, group_col="grp", id_col="vec_id")
    return hits.select("qid", "grp", "vec_id", r6(), "rank")


INTENT_SIM = SIM.replace("r.vector", "r.intent_vector")


@query(
    "vec_fusion",
    duck("V_emb", "V_req")
    + f""", q AS (SELECT qid, vec_id, sim FROM ({ranked(20, where=SIM + ' >= 0.3')}) AS x),
i AS (SELECT qid, vec_id, sim FROM ({ranked(20, where=SIM + ' >= 0.3').replace('r.vector', 'r.intent_vector')}) AS x),
f AS (SELECT coalesce(q.qid, i.qid) AS qid, coalesce(q.vec_id, i.vec_id) AS vec_id, coalesce(q.sim, 0) AS qs, coalesce(i.sim, 0) AS is_ FROM q FULL JOIN i ON q.qid = i.qid AND q.vec_id = i.vec_id),
s AS (SELECT qid, vec_id, qs, is_, round(0.6 * is_ + 0.4 * qs, 12) AS score FROM f)
SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(qs, 6) AS question_score, round(is_, 6) AS intent_score, round(score, 6) AS score, rank
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.qid ORDER BY score DESC, e.grp DESC, s.vec_id) AS rank FROM s JOIN V_emb e ON e.vec_id = s.vec_id) AS t WHERE rank <= 5""".replace(
        "WITH , ", "WITH "
    ),
)
def vec_fusion(b: Bound):
    fused = vector.vector_fusion(
        b.V_emb,
        b.V_req,
        id_col="vec_id",
        question_vector="vector",
        intent_vector="intent_vector",
        corpus_intent="embedding",
        best_run="grp",
    )
    score = [F.round(c, 6).alias(c) for c in ("question_score", "intent_score", "score")]
    return fused.select("qid", "vec_id", *score, "rank")


# The request vectors are the centres, so that DuckDB can compute the cells too.
CELLS = f""", c AS (SELECT vec_id, embedding, qid AS cell FROM (SELECT e.vec_id, e.embedding, r.qid, row_number() OVER (PARTITION BY e.vec_id ORDER BY {SIM} DESC, r.qid) AS n FROM V_emb e, V_req r) AS x WHERE n = 1),
p AS (SELECT qid, cell FROM (SELECT r.qid, e.qid AS cell, row_number() OVER (PARTITION BY r.qid ORDER BY {SIM.replace("e.embedding", "e.vector")} DESC, e.qid) AS n FROM V_req r, V_req e) AS x WHERE n <= 4),
a AS (SELECT r.qid, e.vec_id, {SIM} AS sim, row_number() OVER (PARTITION BY r.qid ORDER BY {SIM} DESC, e.vec_id) AS rank FROM c e JOIN p ON p.cell = e.cell JOIN V_req r ON r.qid = p.qid) """


def celled(b: Bound):
    centres = b.V_req.selectExpr("CAST(qid AS INT) AS cell", "vector AS centre")
    return vector.assign_cells(b.V_emb, centres, id_col="vec_id"), centres


@query(
    "vec_topk_approx",
    duck("V_emb", "V_req") + CELLS + "SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM a WHERE rank <= 5",
)
def vec_topk_approx(b: Bound):
    rows, centres = celled(b)
    hits = vector.vector_topk_approx(rows, centres, b.V_req, 5, id_col="vec_id")
    return hits.select("qid", "vec_id", r6(), "rank")


@query("vec_topk_stored", duck("V_emb", "V_req") + CELLS + "SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM a WHERE rank <= 5")
def vec_topk_stored(b: Bound):
    """Vectors written by cell in two insertions, and searched in the files of the probed cells."""
    root = f"{scratch(b)}/cells"
    centres = b.V_req.selectExpr("CAST(qid AS INT) AS cell", "vector AS centre")
    for rows in ("grp % 2 = 0", "grp % 2 <> 0 OR grp IS NULL"):
        cells.insert_vectors(b.V_emb.where(rows), centres, root, id_col="vec_id")
    hits = vector.vector_topk_approx(cells.read_cells(b.spark, root), centres, b.V_req, 5, id_col="vec_id")
    return hits.select("qid", "vec_id", r6(), "rank")


@query(
    "vec_recall",
    duck("V_emb", "V_req")
    + CELLS
    + f""", x AS ({ranked(5)})
SELECT CAST(x.qid AS BIGINT) AS qid, round(avg(CASE WHEN a.vec_id IS NULL THEN 0 ELSE 1 END), 4) AS recall FROM x LEFT JOIN a ON a.qid = x.qid AND a.vec_id = x.vec_id AND a.rank <= 5 GROUP BY x.qid""",
)
def vec_recall(b: Bound):
    rows, centres = celled(b)
    exact = vector.vector_topk(b.V_emb, b.V_req, 5, id_col="vec_id")
    approx = vector.vector_topk_approx(rows, centres, b.V_req, 5, id_col="vec_id")
    return vector.recall(exact, approx, id_col="vec_id")


@query("vec_topk_kmeans")
def vec_topk_kmeans(b: Bound):
    """Approximate search over fitted cells; a fixed point has no DuckDB text."""
    centres = vector.fit_cells(b.V_emb, 16)
    hits = vector.vector_topk_approx(vector.assign_cells(b.V_emb, centres, id_col="vec_id"), centres, b.V_req, 5, id_col="vec_id")
    return hits.select("qid", "vec_id", r6(), "rank")


@query(
    "vec_topk_candidates",
    duck("V_emb", "V_req")
    + f"SELECT CAST(qid AS BIGINT) AS qid, CAST(grp AS BIGINT) AS grp, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(3, where='e.grp IN (r.qid, (r.qid + 3) % 10)', by='r.qid, e.grp', extra=', e.grp')}) AS x",
)
def vec_topk_candidates(b: Bound):
    """Per group, inside the candidate groups of each request."""
    asked = b.V_req.withColumn("groups", F.array(F.col("qid").cast("string"), F.pmod(F.col("qid") + 3, F.lit(10)).cast("string")))
    hits = vector.vector_topk_per_group(b.V_emb, asked, 3, group_col="grp", id_col="vec_id", request_groups="groups")
    return hits.select("qid", "grp", "vec_id", r6(), "rank")


BLOCKED = duck("V_emb", "V_req") + f"SELECT CAST(qid AS BIGINT) AS qid, vec_id, round(sim, 6) AS similarity, rank FROM ({ranked(5)}) AS x"


@query("vec_topk_blocks", BLOCKED)
def vec_topk_blocks(b: Bound):
    """The way for request batches above the closure limit."""
    return vector.vector_topk(b.V_emb, b.V_req, 5, id_col="vec_id", max_closure_floats=0).select("qid", "vec_id", r6(), "rank")


@query(
    "vec_parse",
    "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings",
)
def vec_parse(b: Bound):
    text = b.embeddings.select("vec_id", format_vector("embedding").alias("literal"))
    parsed = text.select("vec_id", parse_vector("literal").cast("array<double>").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    return parsed.select("vec_id", F.size("v").alias("dims"), F.round(total, 4).alias("total"))


@query(
    "embedding_counts",
    "SELECT 'tables' AS store, count(*) AS row_count FROM embeddings UNION ALL SELECT 'columns', count(*) FROM lineitem",
)
def embedding_counts(b: Bound):
    return vector.embedding_counts({"tables": b.embeddings, "columns": b.lineitem})
