"""Bindings of usage statistics, history, value mappings, glossary and calendar (families S and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.logs import scratch
from bindings.registry import query
from bindings.views import Bound, duck
from catalith.operators import usage
from catalith.sources import schemas

USES = """, u AS (SELECT qt.table_id, q.query_id, q.question, q.created_at FROM V_qt qt JOIN V_query q ON q.query_id = qt.query_id WHERE q.status = 'completed'),
s AS (SELECT table_id, string_agg(question, '|' ORDER BY question) AS sample_questions FROM (SELECT DISTINCT table_id, question FROM (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY created_at DESC, query_id) AS rn FROM u) AS x WHERE rn <= 3) AS y GROUP BY table_id),
c AS (SELECT table_id, count(*) AS usage_count FROM u GROUP BY table_id)
SELECT c.table_id, t.schema_name, t.name AS table_name, c.usage_count, s.sample_questions FROM c JOIN V_tab t ON t.table_id = c.table_id LEFT JOIN s ON s.table_id = c.table_id """


@query("table_usage", duck("V_tab", "V_qt", "V_query") + USES + "ORDER BY usage_count DESC, c.table_id LIMIT 20")
def table_usage(b: Bound):
    rows = usage.table_usage(b.V_query, b.V_qt, b.V_tab)
    return rows.withColumn("sample_questions", F.array_join("sample_questions", "|"))


@query("table_usage_all", duck("V_tab", "V_qt", "V_query") + USES)
def table_usage_all(b: Bound):
    rows = usage.table_usage(b.V_query, b.V_qt, b.V_tab, limit=None)
    return rows.withColumn("sample_questions", F.array_join("sample_questions", "|"))


COLUMN_USES = """SELECT c.column_id, c.name AS column_name, qc.usage_type, count(*) AS usage_count FROM V_qc qc JOIN V_col c ON c.column_id = qc.column_id JOIN V_query q ON q.query_id = qc.query_id
WHERE q.status = 'completed' GROUP BY c.column_id, c.name, qc.usage_type"""


@query("column_usage", duck("V_col", "V_qc", "V_query") + COLUMN_USES + " ORDER BY usage_count DESC, c.column_id, qc.usage_type LIMIT 30")
def column_usage(b: Bound):
    return usage.column_usage(b.V_query, b.V_qc, b.V_col)


@query("column_usage_all", duck("V_col", "V_qc", "V_query") + COLUMN_USES)
def column_usage_all(b: Bound):
    return usage.column_usage(b.V_query, b.V_qc, b.V_col, limit=None)


OVERLAP = """, tm AS (SELECT query_id, count(DISTINCT table_id) AS n FROM V_qt WHERE table_id IN (SELECT table_id FROM V_tab WHERE original_name IS NOT NULL) GROUP BY query_id),
cm AS (SELECT query_id, count(DISTINCT column_id) AS n FROM V_qc WHERE column_id IN (SELECT column_id FROM V_col WHERE is_primary_key) GROUP BY query_id)
SELECT q.query_id, q.question, coalesce(tm.n, 0) * 2 + coalesce(cm.n, 0) AS score FROM V_query q LEFT JOIN tm ON tm.query_id = q.query_id LEFT JOIN cm ON cm.query_id = q.query_id
WHERE q.status = 'completed' AND coalesce(tm.n, 0) + coalesce(cm.n, 0) > 0 """


@query("query_overlap", duck("V_tab", "V_col", "V_qt", "V_qc", "V_query") + OVERLAP + "ORDER BY score DESC, q.created_at DESC, q.query_id LIMIT 5")
def query_overlap(b: Bound):
    tables, columns = b.V_tab.where("original_name IS NOT NULL"), b.V_col.where("is_primary_key")
    return usage.query_overlap(b.V_query, b.V_qt, b.V_qc, tables, columns).select("query_id", "question", "score")


@query("query_overlap_all", duck("V_tab", "V_col", "V_qt", "V_qc", "V_query") + OVERLAP)
def query_overlap_all(b: Bound):
    tables, columns = b.V_tab.where("original_name IS NOT NULL"), b.V_col.where("is_primary_key")
    rows = usage.query_overlap(b.V_query, b.V_qt, b.V_qc, tables, columns, limit=None)
    return rows.select("query_id", "question", "score")


@query(
    "queries_recent",
    duck("V_query")
    + "SELECT query_id, question, CAST(0 AS BIGINT) AS score FROM V_query WHERE status = 'completed' ORDER BY created_at DESC, query_id LIMIT 5",
)
def queries_recent(b: Bound):
    return usage.recent_queries(b.V_query).select("query_id", "question", "score")


@query(
    "history_page",
    duck("V_tab", "V_qt", "V_query")
    + """, p AS (SELECT * FROM V_query WHERE status = 'completed' ORDER BY created_at DESC, query_id LIMIT 20 OFFSET 40)
SELECT p.query_id, p.question, p.execution_time_ms, CAST(0 AS BIGINT) AS part, coalesce(string_agg(t.name, '|' ORDER BY t.name), '') AS tables FROM p LEFT JOIN V_qt u ON u.query_id = p.query_id LEFT JOIN V_tab t ON t.table_id = u.table_id GROUP BY ALL""",
)
def history_page(b: Bound):
    rows = usage.history_page(b.V_query, b.V_qt, b.V_tab, page=3, status="completed")
    return rows.select("query_id", "question", "execution_time_ms", "part", F.array_join("tables.name", "|").alias("tables"))


@query(
    "history_page_deep",
    duck("V_tab", "V_qt", "V_query")
    + """, p AS (SELECT * FROM V_query ORDER BY created_at DESC, query_id LIMIT 50 OFFSET 1000)
SELECT p.query_id, p.question, p.execution_time_ms, CAST(0 AS BIGINT) AS part, coalesce(string_agg(t.name, '|' ORDER BY t.name), '') AS tables FROM p LEFT JOIN V_qt u ON u.query_id = p.query_id LEFT JOIN V_tab t ON t.table_id = u.table_id GROUP BY ALL""",
)
def history_page_deep(b: Bound):
    """Page 21 of 50 rows, found by the counts of the time ranges."""
    rows = usage.history_page(b.V_query, b.V_qt, b.V_tab, page=21, page_size=50, seek_from=0)
    return rows.select("query_id", "question", "execution_time_ms", "part", F.array_join("tables.name", "|").alias("tables"))


@query(
    "history_total",
    duck("V_query") + "SELECT coalesce(status, 'all') AS status, count(*) AS total FROM V_query GROUP BY ROLLUP (status)",
)
def history_total(b: Bound):
    return usage.history_total(b.V_query)


@query(
    "glossary_counts",
    duck("V_term")
    + "SELECT glossary, count(*) AS term_count, count(quality) AS reviewed_count FROM V_term GROUP BY glossary",
)
def glossary_counts(b: Bound):
    terms = b.V_term
    children = {"term_count": terms, "reviewed_count": terms.where("quality IS NOT NULL")}
    return usage.child_counts(terms.select("glossary").distinct(), "glossary", children)


@query(
    "calendar_counts",
    duck("V_cal")
    + "SELECT calendar, count(*) FILTER (WHERE day_type = 'non_business') AS day_count, count(*) FILTER (WHERE day_type = 'holiday') AS holiday_count FROM V_cal GROUP BY calendar",
)
def calendar_counts(b: Bound):
    days = b.V_cal
    children = {
        "day_count": days.where("day_type = 'non_business'"),
        "holiday_count": days.where("day_type = 'holiday'"),
    }
    return usage.child_counts(days.select("calendar").distinct(), "calendar", children)


@query(
    "calendar_detail",
    duck("V_cal")
    + """SELECT calendar, CAST(0 AS BIGINT) AS part, coalesce(string_agg(CAST(day AS VARCHAR), '|' ORDER BY day) FILTER (WHERE day_type = 'non_business'), '') AS days,
coalesce(string_agg(CAST(day AS VARCHAR), '|' ORDER BY day) FILTER (WHERE day_type = 'holiday'), '') AS holidays FROM V_cal GROUP BY calendar""",
)
def calendar_detail(b: Bound):
    cal = b.V_cal
    days = {
        "days": cal.where("day_type = 'non_business'").select("calendar", "day"),
        "holidays": cal.where("day_type = 'holiday'").select("calendar", "day"),
    }
    rows = usage.calendar_detail(cal.select("calendar").distinct(), days)
    text = [F.array_join(F.transform(c, lambda d: d["day"].cast("string")), "|").alias(c) for c in days]
    return rows.select("calendar", "part", *text)


@query(
    "terms_with_tags",
    duck("V_term")
    + """SELECT term_id, name, CAST(0 AS BIGINT) AS part, domain AS domains, concat_ws('|', CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, CASE toxic WHEN 1 THEN 'toxic' END) AS tags FROM V_term WHERE contains(lower(name), 'src1')""",
)
def terms_with_tags(b: Bound):
    terms = b.V_term
    tags = terms.selectExpr("term_id", "CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS name").unionByName(
        terms.selectExpr("term_id", "CASE toxic WHEN 1 THEN 'toxic' END AS name")
    )
    links = {
        "domains": terms.select("term_id", F.col("domain").alias("name")),
        "tags": tags.where("name IS NOT NULL"),
    }
    rows = usage.terms_with_tags(terms.select("term_id", "glossary", "name"), links, search="SRC1")
    joined = [F.array_join(f"{c}.name", "|").alias(c) for c in links]
    return rows.select("term_id", "name", "part", *joined)


GLOSSARY = """, o AS (SELECT term_id, concat('owner of ', glossary) AS name FROM V_term UNION SELECT term_id, 'second reader' FROM V_term WHERE quality = 0),
u AS (SELECT term_id, string_agg(name, '|' ORDER BY name) AS owners FROM o GROUP BY term_id) """


@query(
    "term_details",
    duck("V_term")
    + GLOSSARY
    + """SELECT t.term_id, t.glossary, t.name, CASE WHEN t.toxic = 0 THEN concat('about ', t.name) ELSE '' END AS description,
CASE t.quality WHEN 1 THEN 'Approved' WHEN 0 THEN 'Review' ELSE 'Draft' END AS status, CASE WHEN t.toxic = 1 THEN concat(upper(t.glossary), '|', t.glossary) ELSE '' END AS synonyms,
CAST(0 AS BIGINT) AS part, coalesce(t.domain, '') AS domains, concat_ws('|', CASE t.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, CASE t.toxic WHEN 1 THEN 'toxic' END) AS tags, u.owners
FROM V_term t JOIN u ON u.term_id = t.term_id""",
)
def term_details(b: Bound):
    """All terms with status, synonyms, domains, tags and owners, from stores of the declared schemas."""
    root = scratch(b)
    base = b.V_term.select("term_id", "glossary", "name", "domain", "quality", "toxic")
    named = F.xxhash64("name")
    owned = base.selectExpr("term_id", "concat('owner of ', glossary) AS name").unionByName(base.where("quality = 0").selectExpr("term_id", "'second reader' AS name"))
    tagged = base.selectExpr("term_id", "CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS name").unionByName(base.selectExpr("term_id", "CASE toxic WHEN 1 THEN 'toxic' END AS name"))
    placed = base.select("term_id", F.col("domain").alias("name"))
    for store, rows in (("owner", owned), ("tag", tagged), ("domain", placed)):
        rows = rows.where("name IS NOT NULL").withColumn(f"{store}_id", named)
        schemas.save(rows.select(f"{store}_id", "name").distinct(), root, f"{store}s")
        schemas.save(rows, root, f"term_{store}s")
    links = {f"{s}s": schemas.scan(b.spark, root, f"term_{s}s").join(schemas.scan(b.spark, root, f"{s}s"), f"{s}_id").select("term_id", "name") for s in ("domain", "tag", "owner")}
    terms = base.selectExpr(
        "term_id", "glossary", "name", "CASE WHEN toxic = 0 THEN concat('about ', name) END AS description",
        "CASE quality WHEN 1 THEN 'Approved' WHEN 0 THEN 'Review' END AS status", "CASE WHEN toxic = 1 THEN array(upper(glossary), glossary) END AS synonyms",
    )
    rows = usage.terms_with_tags(terms, links)
    joined = [F.array_join(f"{c}.name", "|").alias(c) for c in links]
    return rows.select("term_id", "glossary", "name", "description", "status", F.array_join("synonyms", "|").alias("synonyms"), "part", *joined)


MAPPED = """, w AS (SELECT o_orderpriority AS request_id, p_name AS term FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F'
UNION SELECT concat('nation ', CAST(s_nationkey AS VARCHAR)), upper(substring(s_name, 3, 6)) FROM supplier
UNION SELECT p_brand, upper(substring(p_name, 3, 5)) FROM part),
x AS (SELECT w.request_id, m.* FROM w JOIN V_vm m ON m.natural_value = w.term),
y AS (SELECT DISTINCT w.request_id, m.* FROM w JOIN V_vm m ON contains(lower(m.natural_value), lower(w.term)) WHERE w.request_id NOT IN (SELECT request_id FROM x)),
z AS (SELECT *, 'exact' AS match FROM x UNION ALL SELECT *, 'substring' FROM y)
SELECT request_id, mapping_id, natural_value, code_value, CAST(usage_count AS BIGINT) AS usage_count, match FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY usage_count DESC, mapping_id) AS rn FROM z) AS r WHERE rn <= 20"""


@query("value_mapping", duck("V_vm") + MAPPED)
def value_mapping(b: Bound):
    bought = (
        b.orders.where("o_orderstatus = 'F'")
        .join(b.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(b.part, F.col("p_partkey") == F.col("l_partkey"))
        .selectExpr("o_orderpriority AS request_id", "p_name AS term")
    )
    sold = b.supplier.selectExpr("concat('nation ', s_nationkey) AS request_id", "upper(substring(s_name, 3, 6)) AS term")
    brands = b.part.selectExpr("p_brand AS request_id", "upper(substring(p_name, 3, 5)) AS term")
    terms = bought.unionByName(sold).unionByName(brands)
    rows = usage.value_mapping(b.V_vm, terms, max_terms=None)
    return rows.select("request_id", "mapping_id", "natural_value", "code_value", "usage_count", "match")


@query(
    "find_value_mapping",
    duck("V_vm")
    + """, w AS (SELECT DISTINCT substring(p_name, 2, 4) AS word FROM part)
SELECT word, mapping_id, natural_value, CAST(usage_count AS BIGINT) AS usage_count FROM (SELECT w.word, m.*, row_number() OVER (PARTITION BY w.word ORDER BY m.usage_count DESC, m.mapping_id) AS rn FROM w JOIN V_vm m ON contains(lower(m.natural_value), lower(w.word))) AS x WHERE rn <= 10""",
)
def find_value_mapping(b: Bound):
    words = b.part.selectExpr("substring(p_name, 2, 4) AS word")
    return usage.find_value_mapping(b.V_vm, words).select("word", "mapping_id", "natural_value", "usage_count")
