"""Views that give the given tables the roles of a catalog, a graph, a log and a vector store.

One text per view, valid in Spark and in DuckDB.  Every view reads whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS = {
    "V_tab": """
SELECT p_partkey AS table_id, p_brand AS db, p_type AS schema_name, concat('t', CAST(p_partkey AS STRING)) AS name,
CASE WHEN p_size < 10 THEN concat('T', CAST(p_partkey AS STRING), '_ORIG') END AS original_name,
CASE WHEN p_size BETWEEN 10 AND 14 THEN '' WHEN p_size BETWEEN 15 AND 18 THEN 'N/A' WHEN p_size BETWEEN 19 AND 22 THEN NULL ELSE p_name END AS description,
CASE WHEN p_size BETWEEN 40 AND 43 THEN false WHEN p_size BETWEEN 36 AND 39 THEN NULL ELSE true END AS is_valid FROM part""",
    "V_col": """
SELECT l_partkey * 100000 + l_suppkey AS column_id, l_partkey AS table_id, concat('c', CAST(l_suppkey AS STRING)) AS name,
CASE last_flag WHEN 82 THEN 'R' WHEN 78 THEN 'N' ELSE 'A' END AS dtype, last_line > 4 AS nullable, last_line = 7 AS is_primary_key,
CASE WHEN low_tax < 0.02 THEN NULL ELSE concat('flag ', CASE first_flag WHEN 82 THEN 'R' WHEN 78 THEN 'N' ELSE 'A' END, ' status ', CASE last_status WHEN 79 THEN 'O' ELSE 'F' END) END AS description,
CASE WHEN first_line = 7 THEN false WHEN first_line = 6 THEN NULL ELSE true END AS is_valid
FROM (SELECT l_partkey, l_suppkey, max(ascii(l_returnflag)) AS last_flag, min(ascii(l_returnflag)) AS first_flag, max(ascii(l_linestatus)) AS last_status,
max(l_linenumber) AS last_line, min(l_linenumber) AS first_line, min(l_tax) AS low_tax FROM lineitem GROUP BY l_partkey, l_suppkey) AS pairs""",
    "V_fk": """
SELECT from_column_id, to_column_id, concat('fk_', CAST(from_part AS STRING)) AS constraint_name FROM (
SELECT DISTINCT CASE WHEN status = 79 THEN lo ELSE hi END AS from_column_id, CASE WHEN status = 79 THEN hi ELSE lo END AS to_column_id, CASE WHEN status = 79 THEN lo_part ELSE hi_part END AS from_part
FROM (SELECT l_orderkey, max(ascii(l_linestatus)) AS status, min(l_partkey * 100000 + l_suppkey) AS lo, max(l_partkey * 100000 + l_suppkey) AS hi,
min(l_partkey) AS lo_part, max(l_partkey) AS hi_part FROM lineitem GROUP BY l_orderkey) AS bounds) AS links""",
    "V_query": """
SELECT o_orderkey AS query_id, concat(o_orderpriority, ' ', CAST(o_custkey AS STRING)) AS question,
CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'error' ELSE 'running' END AS status, o_totalprice AS execution_time_ms, o_orderdate AS created_at FROM orders""",
    "V_qt": "SELECT DISTINCT l_orderkey AS query_id, l_partkey AS table_id FROM lineitem",
    "V_qc": """
SELECT DISTINCT l_orderkey AS query_id, l_partkey * 100000 + l_suppkey AS column_id,
CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'FILTERS' WHEN 'AO' THEN 'GROUPS_BY' WHEN 'NF' THEN 'AGGREGATES' WHEN 'NO' THEN 'JOINS_ON' ELSE 'SELECTS' END AS usage_type FROM lineitem""",
    "V_log": """
SELECT substring(md5(concat(event_type, ':', CAST(user_id AS STRING))), 1, 12) AS query_id, event_id AS seq, ts,
CASE WHEN value < 20 THEN 'error' WHEN value < 60 THEN 'completed' ELSE 'running' END AS status,
CASE WHEN event_id % 13 <> 0 THEN event_id % 9 END AS steps_count, CASE WHEN event_id % 17 <> 0 THEN value END AS execution_time_ms,
event_id % 19 = 0 AS verified, CASE WHEN event_id % 23 = 0 THEN 'gate' ELSE '' END AS quality_gate, CASE WHEN event_id % 29 = 0 THEN props ELSE '' END AS steps_summary,
CASE WHEN event_id % 7 <> 0 THEN round(value / 100, 4) END AS context_score FROM events""",
    "V_emb": "SELECT vec_id, embedding, label AS grp FROM embeddings",
    "V_vm": """
SELECT p_partkey AS mapping_id, p_name AS natural_value, p_brand AS code_value, p_size AS usage_count, p_retailprice > 950 AS verified,
concat(p_brand, '.', p_type) AS column_fqn FROM part""",
    "V_node": """
SELECT concat('R', CAST(r_regionkey AS STRING)) AS id, 'Region' AS label, r_name AS name FROM region
UNION ALL SELECT concat('N', CAST(n_nationkey AS STRING)), 'Nation', n_name FROM nation
UNION ALL SELECT concat('S', CAST(s_suppkey AS STRING)), 'Supplier', s_name FROM supplier
UNION ALL SELECT concat('C', CAST(c_custkey AS STRING)), 'Customer', c_name FROM customer
UNION ALL SELECT concat('P', CAST(p_partkey AS STRING)), 'Part', p_name FROM part""",
    "V_edge": """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS src, concat('R', CAST(n_regionkey AS STRING)) AS dst, 'PART_OF' AS type FROM nation
UNION ALL SELECT concat('S', CAST(s_suppkey AS STRING)), concat('N', CAST(s_nationkey AS STRING)), 'LOCATED_IN' FROM supplier
UNION ALL SELECT concat('C', CAST(c_custkey AS STRING)), concat('N', CAST(c_nationkey AS STRING)), 'LOCATED_IN' FROM customer
UNION ALL SELECT DISTINCT concat('P', CAST(l_partkey AS STRING)), concat('S', CAST(l_suppkey AS STRING)), 'SUPPLIED_BY' FROM lineitem""",
    "V_lin": """
SELECT DISTINCT concat('etl', CAST(l_orderkey AS STRING)) AS proc, concat('t', CAST(l_partkey AS STRING)) AS tbl,
CASE WHEN l_returnflag = 'A' THEN 'SOURCE' ELSE 'TARGET' END AS side FROM lineitem""",
    "V_term": """
SELECT d.doc_id AS term_id, d.source AS glossary, concat(d.source, '-', CAST(d.doc_id AS STRING)) AS name, d.text AS definition, d.lang AS domain,
l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "V_cal": """
SELECT DISTINCT o_orderpriority AS calendar, CAST(o_orderdate AS DATE) AS day,
CASE WHEN o_orderstatus = 'P' THEN 'holiday' ELSE 'non_business' END AS day_type FROM orders""",
}

# Request vectors: per embedding label the mean and the component-wise maximum.
REQUESTS_DUCK = """
SELECT qid, list(m ORDER BY pos) AS vector, list(mx ORDER BY pos) AS intent_vector FROM (
SELECT label AS qid, pos, round(avg(CAST(v AS DOUBLE)), 6) AS m, CAST(max(v) AS DOUBLE) AS mx
FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) AS x GROUP BY label, pos) AS y GROUP BY qid"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    bound = re.sub(r"\b(FROM|JOIN) (" + "|".join(used) + r")\b", r"\1 {\2}", text)
    return spark.sql(bound, **{t: table(spark, sf, t) for t in used})


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request vectors of ``REQUESTS_DUCK``; arrays are as long as one embedding."""
    from pyspark.sql import functions as F

    parts = (
        table(spark, sf, "embeddings")
        .select("label", F.posexplode("embedding").alias("pos", "v"))
        .groupBy("label", "pos")
        .agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("m"), F.max("v").cast("double").alias("mx"))
    )
    rows = F.array_sort(F.collect_list(F.struct("pos", "m", "mx")))
    nested = parts.groupBy(F.col("label").alias("qid")).agg(rows.alias("r"))
    return nested.select("qid", F.col("r.m").alias("vector"), F.col("r.mx").alias("intent_vector"))


def duck(*names: str) -> str:
    """``WITH`` clause of the named views for the DuckDB text."""
    parts = [f"{n} AS ({REQUESTS_DUCK if n == 'V_req' else VIEWS[n]})" for n in names]
    return "WITH " + ", ".join(parts) + " "


class Bound:
    """One session and folder; ``b.V_tab`` is the view, ``b.part`` the table."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return view(self.spark, self.sf, name)
        if name == "V_req":
            return requests(self.spark, self.sf)
        if name in TABLES:
            return table(self.spark, self.sf, name)
        raise AttributeError(name)
