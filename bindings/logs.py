"""Bindings of the query-log fold, batch and streaming (M14, L1, L2)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import functions as F

from bindings.registry import query
from bindings.views import VIEWS, Bound, duck
from catalith.operators import querylog
from catalith.streaming import querylog as streaming

FOLD = """WITH RECURSIVE {views}, e AS (SELECT query_id, seq, ts, status, steps_count, execution_time_ms, verified, quality_gate, steps_summary, coalesce(context_score, 0) AS score,
CASE status WHEN 'completed' THEN 0 WHEN 'error' THEN 2 ELSE 1 END AS rs, coalesce(steps_count, 1000000000) AS rn_, coalesce(execution_time_ms, 1e18) AS rt, epoch_us(ts) // 1000 AS ms,
row_number() OVER (PARTITION BY query_id ORDER BY epoch_us(ts) // 1000, seq) AS i FROM V_log),
f AS (SELECT query_id, i, seq AS core, rs, rn_, rt, ms, verified AS v, quality_gate <> '' AS g, steps_summary <> '' AS s, seq AS ctx, score AS cs, ms AS cm FROM e WHERE i = 1
UNION ALL SELECT query_id, i, CASE WHEN o THEN seq ELSE core END, CASE WHEN o THEN ers ELSE rs END, CASE WHEN o THEN ern ELSE rn_ END, CASE WHEN o THEN ert ELSE rt END, CASE WHEN o THEN ems ELSE ms END, CASE WHEN o THEN ev ELSE v END, CASE WHEN o THEN eg ELSE g END, CASE WHEN o THEN es ELSE s END,
CASE WHEN x THEN seq ELSE ctx END, CASE WHEN x THEN score ELSE cs END, CASE WHEN x THEN ems ELSE cm END
FROM (SELECT f.*, e.i AS ei, e.seq, e.score, e.rs AS ers, e.rn_ AS ern, e.rt AS ert, e.ms AS ems, e.verified AS ev, e.quality_gate <> '' AS eg, e.steps_summary <> '' AS es,
e.rs < f.rs OR (e.rs = f.rs AND (e.rn_ < f.rn_ OR (e.rn_ = f.rn_ AND (e.rt < f.rt OR (e.rt = f.rt AND e.ms > f.ms))))) OR (e.verified AND NOT f.v) OR (e.quality_gate <> '' AND NOT f.g) OR (e.steps_summary <> '' AND NOT f.s) AS o,
e.score > f.cs + 1e-6 OR (e.score >= f.cs AND e.ms > f.cm) AS x FROM f JOIN e ON e.query_id = f.query_id AND e.i = f.i + 1) AS j (query_id, i0, core, rs, rn_, rt, ms, v, g, s, ctx, cs, cm, i, seq, score, ers, ern, ert, ems, ev, eg, es, o, x)),
l AS (SELECT query_id, max(i) AS n, min(ms) AS created_ms, max(ms) AS last_seen_ms FROM e GROUP BY query_id)
SELECT l.query_id, f.core AS core_seq, f.ctx AS context_seq, round(f.cs, 6) AS context_score, c.status, CAST(c.steps_count AS BIGINT) AS steps_count, c.execution_time_ms, c.verified, c.quality_gate, c.steps_summary, l.n AS seen_count, l.created_ms, l.last_seen_ms
FROM l JOIN f ON f.query_id = l.query_id AND f.i = l.n JOIN e c ON c.query_id = f.query_id AND c.seq = f.core"""
FOLD_SQL = FOLD.format(views=duck("V_log")[5:])


def shown(df):
    return df.select(
        "query_id",
        F.col("core.seq").alias("core_seq"),
        F.col("context.seq").alias("context_seq"),
        F.round("context.score", 6).alias("context_score"),
        *querylog.CORE,
        "seen_count",
        "created_ms",
        "last_seen_ms",
    )


@query("query_log_fold", FOLD_SQL)
def query_log_fold(b: Bound):
    return shown(querylog.query_log_fold(b.V_log))


@query("query_log_fold_sliced", FOLD_SQL)
def query_log_fold_sliced(b: Bound):
    """The path for long queries, on every query with more than four events."""
    return shown(querylog.query_log_fold(b.V_log, max_events=4))


@query("query_log_fold_resumed", FOLD_SQL)
def query_log_fold_resumed(b: Bound):
    """The log folded in two parts, the second starting from the first's result."""
    half = "ts < TIMESTAMP '2024-01-15 00:00:00'"
    first = querylog.query_log_fold(b.V_log.where(half))
    return shown(querylog.query_log_fold(b.V_log.where(f"NOT ({half})"), first, max_events=8))


FULL_SQL = FOLD_SQL.replace(
    "l AS (SELECT query_id, max(i) AS n,", "l AS (SELECT query_id, max(i) AS n, min_by(seq, i) AS first_seq,"
).replace(
    "c.steps_summary, l.n",
    """coalesce(c.steps_summary, '') AS steps_summary, concat('select ', c.seq) AS sql_text, CASE WHEN c.seq % 3 > 0 THEN c.seq % 100 END AS row_count, concat('why ', l.first_seq) AS question,
CASE WHEN c.seq % 4 > 0 THEN concat('v', c.seq) ELSE '' END AS terms, CAST(CASE WHEN c.seq % 4 > 0 THEN 1 ELSE 0 END AS BIGINT) AS value_mappings_count, concat('f', f.ctx) AS context_features, l.n""",
)


def detailed(events):
    """Log events with the fields of a whole stored row."""
    return events.withColumns(
        {
            "sql_text": F.concat(F.lit("select "), "seq"),
            "row_count": F.expr("CASE WHEN seq % 3 > 0 THEN seq % 100 END"),
            "question": F.concat(F.lit("why "), "seq"),
            "value_mappings": F.expr("CASE WHEN seq % 4 > 0 THEN array(named_struct('natural_value', concat('v', seq))) END"),
            "context_features": F.concat(F.lit("f"), "seq"),
        }
    )


def shown_in_full(df):
    extra = ["sql_text", "row_count", "question", "value_mappings_count", "context_features"]
    wide = df.select("query_id", *extra, F.array_join("value_mapping_terms", ",").alias("terms"))
    return shown(df).join(wide, "query_id")


@query("query_log_fold_full", FULL_SQL)
def query_log_fold_full(b: Bound):
    """Whole stored rows, the log delivered in part twice."""
    events = detailed(b.V_log)
    return shown_in_full(querylog.query_log_fold(events.union(events.where("seq % 5 = 0"))))


@query("query_log_fold_full_resumed", FULL_SQL)
def query_log_fold_full_resumed(b: Bound):
    half = "ts < TIMESTAMP '2024-01-15 00:00:00'"
    events = detailed(b.V_log)
    first = querylog.query_log_fold(events.where(half))
    return shown_in_full(querylog.query_log_fold(events.where(f"NOT ({half})"), first))


def scratch(b: Bound) -> str:
    """A new folder under the cluster's shared checkpoint folder; local sessions get a temporary one."""
    root = b.spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not b.spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        return tempfile.mkdtemp(prefix="catalith-stream-")  # tests only
    return os.path.join(root, f"stream-{uuid.uuid4().hex}")


def parted(b: Bound, table: str, part: str, root: str):
    """A stream of ``table`` cut by the expression ``part``, each part written in parallel.

    The greatest part is written first and comes again at the end, so the stream is out
    of order and delivers events twice.
    """
    rows = getattr(b, table)
    numbered = rows.withColumn("part", F.expr(part))
    for at, k in enumerate((3, 2, 1, 0, 3)):
        numbered.where(F.col("part") == k).drop("part").write.parquet(f"{root}/{table}/{at}")
    files = b.spark.read.parquet(*[f"{root}/{table}/{at}" for at in range(5)]).inputFiles()
    return streaming.read_event_files(b.spark, f"{root}/{table}", rows.schema, "*.parquet", max_files=max(1, -(-len(files) // 5)))


@query("stream_query_log_fold", FOLD_SQL)
def stream_query_log_fold(b: Bound):
    """The log in four parts, newest first, one of them twice, one part per trigger."""
    root = scratch(b)
    week = "least(3, CAST(floor((dayofmonth(ts) - 1) / 8) AS INT))"
    events = b.spark.sql(VIEWS["V_log"].replace("FROM events", "FROM {events}"), events=parted(b, "events", week, root))
    streaming.start_fold(events, f"{root}/checkpoint", available_now=True).awaitTermination()
    return shown(streaming.read_folded(b.spark, f"{root}/checkpoint", streaming.folded_schema(b.V_log)))


@query(
    "stream_table_usage",
    duck("V_qt", "V_query")
    + "SELECT qt.table_id, count(*) AS usage_count FROM V_qt qt JOIN V_query q ON q.query_id = qt.query_id WHERE q.status = 'completed' GROUP BY qt.table_id",
)
def stream_table_usage(b: Bound):
    """Uses in four parts, one of them twice, one part per trigger."""
    root = scratch(b)
    lines = parted(b, "lineitem", "CAST(l_orderkey % 4 AS INT)", root).selectExpr("l_orderkey AS query_id", "l_partkey AS table_id")
    uses = lines.join(b.V_query.select("query_id", "status"), "query_id")
    streaming.start_usage_counts(uses, f"{root}/checkpoint", available_now=True).awaitTermination()
    return streaming.read_counts(b.spark, f"{root}/checkpoint")
