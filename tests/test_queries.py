"""Registered queries against their DuckDB text; CATALITH_ALL=1 runs every one."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bindings.views import TABLES, VIEWS, view
from check import rows_of

FOLDER = "/root/testdata/sf0.001"
SOME = (
    "vec_topk",
    "vec_fusion",
    "subschema",
    "anchor_columns",
    "fk_relations_fill",
    "related_tables_scored",
    "value_mapping",
    "merge_ddl",
    "usage_rebuild",
    "graph_causal_paths",
    "physical_graph",
    "recon_summary",
    "query_log_fold_sliced",
    "stream_query_log_fold",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


ALL = bool(os.environ.get("CATALITH_ALL"))


@pytest.mark.parametrize("name", list(entry.queries()) if ALL else SOME)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert got
        return
    cur = con.execute(oracle)
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())


def test_views_agree(spark, con):
    for name, text in VIEWS.items():
        if name != "V_emb":
            df = view(spark, FOLDER, name)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            cur = con.execute(text)
            assert got == rows_of([d[0] for d in cur.description], cur.fetchall()), name


def test_no_nested_loops_or_row_udfs(spark):
    some = ("anchor_columns", "match_alias", "fk_neighbors_any", "related_tables", "value_mapping", "table_importance", "vec_topk", "replace_scope")
    for name in entry.queries() if ALL else some:
        if name == "pipeline" or name.startswith(("op", "stream_")):
            continue  # their plans are made job by job
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "BatchEvalPython" not in plan, name


def test_entry(spark):
    assert entry.entry(spark).count() == 10
