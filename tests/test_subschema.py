"""Sub-schema queries search every column that has a vector."""

import os
from types import SimpleNamespace

import duckdb
import pytest

import __spark_entry__ as entry
from bindings import prompts
from bindings.views import TABLES
from check import rows_of

FOLDER = "/root/testdata/sf0.001"
ALL_COLUMNS = """VC AS (SELECT c.column_id AS vec_id, c.table_id, e.embedding FROM V_col c JOIN V_emb e ON e.vec_id = c.table_id
JOIN V_tab t ON t.table_id = c.table_id WHERE coalesce(t.is_valid, true) AND coalesce(c.is_valid, true)),
"""


def whole(text: str) -> str:
    """The DuckDB text over all column vectors; a registered text that cuts them (FC) has that part exchanged."""
    if "FC AS (" not in text:
        return text
    return text[: text.index("FC AS (")] + ALL_COLUMNS + text[text.index("CH AS (") :]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", ["subschema", "subschema_members", "subschema_fks"])
def test_all_columns_are_searched(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(whole(entry.oracle_sql()[name]))
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_table_with_an_invalid_lowest_column_is_found_by_the_others(spark):
    tables = [(i, "d", "s", f"t{i}", None, "", True) for i in (1, 2)]
    columns = [(10 * t + c, t, f"c{c}", "A", True, False, "", not (t == 1 and c == 0)) for t in (1, 2) for c in range(3)]
    b = SimpleNamespace(
        V_tab=spark.createDataFrame(tables, "table_id long, db string, schema_name string, name string, original_name string, description string, is_valid boolean"),
        V_col=spark.createDataFrame(columns, "column_id long, table_id long, name string, dtype string, nullable boolean, is_primary_key boolean, description string, is_valid boolean"),
        V_fk=spark.createDataFrame([(11, 20, "fk")], "from_column_id long, to_column_id long, constraint_name string"),
        V_emb=spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 1.0], 0)], "vec_id long, embedding array<float>, grp int"),
        V_req=spark.createDataFrame([(7, [1.0, 0.0])], "qid long, vector array<double>"),
    )
    hits = prompts.found(b)["columns"].orderBy("rank").collect()
    assert [(r["table_id"], r["column_id"]) for r in hits] == [(1, 11), (1, 12), (2, 20), (2, 21), (2, 22)]
