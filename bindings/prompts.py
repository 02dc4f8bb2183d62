"""Binding of the sub-schema search and its prompt text (V10, K15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalogs import CAT, EDGES
from bindings.registry import query
from bindings.vectors import ranked
from bindings.views import Bound, duck
from catalith.operators import subschema as S

HITS = (
    EDGES
    + f""", VT AS (SELECT e.* FROM V_emb e JOIN V_tab t ON t.table_id = e.vec_id WHERE coalesce(t.is_valid, true)),
TH AS (SELECT qid, vec_id AS table_id, rank FROM ({ranked(5, 'VT e, V_req r')}) AS x),
VC AS (SELECT c.column_id AS vec_id, c.table_id, e.embedding FROM V_col c JOIN V_emb e ON e.vec_id = c.table_id JOIN V_tab t ON t.table_id = c.table_id WHERE coalesce(t.is_valid, true) AND coalesce(c.is_valid, true)),
CH AS (SELECT qid, table_id FROM ({ranked(10, 'VC e, V_req r', extra=', e.table_id')}) AS x),
MB AS (SELECT qid, table_id FROM TH UNION SELECT qid, table_id FROM CH),
H AS (SELECT TH.qid, TH.rank, t.table_id, t.schema_name, coalesce(t.original_name, t.name) AS table_name, t.description FROM TH JOIN V_tab t ON t.table_id = TH.table_id),
OC AS (SELECT TH.qid, TH.rank, c.name, c.dtype, c.nullable, c.description FROM TH JOIN V_col c ON c.table_id = TH.table_id),
FK AS (SELECT m.qid, concat(from_schema, '.', from_table) AS f, from_column, concat(to_schema, '.', to_table) AS t, to_column FROM E JOIN MB m ON m.table_id = E.from_table_id JOIN MB n ON n.table_id = E.to_table_id AND n.qid = m.qid),
L AS (SELECT DISTINCT qid, 0 AS section, 0 AS place, 0 AS kind, '' AS key, '=== Available Tables ===' AS line FROM H
UNION ALL SELECT qid, 1, rank, 0, '', chr(10) || 'Table: ' || schema_name || '.' || table_name FROM H
UNION ALL SELECT qid, 1, rank, 1, '', '  Description: ' || description FROM H WHERE description <> ''
UNION ALL SELECT DISTINCT qid, 1, rank, 2, '', '  Columns:' FROM OC
UNION ALL SELECT qid, 1, rank, 3, name, '    - ' || name || ' (' || dtype || ', ' || CASE WHEN nullable THEN 'NULL' ELSE 'NOT NULL' END || ')' || CASE WHEN description <> '' THEN ' - ' || description ELSE '' END FROM OC
UNION ALL SELECT DISTINCT qid, 2, 0, 0, '', chr(10) || '=== Foreign Key Relationships ===' FROM FK
UNION ALL SELECT qid, 2, 0, 1, concat_ws(chr(1), f, from_column, t, to_column), '  ' || f || '.' || from_column || ' -> ' || t || '.' || to_column FROM FK
UNION ALL SELECT DISTINCT qid, 3, 0, 0, '', chr(10) || '=== Suggested Joins ===' FROM FK
UNION ALL SELECT qid, 3, 0, 1, concat_ws(chr(1), f, from_column, t, to_column), '  JOIN ' || t || ' ON ' || f || '.' || from_column || ' = ' || t || '.' || to_column FROM FK) """
)
VIEWS = duck("V_emb", "V_req", *CAT)


def found(b: Bound):
    tables = b.V_emb.select(F.col("vec_id").alias("table_id"), "embedding")
    columns = b.V_col.select("column_id", "table_id", "is_valid").join(tables, "table_id")
    return S.build_subschema(b.V_tab, b.V_col, b.V_fk, tables, columns, b.V_req)


@query(
    "subschema",
    VIEWS
    + HITS
    + "SELECT CAST(qid AS BIGINT) AS request_id, CAST(0 AS BIGINT) AS part, string_agg(line, chr(10) ORDER BY section, place, kind, key, line) AS prompt FROM L GROUP BY qid",
)
def subschema(b: Bound):
    return S.prompt_text(found(b))


@query("subschema_members", VIEWS + HITS + "SELECT CAST(qid AS BIGINT) AS request_id, table_id FROM MB")
def subschema_members(b: Bound):
    return found(b)["members"]


@query(
    "subschema_fks",
    VIEWS + HITS + "SELECT CAST(qid AS BIGINT) AS request_id, concat('JOIN ', t, ' ON ', f, '.', from_column, ' = ', t, '.', to_column) AS hint FROM FK",
)
def subschema_fks(b: Bound):
    return found(b)["fks"].select("request_id", "hint")
