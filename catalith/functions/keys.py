"""Business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import blank, col, or_default, strip_ws


def query_id(db: str | Column, question: str | Column) -> Column:
    """First 12 hex digits of the md5 of ``db:question``."""
    return F.substring(F.md5(F.concat(blank(db), F.lit(":"), strip_ws(blank(question)))), 1, 12)


def joined(*parts: str | Column, sep: str = ".") -> Column:
    """Parts joined with ``sep``; a NULL part stays as an empty segment."""
    out = [blank(parts[0])]
    for part in parts[1:]:
        out += [F.lit(sep), blank(part)]
    return F.concat(*out)


def column_fqn(label, schema, table, column) -> Column:
    return joined(label, schema, table, column)


def usage_fqn(schema, table, name) -> Column:
    return joined(or_default(schema, "public"), table, name)


def database_vertex(label) -> Column:
    return F.concat(F.lit("meta_ingest:D:"), blank(label))


def table_vertex(label, schema, table) -> Column:
    return F.concat(F.lit("meta_ingest:T:"), joined(label, schema, table, sep=":"))


def column_vertex(label, schema, table, column) -> Column:
    return F.concat(F.lit("meta_ingest:C:"), joined(label, schema, table, column, sep=":"))


def node_key(mode: str, datasource, schema, table) -> Column:
    return F.concat(F.lit(mode + ":"), joined(blank(datasource), or_default(schema, "public"), col(table), sep=":"))
