"""Registration of queries and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.views import Bound
from catalith.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_WIDE = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}


def widened(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and floats as DOUBLE, so that both engines report the same types."""
    return df.select(
        *[
            F.col(f"`{n}`").cast(_WIDE[t]).alias(n) if t in _WIDE else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def query(name: str, oracle: str | None = None):
    """Register ``fn(bound) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Bound], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return widened(fn(Bound(spark, sf)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register
