"""Top-n, first-per-key and frequency plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
_SALT = "__salt"
# Spark cuts a row_number filter before the shuffle up to this many rows per group
# (spark.sql.optimizer.windowGroupLimitThreshold); beyond it we cut per salt first.
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
_SALTS = 64


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group; ``order`` must be a total order.

    Every task keeps at most ``n`` rows per group before the shuffle, so a group
    holding a large part of the table never meets in one task.
    """
    threshold = int(df.sparkSession.conf.get(_GROUP_LIMIT, "1000"))
    if n > threshold:
        salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        window = Window.partitionBy(*by, _SALT).orderBy(*order)
        df = salted.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK, _SALT)
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple of every key, with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple of every key, with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def frequencies(df: DataFrame, by: Sequence[str], n: int, name: str = "cnt") -> DataFrame:
    """The ``n`` most frequent value combinations of ``by``."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), *[F.col(c).asc_nulls_last() for c in by]).limit(n)
