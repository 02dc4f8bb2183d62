"""Versioned parquet stores: every write is a new directory, then the pointer moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_version(df: DataFrame, root: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as ``root/v=<version>`` and record it in ``root/_versions``.

    A failed write leaves the old version current, because the record is appended
    only after the data is complete.
    """
    path = f"{root}/v={version}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    record = df.sparkSession.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(path).alias("path"))
    record.coalesce(1).write.mode("append").parquet(f"{root}/_versions")
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version."""
    newest = spark.read.parquet(f"{root}/_versions").orderBy(F.col("version").desc()).limit(1)
    return spark.read.parquet(newest.first()["path"])


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
