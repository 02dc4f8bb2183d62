"""Vectors stored by cell, for approximate search that reads only the probed cells.

``root/part=<n>/cell=<c>/`` holds the vectors of one insertion.  A part counts once its
number is in ``root/_parts``, appended after its data, so a failed write changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.operators.vector import assign_cells

SPREAD = 8


def _parts(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete parts: one for each insertion."""
    try:
        rows = spark.read.schema("part bigint").parquet(f"{root}/_parts")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["part"] for r in rows.distinct().collect())


def insert_vectors(corpus: DataFrame, centres: DataFrame, root: str, *, id_col: str = "id", vector_col: str = "embedding", spread: int = SPREAD) -> int:
    """Add vectors with new ids to the store and return the number of their part.

    A cell is written by up to ``spread`` tasks, so one that holds a third of all rows is
    not one task.  One writer at a time; the centres must be those of the earlier parts.
    """
    spark = corpus.sparkSession
    part = max(_parts(spark, root), default=-1) + 1
    celled = assign_cells(corpus, centres, id_col=id_col, vector_col=vector_col)
    placed = celled.repartition("cell", F.pmod(F.xxhash64(id_col), F.lit(spread)))
    # what a failed writer left behind is replaced
    placed.write.mode("overwrite").partitionBy("cell").parquet(f"{root}/part={part}")
    spark.range(1).select(F.lit(part).cast("bigint").alias("part")).coalesce(1).write.mode("append").parquet(f"{root}/_parts")
    return part


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    """All complete parts, with the partition columns ``part`` and ``cell``."""
    paths = [f"{root}/part={n}" for n in _parts(spark, root)]
    if not paths:
        raise ValueError(f"no vectors are stored in {root}")
    return spark.read.option("basePath", root).parquet(*paths)
