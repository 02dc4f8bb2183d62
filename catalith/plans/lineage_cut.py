"""Cutting long lineage with reliable checkpoints, or with Parquet in the same folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder named by ``spark.checkpoint.dir``.

    Only a session without that setting and with a local master gets a folder of
    its own; on a cluster the setting is required, because a machine-local folder
    would be lost with its executor.
    """
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet beside the checkpoints and read again.

    For a frame that is used several times: it is derived once, and every use reads
    only the columns that it needs.
    """
    path = f"{_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="catalith-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
