"""The size that may travel inside a task closure, and the number of tasks of a wide step.

Plain joins in this package carry no broadcast hints: adaptive execution turns a
join into a broadcast only after it has seen the shuffled size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest request batch whose vectors may travel inside a task closure.
MAX_CLOSURE_FLOATS = 4_000_000

# Rows of one parent that may meet in one task, where they are sorted or joined.
# Arrays of them take more memory: ``nesting.MAX_FEW``.
MAX_PARENT_ROWS = 1_000_000

# Rows of dealt frames for each task.
TASK_ROWS = 250_000

# Bytes of input files for each task of a step that sorts or hashes whole rows.
TASK_BYTES = 4 * 1024 * 1024


def task_count(*frames: DataFrame) -> int:
    """Partitions for a step over ``frames``, so that a task's share stays the same as the input grows.

    Adaptive execution merges small partitions until there is one for each core, whatever
    their rows take in memory; a number given to ``repartition`` is kept.  It follows the
    sizes of the files that the frames read, and is never below the session's own number.
    """
    spark = frames[0].sparkSession
    files = sorted({path for frame in frames for path in frame.inputFiles()})
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not files:
        return own
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return max(own, math.ceil((size or 0) / TASK_BYTES))


def parent_sizes(frame: DataFrame, parent: Sequence[str]) -> tuple[int, int]:
    """The most rows that one parent has, and a number of tasks for all rows.

    Where no parent has more than ``MAX_PARENT_ROWS``, frames can be dealt by the parent's keys
    alone (``dealt``): steps on a parent's children need no shuffle of their own then, and
    rows of a parent lie side by side, which makes what is shuffled and stored smaller.
    Else a join must spread a large parent's rows by its whole keys.
    """
    counts = frame.groupBy(*parent).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    own = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts[0] or 0, max(own, math.ceil((counts[1] or 0) / TASK_ROWS))


def dealt(frame: DataFrame, parent: Sequence[str], tasks: int) -> DataFrame:
    """``frame`` dealt by the parent's keys; small ones, with the session's own number of tasks, may be merged to fewer."""
    own = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(tasks, *parent) if tasks > own else frame.repartition(*parent)


@contextmanager
def parents_together(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside take sides that are dealt by a part of the keys as they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)
