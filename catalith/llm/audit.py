"""Interaction of corpus filters over all orders in which they could run.

Every document gets a mask of the filters that it fails.  Documents of one part with one
mask share their fate, so the corpus folds to at most ``2**k`` weighted rows a part.  With
0 for a failed filter and infinity for a passed one, these rows are a mask matrix; the
position of every filter in every order is the inverse-permutation matrix.  The min-plus
product of the two is the step at which an order removes a document, and scattering the
weights over (order, step) gives what is removed, kept, redundant and lost.

Copies are found over the whole table by the SHA-256 of the text: the least id of a digest
is folded before the shuffle, and whether a document is that one is asked by (digest, id),
so a large group of copies spreads over all tasks.

Defined results: a null text is empty, has no words, and is a copy of other empty texts; a
null part is the empty string; a document without an id neither has earlier copies nor is
one; documents with the least id of a text are all first; repeated rows count each; a
document is good or toxic if any of its label rows says 1, and neither without one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel

NAMES = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> list[Column]:
    """Failure conditions A to D on a text that is not null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.length(text)
    capitals = chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < 100, distinct.cast("long") * 100 < n.cast("long") * 80, capitals.cast("long") * 100 > chars.cast("long") * 10, text.rlike("[#$%&*|]")]


def bits(failures: Sequence[Column]) -> Column:
    """The failed filters as one number; the first filter is bit 0."""
    total = F.lit(0)
    for at, failed in enumerate(failures):
        total = total + F.when(failed, 1 << at).otherwise(0)
    return total


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every document, copies of smaller ids included."""
    own = kernel.narrow(docs, doc_id=(id_col, "long"), text=(text_col, "string"), part=(part_col, "string"))
    full = own.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = full.select("doc_id", "part", bits(text_failures(F.col("text"))).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = kernel.stored(rows, "masks")
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def weighted(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, good and toxic ones with each mask."""
    marks = kernel.narrow(labels, doc_id=("doc_id", "long"), quality=("quality", "int"), toxic=("toxic", "int"))
    known = marks.groupBy("doc_id").agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    one = F.count(F.lit(1)).alias("n")
    return masked.join(known, "doc_id", "left").groupBy("part", "mask").agg(one, F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def orders_of(k: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of ``k`` filters, and the position (from 1) of every filter in each."""
    order = np.array(list(permutations(range(k))), np.int64).reshape(-1, k)
    return order, np.argsort(order, axis=1) + 1


def removal_steps(failed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Min-plus product: the first step at which a row's failed filter runs, or k + 1."""
    never = failed.shape[1] + 1
    cost = np.where(failed, 0, never)
    out = np.full((len(failed), len(place)), never, np.int64)
    for f in range(failed.shape[1]):
        np.minimum(out, cost[:, f, None] + place[None, :, f], out=out)
    return out


def interactions(mask: np.ndarray, weights: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Counts by (order, step) of one part; ``weights`` has the columns n, good, toxic."""
    order, place = orders_of(k)
    failed = (mask[:, None] >> np.arange(k)) & 1 > 0
    step = removal_steps(failed, place)
    at = np.broadcast_to(np.arange(len(order)), step.shape)
    lost = np.zeros((3, len(order), k + 2), np.int64)
    for i in range(3):
        np.add.at(lost[i], (at, step), np.broadcast_to(weights[:, i, None], step.shape))
    removed, good, toxic = lost[:, :, 1 : k + 1]
    n = weights[:, 0]
    fails = (failed * n[:, None]).sum(axis=0)
    alone = np.array([n[mask == 1 << f].sum() for f in range(k)], np.int64)
    by_filter = np.take_along_axis(removed, place - 1, axis=1).sum(axis=0)
    return {
        "kept": n.sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[order] - removed,
        "unique_fails": alone[order],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": by_filter[order],
    }


def audit(rows: DataFrame, names: str = NAMES) -> DataFrame:
    """The counts of every (part, filter_order, step) from weighted masks.

    A part gathers at most ``2**len(names)`` rows, one for each mask.
    """
    k = len(names)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches):
        order, _ = orders_of(k)
        spelled = ["".join(names[f] for f in o) for o in order]
        for b in batches:
            for part, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                mask = np.array([r["mask"] for r in held], np.int64)
                found = interactions(mask, np.array([[r["n"], r["good"], r["toxic"]] for r in held], np.int64), k)
                size = len(order) * k
                columns = [pa.array([part] * size), pa.array([s for s in spelled for _ in range(k)]), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(order)))]
                yield kernel.batch(["part", "filter_order", "step", *COUNTS], *columns, *[found[c].ravel() for c in COUNTS])

    folded = rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return folded.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held")).mapInArrow(run, schema)
