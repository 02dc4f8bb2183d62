"""Connected components of an edge table, without a collected group or a hub in one task.

First every node keeps one smaller neighbour: an edge (a, b) whose b is not the least
one, m, of a becomes (b, m), which keeps the components as they are.  When nothing is
left to move, the edges are a forest that points at the least node of each component,
and pointers are doubled until they end there.  The least neighbours are aggregated
before the shuffle and checkpointed, so that the join with the edges has two plain
shuffled sides and adaptive execution can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; label is the least node it reaches.

    Loops, repeated edges and either direction are allowed; an edge with a null end
    is passed over.
    """
    left, right = F.col(a).cast("long"), F.col(b).cast("long")
    forest = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (left != right))
    forest = kernel.cut(forest.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).distinct())
    while True:
        least = kernel.cut(forest.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        if not least.where("n > 1").take(1):
            break
        moved = forest.join(least.select("a", "m"), "a").where("b <> m")
        forest = kernel.cut(least.select("a", F.col("m").alias("b")).union(moved.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
    up = least.select(F.col("a").alias("node"), F.col("m").alias("label"))
    while True:
        above = up.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = kernel.cut(up.join(above, "label", "left").select("node", F.coalesce("next", "label").alias("label"), F.col("next").isNotNull().alias("moved")))
        up = jumped.select("node", "label")
        if not jumped.where("moved").take(1):
            break
    return up.union(up.select("label", "label").distinct())
