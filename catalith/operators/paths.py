"""Bounded path search with unrolled joins.

Each level is one equi-join of a frontier with the edges.  Shortest paths are searched
from both ends, or from the one with far fewer ids, and keep one path per (start, node)
or (end, node); enumeration keeps every path, as asked, up to the required depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.operators.graph import node_enrich
from catalith.plans.lineage_cut import cut, stored
from catalith.plans.ranking import top_per_group

# Fixed values.
MAX_DEPTH = 5
PATH_LIMIT = 50
# Path searches go from one side alone where it has this many times fewer ids.
FEWER = 16


def shortest_paths(edges: DataFrame, pairs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """First depth at which each pair is connected, with the smallest path.

    ``pairs(start, end)``; returns ``(start, end, found, depth, path)``.  A start
    equal to its end is found through a self loop or a cycle.

    The search goes from both ends and meets in a node: ``_forward`` says how many of the
    ``depth`` edges of a walk come from the start, the others come to the end.  A level
    keeps the smallest path for each (start, node) or (end, node).  At the first depth of a
    pair all walks are shortest paths, and the smallest of them is put together from
    smallest halves.  Edges are shuffled once by each end, and all levels read that; equal
    edges fall together where a level keeps its smallest path.  The pairs are stored.
    """
    hops = edges.select("src", "dst")
    wanted = stored(pairs.select("start", "end").distinct(), "pairs")
    forward = _forward(wanted, max_depth)
    ahead = [wanted.select("start", F.col("start").alias("node"), F.array("start").alias("path")).distinct()]
    back = [wanted.select("end", F.col("end").alias("node"), F.array("end").alias("rest")).distinct()]
    for _ in range(max(forward)):
        grown = ahead[-1].join(hops, F.col("node") == F.col("src"))
        ahead.append(grown.groupBy("start", F.col("dst").alias("node")).agg(F.min(F.array_append("path", F.col("dst"))).alias("path")))
    for _ in range(max(depth - n for depth, n in enumerate(forward, 1))):
        grown = back[-1].join(hops, F.col("node") == F.col("dst"))
        back.append(grown.groupBy("end", F.col("src").alias("node")).agg(F.min(F.array_prepend("rest", F.col("src"))).alias("rest")))
    met = None
    for depth, n in enumerate(forward, 1):
        half = ahead[n].join(wanted, "start").join(back[depth - n], ["end", "node"])
        path = F.concat("path", F.slice("rest", F.lit(2), F.greatest(F.size("rest") - 1, F.lit(0))))
        rows = half.select("start", "end", F.lit(depth).alias("depth"), path.alias("path"))
        met = rows if met is None else met.unionByName(rows)
    first = met.groupBy("start", "end").agg(F.min(F.struct("depth", "path")).alias("first"))
    out = wanted.join(first, ["start", "end"], "left")
    return out.select("start", "end", F.col("first").isNotNull().alias("found"), F.col("first.depth").alias("depth"), F.col("first.path").alias("path"))


def _forward(wanted: DataFrame, max_depth: int) -> list[int]:
    """How many edges of a walk are searched from its start, for each depth from 1 on.

    A level has at most one row for each node and each start (or end), so where one side
    has far fewer ids than the other all edges are searched from there; else half of them.
    """
    starts, ends = wanted.agg(F.count_distinct("start"), F.count_distinct("end")).first()
    if ends * FEWER <= starts:
        return [0] * max_depth
    if starts * FEWER <= ends:
        return list(range(1, max_depth + 1))
    return [(depth + 1) // 2 for depth in range(1, max_depth + 1)]


def _steps(edges: DataFrame) -> DataFrame:
    """Edges with an id of their own; without ``edge_id`` equal edges are one."""
    own = F.col("edge_id") if "edge_id" in edges.columns else F.xxhash64("src", "dst", "type")
    return edges.select("src", "dst", "type", own.alias("edge"))


def reverse_paths(
    edges: DataFrame, targets: DataFrame, max_depth: int = MAX_DEPTH, limit: int | None = PATH_LIMIT
) -> DataFrame:
    """Every path of 1 to ``max_depth`` edges into the targets, no edge used twice.

    ``edges(src, dst, type)`` and ``targets(id)``; returns ``(target, depth, chain,
    relation_types)``, with ``limit`` the first rows per target by (depth, chain,
    types).  Nodes may repeat.  Only ancestors of the targets are touched.
    """
    steps = _steps(edges)
    if max_depth > 2:
        steps = cut(steps)
    asked = targets.select(F.col("id").alias("dst")).distinct()
    level = steps.join(asked, "dst", "left_semi").select(
        F.col("dst").alias("target"),
        F.col("src").alias("head"),
        F.array("src", "dst").alias("chain"),
        F.array("type").alias("relation_types"),
        F.array("edge").alias("used"),
        F.lit(1).alias("depth"),
    )
    out = level
    for depth in range(2, max_depth + 1):
        if limit is not None:
            # Shorter paths come first, so a target with enough of them is done.
            full = out.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= limit)
            level = level.join(full.select("target"), "target", "left_anti")
        grown = level.join(steps.withColumnRenamed("dst", "head"), "head").where(
            ~F.array_contains("used", F.col("edge"))
        )
        level = grown.select(
            "target",
            F.col("src").alias("head"),
            F.array_prepend("chain", F.col("src")).alias("chain"),
            F.array_prepend("relation_types", F.col("type")).alias("relation_types"),
            F.array_append("used", F.col("edge")).alias("used"),
            F.lit(depth).alias("depth"),
        )
        if limit is not None and depth < max_depth:
            level = cut(level)
        out = out.unionByName(level)
    rows = out.select("target", "depth", "chain", "relation_types")
    return rows if limit is None else _first(rows, limit)


def _first(rows: DataFrame, limit: int) -> DataFrame:
    order = [F.col("depth"), F.col("chain"), F.col("relation_types")]
    return top_per_group(rows, ["target"], order, limit)


def _closing(steps: DataFrame, max_depth: int) -> DataFrame:
    """``steps`` with ``onward``, true where an edge leads into the source, and ``again``:
    true for every edge that a walk of ``max_depth`` edges can use twice.

    Up to three edges these are loops and edges with an edge back, exactly.  Beyond, they
    are the loops and the edges left when nodes without an edge in or without an edge out
    are taken away ``max_depth`` times: every cycle is left, so none is missed, and of a
    graph without cycles only what is farther than that from both rims.  Only onward edges
    lie on a cycle, so the others are never compared.
    """
    loop = F.col("src") == F.col("dst")
    entered = steps.select(F.col("dst").alias("src")).distinct().withColumn("__in", F.lit(True))
    steps = stored(steps.join(entered, "src", "left").withColumn("onward", F.col("__in").isNotNull()).drop("__in"), "steps")
    if max_depth < 3:
        return steps.withColumn("again", loop)
    pairs = steps.where(~loop & F.col("onward")).select("src", "dst").distinct()
    if max_depth == 3:
        back = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    else:
        back = cut(pairs)
        for _ in range(max_depth):
            ahead = back.select(F.col("src").alias("dst")).distinct()
            behind = back.select(F.col("dst").alias("src")).distinct()
            back = cut(back.join(ahead, "dst", "left_semi").join(behind, "src", "left_semi"))
    marked = steps.where("onward").join(back.withColumn("__back", F.lit(True)), ["src", "dst"], "left")
    marked = marked.select("src", "dst", "type", "edge", "onward", (loop | F.col("__back").isNotNull()).alias("again"))
    return marked.unionByName(steps.where("NOT onward").withColumn("again", F.lit(False)))


def cause_heads(edges: DataFrame, targets: DataFrame, max_depth: int = 1) -> DataFrame:
    """``(target, depth, id, relation_type)`` of the first nodes and edges of all paths into the targets.

    The rows are those of ``reverse_paths`` without its chains, but no path is built: a
    level holds the distinct (target, node, used edges), and of the used edges only those
    that could come again.  Without cycles these sets are empty, so a level has at most
    one row for each target and node, however many paths lead there.
    """
    if max_depth > 1:
        steps = _closing(_steps(edges), max_depth)
    else:
        steps = _steps(edges).withColumn("onward", F.lit(False)).withColumn("again", F.lit(False))
    # other edges need no id: null is in no set
    steps = steps.select("src", "dst", "type", "onward", F.when(F.col("again"), F.col("edge")).alias("edge"))
    asked = targets.select(F.col("id").alias("dst")).distinct()
    level = steps.join(asked, "dst", "left_semi").select(
        F.col("dst").alias("target"), F.col("src").alias("id"), F.col("type").alias("relation_type"), F.array_compact(F.array("edge")).alias("used"), "onward"
    )
    out = None
    for depth in range(1, max_depth + 1):
        if depth > 1:
            states = level.where("onward").select("target", F.col("id").alias("dst"), "used").distinct()
            grown = states.join(steps, "dst").where(F.col("edge").isNull() | ~F.array_contains("used", F.col("edge")))
            kept = F.when(F.col("edge").isNotNull(), F.array_sort(F.array_append("used", F.col("edge")))).otherwise(F.col("used"))
            level = grown.select("target", F.col("src").alias("id"), F.col("type").alias("relation_type"), kept.alias("used"), "onward")
        heads = level.select("target", F.lit(depth).alias("depth"), "id", "relation_type")
        out = heads if out is None else out.unionByName(heads)
    return out.distinct()


def direct_causes(
    edges: DataFrame, nodes: DataFrame, targets: DataFrame, datasets: DataFrame, terms: DataFrame, max_depth: int = 1
) -> DataFrame:
    """Source nodes of every path into the targets, with depth, edge type and catalog entries.

    ``nodes`` carries ``data_source``.
    """
    heads = cause_heads(edges, targets, max_depth)
    return heads.join(node_enrich(nodes, datasets, terms), "id")
