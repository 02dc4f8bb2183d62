"""Approximate nearest neighbours by cosine, with a vantage-point tree per shard.

Directions are points on the unit sphere, and the length of the chord between two of
them is a metric that falls as the cosine rises.  The upper levels of a vantage-point
tree, fitted on a bounded sample (``SAMPLE`` directions), split space into cells; every
distinct vector goes to its cell, and a cell is dealt into shards of about
``SHARD_ROWS`` rows.  A task builds a vantage-point tree over its shard.

A search skips a half of a node where the triangle inequality shows that it holds
nothing nearer than the best found: ``factor * gap > radius``.  ``factor`` 1 is exact; a
larger one skips more.  Queries first search the shards of their own cell, and then,
with the radius found there, those other cells that the same rule leaves.

Vectors with the same components are one point with its smallest ids, one more than
are asked for: no query can need more of them.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor does a null id; ties go to the smaller id; repeated ids
with the same vector count once; fewer candidates than asked give fewer rows; vectors
are neighbours of those of their own length only, and every length has its own search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel

K = 5
FACTOR = 1.1
SAMPLE = 4_096
SHARD_ROWS = 8_192
LEAF = 64
ASKED = 20_000
QUERY_BLOCK = 1_024


def valid_vectors(table: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, v): usable vectors as little-endian doubles, once each."""

    def run(batches):
        for b in batches:
            column = b.column(1)
            lists = column.to_pylist() if column.null_count or column.flatten().null_count else None
            if lists is None:
                offsets = column.offsets.to_numpy()
                values = column.values.to_numpy(zero_copy_only=False).astype("<f8")
                lists = [values[p:q] for p, q in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            ids, out = [], []
            for i, v in zip(b.column(0).to_pylist(), lists, strict=True):
                if i is None or v is None or not len(v) or any(x is None for x in v):
                    continue
                v = np.asarray(v, "<f8")
                if np.isfinite(v).all() and v.any():
                    ids.append(i)
                    out.append((v + 0.0).tobytes())
            yield kernel.batch("vec_id v", pa.array(ids, pa.int64()), kernel.blobs(out))

    return kernel.narrow(table, vec_id=(id_col, "long"), v=(vector, "array<double>")).mapInArrow(run, "vec_id long, v binary")


def lengths(vectors: DataFrame) -> list[int]:
    """Bytes of every vector length there is."""
    return sorted(r["n"] for r in vectors.select(F.octet_length("v").alias("n")).distinct().collect())


def points(vectors: DataFrame, keep: int) -> DataFrame:
    """(v, ids): distinct vectors with their ``keep`` smallest ids, cut in every task first."""

    def run(batches):
        held: dict[bytes, list[int]] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = held.setdefault(v, [])
                if i not in own:
                    own.append(i)
                    if len(own) > keep:
                        own.remove(max(own))
        names = list(held)
        for at in range(0, len(names), 10_000):
            part = names[at : at + 10_000]
            yield kernel.batch("v ids", kernel.blobs(part), pa.array([sorted(held[v]) for v in part], pa.list_(pa.int64())))

    cut = vectors.mapInArrow(run, "v binary, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return cut.groupBy("v").agg(ids.alias("ids"))


def directions(blobs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Tree:
    """A vantage-point tree over unit vectors; leaves hold at most ``leaf`` of them unless they are equal."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, depth: int | None = None):
        self.x, self.leaf = x, leaf
        self.leaves: list[np.ndarray] = []
        rng = np.random.default_rng(len(x))
        self.root = self._build(np.arange(len(x)), rng, depth)

    def _build(self, rows: np.ndarray, rng: np.random.Generator, depth: int | None):
        if len(rows) <= self.leaf or depth == 0:
            self.leaves.append(rows)
            return len(self.leaves) - 1
        # the candidate whose distances spread most
        picks = rng.choice(rows, min(8, len(rows)), replace=False)
        far = chords(self.x[picks], self.x[rows])
        best = int(far.std(axis=1).argmax())
        middle = float(np.median(far[best]))
        near = far[best] <= middle
        if near.all():
            near = far[best] < middle
        if not near.any() or near.all():
            self.leaves.append(rows)
            return len(self.leaves) - 1
        below = None if depth is None else depth - 1
        edge = (float(far[best][near].max()), float(far[best][~near].min()))
        return self.x[picks[best]], edge, self._build(rows[near], rng, below), self._build(rows[~near], rng, below)

    def home(self, q: np.ndarray) -> np.ndarray:
        """Leaf of every vector by the splits alone."""
        out = np.empty(len(q), np.int64)

        def walk(node, rows):
            if not len(rows):
                return
            if isinstance(node, int):
                out[rows] = node
                return
            vantage, (low, high), inside, outside = node
            near = chords(q[rows], vantage[None, :])[:, 0] <= (low + high) / 2
            walk(inside, rows[near])
            walk(outside, rows[~near])

        walk(self.root, np.arange(len(q)))
        return out

    def visit(self, q: np.ndarray, radius: np.ndarray, factor: float, at_leaf) -> None:
        """Calls ``at_leaf(leaf, query rows)``, near halves first; ``radius`` may shrink meanwhile."""

        def walk(node, rows):
            if not len(rows):
                return
            if isinstance(node, int):
                at_leaf(node, rows)
                return
            vantage, (low, high), inside, outside = node
            far = chords(q[rows], vantage[None, :])[:, 0]
            near = far <= (low + high) / 2
            walk(inside, rows[near])
            walk(outside, rows[~near])
            # the other half, where the triangle inequality leaves room
            rest = rows[~near]
            walk(inside, rest[factor * (far[~near] - low) <= radius[rest]])
            rest = rows[near]
            walk(outside, rest[factor * (high - far[near]) <= radius[rest]])

        walk(self.root, np.arange(len(q)))


def search_shard(x: np.ndarray, first_id: np.ndarray, q: np.ndarray, radius: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(points, chords) of the ``k`` nearest of a shard within ``radius`` for every query; -1 where none."""
    order = np.argsort(first_id, kind="stable")
    tree = Tree(x[order])
    best = np.full((len(q), k), np.inf)
    found = np.full((len(q), k), len(x), np.int64)
    radius = radius.copy()

    def at_leaf(leaf, rows):
        own = tree.leaves[leaf]
        far = chords(q[rows], tree.x[own])
        allfar = np.concatenate([best[rows], far], axis=1)
        allrow = np.concatenate([found[rows], np.broadcast_to(own, far.shape)], axis=1)
        pick = np.lexsort((allrow, allfar), axis=1)[:, :k]
        best[rows] = np.take_along_axis(allfar, pick, 1)
        found[rows] = np.take_along_axis(allrow, pick, 1)
        radius[rows] = np.minimum(radius[rows], best[rows, k - 1] + 1e-12)

    tree.visit(q, radius, factor, at_leaf)
    back = np.append(order, -1)
    return back[found], best


def nearest(table: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest of ``table`` for each row of ``queries``.

    ``queries`` holds ids of ``table``; a row is never its own neighbour.  ``score`` is
    the cosine of the given vectors in double precision.
    """
    usable = kernel.stored(valid_vectors(table, id_col, vector), "vectors")
    asked = usable.join(kernel.narrow(queries, vec_id=(id_col, "long")).distinct(), "vec_id", "left_semi").distinct()
    hits = None
    for size in lengths(asked):
        own = F.octet_length("v") == size
        part = _hits(usable.where(own), asked.where(own), size, k, factor)
        hits = part if hits is None else hits.union(part)
    if hits is None:
        return asked.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    named = _best(hits, k).select("query_id", F.posexplode("best"))
    return named.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.n")).alias("score"))


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query: cut by aggregation, each side holds k rows a shard."""
    best = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("far")).alias("n"), "vec_id"))), 1, k)
    return hits.groupBy("query_id").agg(best.alias("best"))


def _hits(usable: DataFrame, asked: DataFrame, size: int, k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, far) of every shard searched, for vectors of ``size`` bytes."""
    distinct = kernel.stored(points(usable, k + 1), "points")
    rows = distinct.count()
    sample = [bytes(r["v"]) for r in distinct.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()]
    schema = "query_id long, v binary, rank int, vec_id long, far double"
    shards = max(1, -(-rows // SHARD_ROWS))
    depth = max(0, min(int(np.ceil(np.log2(shards))), int(np.log2(len(sample))) - 3))
    top = Tree(directions(sample), leaf=1, depth=depth)
    cells = len(top.leaves)

    def located(batches):
        for b in batches:
            cell = top.home(directions(b.column("v").to_pylist())) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64())], names=[*b.schema.names, "cell"])

    placed = distinct.mapInArrow(located, "v binary, ids array<long>, cell long")
    full = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = np.array([max(1, -(-full.get(c, 0) // (2 * SHARD_ROWS))) for c in range(cells)])
    salted = F.pmod(F.xxhash64("v"), F.element_at(F.array(*[F.lit(int(s)) for s in salts]), (F.col("cell") + 1).cast("int"))).cast("int")
    placed = placed.withColumn("salt", salted)

    def routed(batches):
        """Shards of every query: its own cell at first, the other cells that its radius leaves later."""
        for b in batches:
            q = directions(b.column("v").to_pylist()) if b.num_rows else np.empty((0, size // 8))
            home = top.home(q) if len(q) else np.empty(0, np.int64)
            radius = b.column("radius").to_numpy(zero_copy_only=False)
            first = np.isinf(radius)
            row, cell = [np.flatnonzero(first)], [home[first]]
            later = np.flatnonzero(~first)
            if len(later):
                seen: dict[int, list[np.ndarray]] = {}
                top.visit(q[later], radius[later], factor, lambda leaf, rows: seen.setdefault(leaf, []).append(rows))
                for leaf, parts in seen.items():
                    own = later[np.unique(np.concatenate(parts))]
                    own = own[home[own] != leaf]
                    row.append(own)
                    cell.append(np.full(len(own), leaf))
            row, cell = np.concatenate(row), np.concatenate(cell)
            times = salts[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            salt = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield kernel.batch("query_id v radius cell salt", b.column("vec_id").take(pa.array(row)), b.column("v").take(pa.array(row)), radius[row], cell, pa.array(salt, pa.int32()))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "v", "rank", "vec_id", "far"]
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        x, ids = directions(left.column("v").to_pylist()), left.column("ids").to_pylist()
        first = np.array([i[0] for i in ids], np.int64)
        out: list[tuple] = []
        blobs, qids, qblobs = left.column("v").to_pylist(), right.column("query_id").to_pylist(), right.column("v").to_pylist()
        for at in range(0, len(qids), QUERY_BLOCK):
            part = slice(at, at + QUERY_BLOCK)
            q = directions(qblobs[part])
            found, far = search_shard(x, first, q, right.column("radius").to_numpy()[part], k + 1, factor)
            for n, (qid, qv) in enumerate(zip(qids[part], qblobs[part], strict=True)):
                near = [(far[n, c], i, found[n, c]) for c in range(k + 1) if found[n, c] >= 0 for i in ids[found[n, c]] if i != qid]
                for r, (d, i, p) in enumerate(sorted(near, key=lambda t: (t[0], t[1]))[:k]):
                    out.append((qid, qv, r, i, cosine(qv, blobs[p])))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names) if out else pa.table([pa.array([], t) for t in kinds], names=names)

    kind = "query_id long, v binary, radius double, cell long, salt int"

    def swept(ask: DataFrame) -> DataFrame:
        """Every shard meets the queries that reach it, at most about ``ASKED`` in one task."""
        found = kernel.cut(ask.mapInArrow(routed, kind))
        counts = found.groupBy("cell", "salt").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("blocks"))
        shard = placed.join(counts, ["cell", "salt"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")
        reached = found.join(counts, ["cell", "salt"]).withColumn("block", block).drop("blocks")
        key = ["cell", "salt", "block"]
        return shard.groupBy(*key).cogroup(reached.groupBy(*key)).applyInArrow(search, schema).drop("v", "rank")

    home_hits = kernel.cut(swept(asked.withColumn("radius", F.lit(float("inf")))))
    so_far = _best(home_hits, k).select(F.col("query_id").alias("vec_id"), F.when(F.size("best") == k, F.sqrt(F.greatest(F.lit(0.0), 2 + 2 * F.element_at("best", -1)["n"])) + 1e-9).otherwise(F.lit(2.1)).alias("radius"))
    other = asked.join(so_far, "vec_id", "left").select("vec_id", "v", F.coalesce("radius", F.lit(2.1)).alias("radius"))
    return home_hits.union(swept(other)) if cells > 1 else home_hits


def cosine(a: bytes, b: bytes) -> float:
    """Cosine of two vectors as given, in double precision."""
    x, y = np.frombuffer(a, "<f8"), np.frombuffer(b, "<f8")
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))
