"""Exact range join of embeddings by cosine, over cells around pivots.

Directions on the unit sphere have the chord as a metric, and a cosine of at least c
is a chord of at most eps = sqrt(2 - 2c).  Pivots, spread over a bounded sample by
farthest-first choice, split the vectors: the home of a vector is its nearest pivot.
A pair within eps is met in the home cell of one of its two ends, of smaller number,
so a vector is copied to a cell of smaller number wherever the triangle inequality
leaves room for a partner: its distance to that pivot is at most its distance to its
own plus 2 eps, and at most the cell's radius plus eps (and, the space being Euclidean,
it is within eps of the plane between both pivots).  Cells are joined independently.
A large cell is cut into blocks of about ``BLOCK_BYTES``, and every pair of blocks is a
task of its own, so memory is bounded whatever the skew; what one pair of blocks yields
is a count per vector and a spanning forest, never all its pairs.

Equal vectors are one point with a multiplicity.

On vectors without clusters the inequality can exclude little, and the join is then
near to comparing every pair, which exactness asks for.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors link with those of their own length only, and
every length has its own join; of several rows with one id the least vector counts; a
null id gives no row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel, vptree
from catalith.llm.components import components

COSINE = 0.9
SAMPLE = 4_096
BLOCK_BYTES = 2_000_000
MAX_PIVOTS = 1_024


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``x``, each the farthest from those before it."""
    chosen = [0]
    far = vptree.chords(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)):
        nxt = int(far.argmax())
        if far[nxt] <= 0:
            break
        chosen.append(nxt)
        far = np.minimum(far, vptree.chords(x, x[nxt : nxt + 1])[:, 0])
    return x[chosen]


def block_links(x: np.ndarray, y: np.ndarray | None, mx: np.ndarray, my: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of every row (weighted by multiplicity) within ``x``, or between ``x`` and ``y``.

    Returns the counts of ``x``, of ``y``, and a label per row of both, equal for rows
    that the links connect.
    """
    own = y is None
    other, weight = (x, mx) if own else (y, my)
    base = 0 if own else len(x)
    nx, ny = np.zeros(len(x), np.int64), np.zeros(0 if own else len(other), np.int64)
    label = np.arange(base + len(other))
    for at in range(0, len(x), 256):
        i, j = np.nonzero(x[at : at + 256] @ other.T >= least)
        i += at
        if own:
            keep = i != j
            i, j = i[keep], j[keep]
        if not len(i):
            continue
        nx += np.bincount(i, weight[j], minlength=len(x)).astype(np.int64)
        if not own:
            ny += np.bincount(j, mx[i], minlength=len(other)).astype(np.int64)
        j = j + base
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label != label[label]).any():
                label = label[label]
    return nx, ny, label


def links(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every id."""
    ids = kernel.narrow(table, vec_id=(id_col, "long")).where("vec_id IS NOT NULL").distinct()
    usable = vptree.valid_vectors(table, id_col, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    usable = kernel.stored(usable, "vectors")
    known = None
    for size in vptree.lengths(usable):
        part = _linked(usable.where(F.octet_length("v") == size), size, least)
        known = part if known is None else known.union(part)
    if known is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rows = usable.join(known, "v").select("vec_id", (F.col("n") + F.col("times") - 1).alias("n_links"), F.col("component").alias("component_id"))
    out = ids.join(rows, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _linked(usable: DataFrame, size: int, least: float) -> DataFrame:
    """(v, times, n, component) of every distinct vector, all of ``size`` bytes; ``n`` links besides its equals."""
    eps = float(np.sqrt(2 - 2 * least))
    once = kernel.stored(usable.groupBy("v").agg(F.min("vec_id").alias("point"), F.count(F.lit(1)).alias("times")), "points")
    count = once.count()
    sample = [bytes(r["v"]) for r in once.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()]
    block = max(256, BLOCK_BYTES // size)
    pivots = spread(vptree.directions(sample), min(MAX_PIVOTS, max(1, count // (2 * block))))
    between = vptree.chords(pivots, pivots)

    def near(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        far = vptree.chords(vptree.directions(blobs), pivots)
        home = far.argmin(axis=1)
        return far, home, far[np.arange(len(home)), home]

    def homes(batches):
        for b in batches:
            if b.num_rows:
                _, home, far = near(b.column(0).to_pylist())
                yield kernel.batch("cell far", pa.array(home, pa.int32()), far)

    about = once.select("v").mapInArrow(homes, "cell int, far double").groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    radius, held = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in about:
        radius[r["cell"]], held[r["cell"]] = r["radius"], r["n"]
    home_blocks = np.maximum(1, -(-held // block))

    def cells_of(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, at home) of every place where a vector is needed."""
        far, home, own = near(blobs)
        room = (far <= own[:, None] + 2 * eps + 1e-9) & (far <= radius + eps + 1e-9)
        room &= far**2 - own[:, None] ** 2 <= 2 * eps * between[home] + 1e-9
        room &= np.arange(len(pivots)) < home[:, None]
        row, cell = np.nonzero(room)
        return np.concatenate([np.arange(len(home)), row]), np.concatenate([home, cell]), np.repeat([True, False], [len(home), len(row)])

    def guests(batches):
        total = np.zeros(len(pivots), np.int64)
        for b in batches:
            if b.num_rows:
                _, cell, at_home = cells_of(b.column(0).to_pylist())
                total += np.bincount(cell[~at_home], minlength=len(pivots))
        yield kernel.batch("cell n", pa.array(np.arange(len(pivots)), pa.int32()), total)

    visits = np.zeros(len(pivots), np.int64)
    for r in once.select("v").mapInArrow(guests, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        visits[r["cell"]] = r["n"]
    guest_blocks = -(-visits // block)

    def dealt(batches):
        """Every vector once for each pair of blocks that its block belongs to."""
        for b in batches:
            if not b.num_rows:
                continue
            blobs = b.column(0).to_pylist()
            row, cell, at_home = cells_of(blobs)
            h = kernel.mix(b.column("point").to_numpy().astype(np.uint64))[row]
            nh, ng = home_blocks[cell], guest_blocks[cell]
            own = np.where(at_home, h % nh.astype(np.uint64), nh.astype(np.uint64) + h % np.maximum(ng, 1).astype(np.uint64)).astype(np.int64)
            # block pairs (x, y) with x a home block and y >= x
            left = np.where(at_home, nh + ng - own, 0)  # as x, y = own ..
            right = np.where(at_home, own, nh)  # as y, x = 0 ..
            k = np.concatenate([np.repeat(np.arange(len(row)), left), np.repeat(np.arange(len(row)), right)])
            as_x = np.repeat([True, False], [left.sum(), right.sum()])
            step = np.concatenate([kernel.ragged(own, left), kernel.ragged(np.zeros(len(row), np.int64), right)])
            x, y = np.where(as_x, own[k], step), np.where(as_x, step, own[k])
            for at in range(0, len(k), 20_000):
                part = slice(at, at + 20_000)
                take = pa.array(row[k[part]])
                yield kernel.batch("cell x y left v point times", pa.array(cell[k[part]], pa.int32()), pa.array(x[part], pa.int32()), pa.array(y[part], pa.int32()), pa.array(as_x[part]), *[b.column(c).take(take) for c in ("v", "point", "times")])

    kind = "cell int, x int, y int, left boolean, v binary, point long, times long"

    def join(t: pa.Table) -> pa.Table:
        side = t.column("left").to_numpy()
        point, times = t.column("point").to_numpy(), t.column("times").to_numpy()
        x = vptree.directions(t.column("v").to_pylist())
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        same = t.column("x")[0].as_py() == t.column("y")[0].as_py()
        if not len(a) or not (same or len(b)):
            return pa.table({"point": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "near": pa.array([], pa.int64())})
        nx, ny, label = block_links(x[a], None if same else x[b], times[a], times[b], least)
        rows = a if same else np.concatenate([a, b])
        n = nx if same else np.concatenate([nx, ny])
        keep = n > 0
        return pa.table({"point": point[rows][keep], "n": n[keep], "near": point[rows][label][keep]})

    pairs = once.mapInArrow(dealt, kind)
    found = kernel.cut(pairs.groupBy("cell", "x", "y").applyInArrow(join, "point long, n long, near long"))
    degree = found.groupBy("point").agg(F.sum("n").alias("n"))
    label = components(found.select(F.col("point").alias("a"), F.col("near").alias("b")))
    points = once.join(degree, "point", "left").join(label.withColumnRenamed("node", "point"), "point", "left")
    return kernel.stored(points.select("v", "times", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("label", "point").alias("component")), "linked")
