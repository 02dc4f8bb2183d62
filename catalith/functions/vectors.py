"""Vector expressions and the Arrow kernel behind the similarity scans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import col

# Similarities are compared after rounding to this many decimals, so that equal
# vectors tie exactly whatever block they were multiplied in.
DECIMALS = 12


def parse_vector(c: str | Column) -> Column:
    """``[a,b,..]`` text to an array; NULL when malformed."""
    return F.from_json(col(c), "array<float>")


def format_vector(c: str | Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(col(c), lambda x: x.cast("string")), ","), F.lit("]"))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity of two arrays in double; NULL for zero or missing vectors."""
    x, y = col(a).cast("array<double>"), col(b).cast("array<double>")

    def dot(p: Column, q: Column) -> Column:
        return F.aggregate(F.zip_with(p, q, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)

    return F.round(F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))), DECIMALS)


@dataclass(frozen=True)
class Requests:
    """A bounded block of request vectors, unit length, with optional allowed groups."""

    ids: list
    unit: np.ndarray
    groups: list[set] | None


def to_matrix(array: pa.Array) -> np.ndarray:
    """List array without NULLs to a dense float64 matrix; all lists must be equally long."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    rows = len(array)
    if rows == 0:
        return np.zeros((0, 0))
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if flat.size % rows:
        raise ValueError("vectors of different length in one store")
    return flat.reshape(rows, -1)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows become NaN."""
    norm = np.sqrt(np.einsum("ij,ij->i", m, m))
    norm[norm == 0.0] = np.nan
    return m / norm[:, None] if m.size else m


def similarities(requests: Requests, corpus: np.ndarray, groups: list | None) -> np.ndarray:
    """Rounded similarity per (request, row); -inf where the pair may not match.

    With groups only the rows of a request's own groups are multiplied with it.
    """
    unit = unit_rows(corpus)
    if requests.groups is None or groups is None:
        sims = np.round(requests.unit @ unit.T, DECIMALS)
    else:
        sims = np.full((requests.unit.shape[0], unit.shape[0]), -np.inf)
        values, code = np.unique(np.asarray(groups, dtype=object).astype(str), return_inverse=True)
        for at, value in enumerate(values):
            rows = np.flatnonzero([value in g for g in requests.groups])
            if rows.size:
                columns = np.flatnonzero(code == at)
                sims[np.ix_(rows, columns)] = np.round(requests.unit[rows] @ unit[columns].T, DECIMALS)
    sims[np.isnan(sims)] = -np.inf
    return sims


def best_pairs(sims: np.ndarray, ids: list, k: int, floor: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column positions of the ``k`` best cells per row; ties go to the lower id."""
    n = sims.shape[1]
    if n > k:
        bar = np.partition(sims, n - k, axis=1)[:, n - k][:, None]
        keep = sims >= bar
    else:
        keep = np.ones_like(sims, dtype=bool)
    keep &= np.isfinite(sims)
    if floor is not None:
        keep &= sims >= floor
    r, c = np.nonzero(keep)
    # only the ids that are left are put in order
    used, back = np.unique(c, return_inverse=True)
    order = np.lexsort((ranks_of([ids[i] for i in used])[back], -sims[r, c], r))
    r, c = r[order], c[order]
    start = np.searchsorted(r, np.arange(sims.shape[0]))
    place = np.arange(r.size) - start[r]
    return r[place < k], c[place < k]


def ranks_of(ids: list) -> np.ndarray:
    order = sorted(range(len(ids)), key=ids.__getitem__)
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    return rank


class Running:
    """Best ``k`` corpus ids per request over a stream of batches; memory is requests x k."""

    def __init__(self, requests: Requests, k: int, floor: float | None):
        self.requests, self.k, self.floor = requests, k, floor
        self.rows = np.zeros(0, dtype=np.int64)
        self.ids: list = []
        self.sims = np.zeros(0)

    def add(self, ids: list, corpus: np.ndarray, groups: list | None) -> None:
        sims = similarities(self.requests, corpus, groups)
        r, c = best_pairs(sims, ids, self.k, self.floor)
        rows = np.concatenate([self.rows, r])
        values = np.concatenate([self.sims, sims[r, c]])
        all_ids = self.ids + [ids[i] for i in c]
        order = np.lexsort((ranks_of(all_ids), -values, rows))
        rows, values = rows[order], values[order]
        place = np.arange(rows.size) - np.searchsorted(rows, rows)
        kept = place < self.k
        self.rows, self.sims = rows[kept], values[kept]
        self.ids = [all_ids[i] for i in order[kept]]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        request_ids = [self.requests.ids[i] for i in self.rows]
        arrays = [pa.array(v, type=f.type) for v, f in zip((request_ids, self.ids, self.sims), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


class RunningGroups:
    """Best ``k`` ids per (request, group) over a stream of batches, whatever their number."""

    def __init__(self, requests: Requests, k: int):
        self.requests, self.k = requests, k
        self.held: dict[object, Running] = {}

    def add(self, ids: list, groups: list, corpus: np.ndarray) -> None:
        members: dict[object, list[int]] = {}
        for i, g in enumerate(groups):
            members.setdefault(g, []).append(i)
        for g, rows in members.items():
            running = self.held.get(g)
            if running is None:
                running = self.held[g] = Running(self.requests, self.k, None)
            running.add([ids[i] for i in rows], corpus[rows], [g] * len(rows) if self.requests.groups is not None else None)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for g, running in self.held.items():
            if running.ids:
                found = ([self.requests.ids[i] for i in running.rows], [g] * len(running.ids), running.ids, running.sims)
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(found, schema, strict=True)], schema=schema)


def scan(requests: Requests, k: int, floor: float | None, schema: pa.Schema):
    """``mapInArrow`` function over ``(id, vector[, group])`` batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = Running(requests, k, floor)
        for b in batches:
            if b.num_rows:
                groups = b.column(2).to_pylist() if b.num_columns > 2 else None
                running.add(b.column(0).to_pylist(), to_matrix(b.column(1)), groups)
        if running.ids:
            yield running.batch(schema)

    return run
