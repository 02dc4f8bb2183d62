"""Best-two-fit packing of token sequences.

Every document becomes its token ids and an end id; only documents longer than a
sequence are cut, so that all pieces but the first are full.  Packing needs the
lengths alone, and there are at most ``size`` different ones: the plan is made on
the histogram of lengths, whose size is fixed, and a step fixes a pattern of lengths
and how often it is used.  A pattern is filled greedily with the longest piece that
still fits; then its smallest piece gives way to two pieces that fill the larger gap
more tightly, if there are any.

Pieces are then numbered within their length, in slices so that a common length is
not one task, and each looks up its sequence by (length, number).

Defined results: a null or empty text is one piece of the end id alone; repeated rows
are packed each; ties of length are taken by id, then by content; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm import kernel, pieces

SIZE = 1024
END = 2
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, id_col: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece, with its ids on request."""

    def cut(batches):
        encoder = pieces.encoder(tokenizer)
        for b in batches:
            for i, j, ids, bounds in encoder.encode(b.column(1)):
                ids, bounds = pieces.with_end(ids, bounds, end)
                length = np.diff(bounds)
                count = -(-length // size)
                head = length - (count - 1) * size
                doc = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(piece > 0, head[doc] + (piece - 1) * size, 0)
                held = np.where(piece > 0, size, head[doc])
                data = ids.astype("<u4").tobytes()
                first = (bounds[doc] + start) * 4
                parts = [data[p : p + n] for p, n in zip(first.tolist(), (held * 4).tolist(), strict=True)]
                columns = [b.column(0).slice(i, j - i).take(kernel.pa.array(doc)), piece.astype(np.int32), start, held, np.fromiter(map(zlib.crc32, parts), np.int64, len(parts))]
                yield kernel.batch("doc_id piece start length ids_crc32" + " ids" * keep_ids, *columns, *[kernel.blobs(parts)] * keep_ids)
            kernel.trim()

    def run(batches):
        try:
            yield from cut(batches)
        finally:
            kernel.let_go("pieces")

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, _SCHEMA + ", ids binary" * keep_ids)


@dataclass
class Plan:
    """Rows sorted by (length, first): numbers ``first..`` of a length go to sequences from
    ``base`` on, ``times`` in each, the first of them at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    base: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            lo, hi = np.searchsorted(self.length, [n, n + 1])
            own = length == n
            at[own] = lo + np.searchsorted(self.first[lo:hi], number[own], "right") - 1
        rest = number - self.first[at]
        return self.base[at] + rest // self.times[at], self.offset[at] + rest % self.times[at] * length


def _two(free: np.ndarray, gap: int, over: int) -> tuple[int, int] | None:
    """Two available lengths with the greatest sum in (over, gap]."""
    have = free > 0
    for total in range(gap, over, -1):
        small = np.arange(1, total // 2 + 1)
        ok = have[small] & have[total - small]
        if total % 2 == 0 and len(ok):
            ok[-1] = free[total // 2] >= 2
        if ok.any():
            a = int(small[np.argmax(ok)])
            return a, total - a
    return None


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Patterns for all pieces of a histogram of lengths."""
    left = np.zeros(size + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    rows, used, base = [], np.zeros(size + 1, np.int64), 0
    while left.any():
        free, gap, chosen = left.copy(), size, []

        def take(n: int, free=free, chosen=chosen) -> int:
            free[n] -= 1
            chosen.append(n)
            return n

        while gap and (fit := np.flatnonzero(free[: gap + 1])).size:
            gap -= take(int(fit[-1]))
        while gap and len(chosen) > 1:
            small = min(chosen)
            pair = _two(free, gap + small, small)
            if pair is None:
                break
            chosen.remove(small)
            free[small] += 1
            gap += small - take(pair[0]) - take(pair[1])
        lengths, times = np.unique(chosen, return_counts=True)
        repeat = int((left[lengths] // times).min())
        offset = 0
        for n, t in zip(lengths[::-1].tolist(), times[::-1].tolist(), strict=True):
            rows.append((n, used[n], base, t, offset))
            offset += n * t
            used[n] += t * repeat
            left[n] -= t * repeat
        base += repeat
    rows.sort()
    columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)] if rows else [np.empty(0, np.int64)] * 5
    return Plan(*columns, sequences=base)


def numbered(rows: DataFrame, by: str, order: list[str], slices: int) -> DataFrame:
    """``rows`` with ``number``: 0, 1, .. within ``by``, counted in ``slices`` slices of each."""
    window = Window.partitionBy(by, "slice").orderBy(*order)
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    counts = sliced.groupBy(by, "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(by).orderBy("slice")) - F.col("n")
    offsets = counts.select(by, "slice", before.alias("before"))
    local = sliced.withColumn("local", F.row_number().over(window) - 1)
    return local.join(offsets, [by, "slice"]).withColumn("number", F.col("before") + F.col("local")).drop("slice", "before", "local")


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``cut_pieces``, which must be stored:
    it is read twice and both readings must agree."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = plan(histogram, size)
    slices = max(64, max(histogram.values(), default=0) // 50_000 + 1)
    names = parts.columns

    def run(batches):
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            sequence, offset = made.place(length, number)
            yield kernel.batch([*names, "sequence_id", "offset"], *[b.column(n) for n in names], sequence, offset)

    schema = parts.schema.add("sequence_id", "long").add("offset", "long")
    order = [n for n in ("doc_id", "piece", "ids_crc32") if n in names]
    return numbered(parts, "length", order, slices).mapInArrow(run, schema)
