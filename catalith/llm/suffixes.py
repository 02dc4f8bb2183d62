"""Exact removal of repeated passages by prefix-free parsing and suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  All strings are compared, on the input.

Parsing.  The rolling hash of every 20-gram is taken; the least one among the grams of
a window of ``LENGTH`` bytes is the window's trigger, so every window has exactly one,
and equal windows have the same, wherever they stand.  The windows of one trigger are
consecutive; the bytes that they span are its phrase.  Phrases are the dictionary,
the documents' order of phrases is the parse.

Dictionary against parse.  Equal phrases mean that all their windows are equal, so of
each distinct phrase only the first document is kept apart, and every later occurrence
is removed as a whole.  A trigger with one phrase is settled by that.

Suffix array.  Where a trigger has several phrases, they overlap in part.  Their bytes
are fetched, one occurrence of each, and all phrase suffixes that begin a window are
sorted by their first ``LENGTH`` bytes.  A run of equal ones gets the least document
of the parse, and the windows of later documents are removed.

Shuffles carry packed arrays: triggers by hash, removals by document.  A trigger with
more than ``HOT`` phrases (the edge of a passage that very many documents share) is
not one group: its windows are dealt out by a 128-bit hash of their own and compared
by it.

Defined results: a null text is empty; texts shorter than ``LENGTH`` stay; rows of the
same id don't remove from each other; a row with a null id keeps its text and removes
nothing; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel

LENGTH = 50
GRAM = 20
HOT = 1_000
FLUSH = 300_000
DOCS_PER_BUCKET = 1_000
_OTHER = 0xC2B2AE3D27D4EB4F
_TRIGGERS, _REMOVED, _WANTED, _PHRASES, _WINDOWS = range(5)
_PACKED = "kind byte, place int, data binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any lengths in one blob."""
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), ord(a.dtype.char))]], "<i8")
    # byte planes: the high bytes of most numbers are alike
    planes = [a.view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays]
    body = b"".join(planes)
    return np.array([len(body)], "<i8").tobytes() + head.tobytes() + pa.compress(body, "zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    total, n = np.frombuffer(data, "<i8", 2).tolist()
    head = np.frombuffer(data, "<i8", 2 * n, 16)
    body = pa.decompress(data[16 + 16 * n :], total, "zstd", asbytes=True) if total else b""
    at, out = 0, []
    for size, kind in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        kind = np.dtype(chr(kind))
        planes = np.frombuffer(body, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size * kind.itemsize
    return out


def _rows(kind: int, places: list[int], parts: list[bytes]) -> pa.RecordBatch:
    return kernel.batch("kind place data", pa.array([kind] * len(places), pa.int8()), pa.array(places, pa.int32()), kernel.blobs(parts))


class _Spans:
    """Removed ranges on their way to the documents' buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.held = buckets, []

    def add(self, row: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        if len(row):
            self.held.append((row, doc, start.astype(np.int64), stop.astype(np.int64)))

    def batches(self):
        if not self.held:
            return
        row, doc, start, stop = (np.concatenate(c) for c in zip(*self.held, strict=True))
        self.held.clear()
        place = row.astype(np.uint64) % np.uint64(self.buckets)
        order = np.lexsort((start, doc, row, place))
        row, doc, start, stop, place = row[order], doc[order], start[order], stop[order], place[order]
        # join ranges that touch
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (doc[1:] != doc[:-1])])
        seat = np.cumsum(new) - 1
        wide = int(stop.max()) + 1
        reach = np.maximum.accumulate(stop + seat * wide) - seat * wide
        begin = new | np.concatenate([[True], start[1:] > reach[:-1]])
        at = np.flatnonzero(begin)
        last = np.append(at[1:], len(row)) - 1
        row, doc, start, stop, place = row[at], doc[at], start[at], reach[last], place[at]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])), len(place))
        places, parts = [], []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            places.append(int(place[lo]))
            parts.append(_pack(*_by_document(row[lo:hi], doc[lo:hi]), start[lo:hi].astype(np.uint32), (stop - start)[lo:hi].astype(np.uint32)))
        for i in range(0, len(places), 2_000):
            yield _rows(_REMOVED, places[i : i + 2_000], parts[i : i + 2_000])


def _by_document(row: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, doc) and each record's place among them, in few bytes."""
    pair = np.empty(len(row), [("r", np.int64), ("d", np.int64)])
    pair["r"], pair["d"] = row, doc
    known, place = np.unique(pair, return_inverse=True)
    return np.ascontiguousarray(known["r"]), np.ascontiguousarray(known["d"]), place.astype(np.uint16 if len(known) < 65_536 else np.uint32)


def triggers(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, trigger hash, phrase hash) of every phrase."""
    n, span = len(raw), LENGTH - GRAM + 1
    empty = np.empty(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = kernel.prefix(raw)
    _, inverse = kernel.power_table(n + 1)
    gram = kernel.mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # windows within one document
    ok = np.zeros(len(at) + 1, np.int64)
    size = np.diff(bounds)
    long = size >= LENGTH
    np.add.at(ok, bounds[:-1][long], 1)
    np.add.at(ok, np.minimum(bounds[1:][long] - LENGTH + 1, len(at)), -1)
    ok = np.cumsum(ok[:-1]) > 0
    change = np.concatenate([[True], (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(at)) - 1
    keep = ok[first]
    first, last = first[keep], last[keep]
    phrase = kernel.hashes(sums, first, last + LENGTH) ^ (last - first).astype(np.uint64)
    return first, last, gram[at[first]], phrase


def _parse(texts: DataFrame, parts: int, buckets: int) -> DataFrame:
    """Triggers by part, and the ranges that repeat an earlier document of the same task."""

    def run(batches):
        held: list[tuple] = []
        spans = _Spans(buckets)

        def flush():
            row, doc, start, width, trigger, phrase = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            key = kernel.mix(trigger * np.uint64(_OTHER) + phrase)
            part = (trigger >> np.uint64(32)) % np.uint64(parts)
            order = np.lexsort((doc, key, part))
            row, doc, start, width, trigger, key, part = (x[order] for x in (row, doc, start, width, trigger, key, part))
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            first = np.repeat(doc[new], np.diff(np.append(new, len(doc))))
            later = doc > first
            spans.add(row[later], doc[later], start[later], start[later] + width[later] + LENGTH)
            row, doc, start, width, trigger, key, part = (x[~later] for x in (row, doc, start, width, trigger, key, part))
            cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
            places, blobs = [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                s = start[lo:hi].astype(np.uint32)
                places.append(int(part[lo]))
                blobs.append(_pack(*_by_document(row[lo:hi], doc[lo:hi]), (s & 0xFFFF).astype(np.uint16), (s >> 16).astype(np.uint16), width[lo:hi].astype(np.uint8), trigger[lo:hi].astype(np.uint32), key[lo:hi]))
            for i in range(0, len(places), 2_000):
                yield _rows(_TRIGGERS, places[i : i + 2_000], blobs[i : i + 2_000])
            for b in spans.batches():
                # they pass through the next stage: deal them evenly
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1).to_numpy() % parts, pa.int32()), b.column(2), b.column(1)], names=["kind", "place", "data", "bucket"])

        def out(rows):
            for b in rows:
                yield b if b.num_columns == 4 else pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.int32())], names=["kind", "place", "data", "bucket"])

        for b in batches:
            rows, docs = b.column("row").to_numpy(), b.column("doc").to_numpy()
            raw, bounds = kernel.utf8(b.column("text"))
            for i, j in kernel.chunks(bounds, 500_000):
                edges = bounds[i : j + 1] - bounds[i]
                first, last, trigger, phrase = triggers(raw[bounds[i] : bounds[j]], edges)
                if not len(first):
                    continue
                d = np.searchsorted(edges, first, "right") - 1
                held.append((rows[i + d], docs[i + d], first - edges[d], last - first, trigger, phrase))
                if sum(len(x[0]) for x in held) >= FLUSH:
                    yield from out(flush())
        if held:
            yield from out(flush())

    known = texts.where("doc IS NOT NULL").select("row", "doc", "text")
    return known.mapInArrow(kernel.alone("suffixes", run), _PACKED + ", bucket int")


def _settle(parsed: DataFrame, parts: int, buckets: int) -> DataFrame:
    """By trigger: later occurrences of a phrase are removed, overlapping phrases are asked for."""

    def work(blobs, spans):
        fields = []
        for d in blobs:
            rows, docs, who, low, high, width, trigger, key = _unpack(d)
            fields.append((rows[who], docs[who], low.astype(np.int64) | (high.astype(np.int64) << 16), width, trigger, key))
        row, doc, start, width, trigger, key = (np.concatenate(c) for c in zip(*fields, strict=True))
        order = np.lexsort((doc, key, trigger))
        row, doc, start, width, trigger, key = (x[order] for x in (row, doc, start, width, trigger, key))
        edge = np.concatenate([[True], (key[1:] != key[:-1]) | (trigger[1:] != trigger[:-1])])
        new = np.flatnonzero(edge)
        first = np.repeat(doc[new], np.diff(np.append(new, len(doc))))
        later = doc > first
        spans.add(row[later], doc[later], start[later], start[later] + width[later] + LENGTH)
        # phrases and documents of each trigger
        group = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        size = np.diff(np.append(group, len(trigger)))
        phrases = np.add.reduceat(edge.astype(np.int64), group)
        mixed = np.minimum.reduceat(doc, group) != np.maximum.reduceat(first, group)
        ask = np.repeat((phrases > 1) & mixed, size) & ~later
        hot = np.repeat(phrases > HOT, size)[ask]
        return row[ask], doc[ask], start[ask], width[ask], trigger[ask], hot

    def run(batches):
        spans = _Spans(buckets)
        wanted: list[tuple] = []
        place, held = None, []

        def emit():
            yield from spans.batches()
            if not sum(len(x[0]) for x in wanted):
                return
            row, doc, start, width, trigger, hot = (np.concatenate(c) for c in zip(*wanted, strict=True))
            wanted.clear()
            at = row.astype(np.uint64) % np.uint64(buckets)
            order = np.argsort(at, kind="stable")
            row, doc, start, width, trigger, hot, at = (x[order] for x in (row, doc, start, width, trigger, hot, at))
            cuts = np.append(np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])), len(at))
            places, blobs = [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                places.append(int(at[lo]))
                blobs.append(_pack(*_by_document(row[lo:hi], doc[lo:hi]), start[lo:hi].astype(np.uint32), width[lo:hi].astype(np.uint8), trigger[lo:hi], hot[lo:hi].astype(np.uint8)))
            for i in range(0, len(places), 2_000):
                yield _rows(_WANTED, places[i : i + 2_000], blobs[i : i + 2_000])

        for b in batches:
            for kind, p, data, bucket in zip(*[b.column(c).to_pylist() for c in ("kind", "place", "data", "bucket")], strict=True):
                if kind == _REMOVED:
                    yield _rows(_REMOVED, [bucket], [data])
                    continue
                if p != place and held:
                    wanted.append(work(held, spans))
                    held = []
                    if sum(len(x[0]) for x in wanted) + sum(len(x[0]) for x in spans.held) >= FLUSH:
                        yield from emit()
                place = p
                held.append(data)
        if held:
            wanted.append(work(held, spans))
        yield from emit()

    n = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parsed.repartition(n, "place").sortWithinPartitions("place", "kind").mapInArrow(kernel.alone("suffixes", run), _PACKED)


def _places(blob_rows: np.ndarray, blob_docs: np.ndarray, rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Index of each (row, doc) of a blob among a bucket's documents."""
    pair = np.empty(len(rows), [("r", np.int64), ("d", np.int64)])
    pair["r"], pair["d"] = rows, docs
    ask = np.empty(len(blob_rows), pair.dtype)
    ask["r"], ask["d"] = blob_rows, blob_docs
    order = np.argsort(pair, order=("r", "d"))
    return order[np.searchsorted(pair[order], ask)]


def _packed_documents(texts: DataFrame) -> DataFrame:
    """(place, data): the rows of each bucket in compressed blobs, to shuffle fewer bytes."""

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in batches:
            place = b.column("place").to_numpy()
            order = np.argsort(place, kind="stable")
            cuts = np.append(np.flatnonzero(np.concatenate([[True], place[order][1:] != place[order][:-1]])), len(order))
            places, blobs = [], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi > lo:
                    part = b.take(pa.array(order[lo:hi]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                        writer.write_batch(part)
                    places.append(int(place[order[lo]]))
                    blobs.append(sink.getvalue().to_pybytes())
            yield kernel.batch("place data", pa.array(places, pa.int32()), kernel.blobs(blobs))

    return texts.mapInArrow(kernel.alone("suffixes", run), "place int, data binary")


def _opened(blobs: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(d.as_py()).read_all() for d in blobs]).combine_chunks()


def _sided(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row keys, ids, bytes and bounds of a bucket's documents; a null id is below all."""
    docs = table.column("doc").combine_chunks().fill_null(-(1 << 63)).to_numpy()
    return table.column("row").to_numpy(), docs, *kernel.utf8(table.column("text"))


def _fetch(texts: DataFrame, asked: DataFrame, parts: int) -> DataFrame:
    """Bytes of the asked phrases by trigger, windows of hot triggers by their own hash."""
    kind_column = pa.schema([("kind", pa.int8()), ("place", pa.int32()), ("data", pa.binary()), ("bucket", pa.int32())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return kind_column.empty_table()
        bucket = right.column("place")[0].as_py()
        rows, docs, raw, bounds = _sided(_opened(left.column("data")))
        spans = _Spans(1)
        made: list[tuple[int, int, bytes, int | None]] = []
        phrases, windows = [], []
        for kind, data in zip(right.column("kind").to_pylist(), right.column("data").to_pylist(), strict=True):
            if kind == _REMOVED:
                brow, bdoc, who, start, size = _unpack(data)
                spans.add(brow[who], bdoc[who], start, start.astype(np.int64) + size)
                continue
            brow, bdoc, who, start, width, trigger, hot = _unpack(data)
            at = _places(brow, bdoc, rows, docs)[who]
            for target, own in ((phrases, hot == 0), (windows, hot > 0)):
                target.append((at[own], start[own].astype(np.int64), width[own].astype(np.int64), trigger[own]))
        if phrases:
            at, start, width, trigger = (np.concatenate(c) for c in zip(*phrases, strict=True))
            part = trigger.astype(np.int64) * 2_654_435_761 % (1 << 32) % parts
            order = np.argsort(part, kind="stable")
            at, start, width, part = at[order], start[order], width[order], part[order]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part)) if len(part) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                a, s, w = at[lo:hi], start[lo:hi], width[lo:hi]
                made.append((_PHRASES, int(part[lo]), _pack(*_by_document(rows[a], docs[a]), s.astype(np.uint32), w.astype(np.uint8), raw[kernel.ragged(bounds[a] + s, w + LENGTH)]), None))
        if windows and sum(len(x[0]) for x in windows):
            at, start, width, _ = (np.concatenate(c) for c in zip(*windows, strict=True))
            owner = np.repeat(at, width + 1)
            place = kernel.ragged(start, width + 1)
            one, two = _window_hashes(raw, bounds[owner] + place)
            order = np.lexsort((docs[owner], two, one))
            owner, place, one, two = owner[order], place[order], one[order], two[order]
            new = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
            first = np.repeat(docs[owner[new]], np.diff(np.append(new, len(owner))))
            later = docs[owner] > first
            spans.add(rows[owner[later]], docs[owner[later]], place[later], place[later] + LENGTH)
            owner, place, one, two = owner[~later], place[~later], one[~later], two[~later]
            part = (one >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            owner, place, one, two, part = owner[order], place[order], one[order], two[order], part[order]
            cuts = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                a = owner[lo:hi]
                made.append((_WINDOWS, int(part[lo]), _pack(*_by_document(rows[a], docs[a]), place[lo:hi].astype(np.uint32), one[lo:hi], two[lo:hi]), None))
        for b in spans.batches():
            made += [(_REMOVED, bucket % parts, d, bucket) for d in b.column("data").to_pylist()]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*made, strict=True), kind_column, strict=True)], schema=kind_column) if made else kind_column.empty_table()

    both = texts.groupBy("place").cogroup(asked.groupBy("place"))
    return both.applyInArrow(kernel.alone("suffixes", run), _PACKED + ", bucket int")


def _window_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the windows that start at ``at``."""
    out = []
    for prime in (0x9E3779B97F4A7C15, _OTHER):
        sums = kernel.prefix(raw, prime)
        out.append(kernel.hashes(sums, at, at + LENGTH, prime))
    return out[0], out[1]


def _sorted_suffixes(phrase_bytes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the dictionary, to a depth of ``LENGTH`` bytes.

    Returns the order of the suffixes that begin at ``start``, and for each place in
    that order whether it differs from the one before.
    """
    padded = np.zeros((len(start), 56), np.uint8)
    padded[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(phrase_bytes, LENGTH)[start]
    key = padded.view(np.uint64).byteswap(inplace=True)  # big-endian words sort as bytes do
    order = np.argsort(key[:, 0], kind="stable")
    differs = np.ones(len(order), bool)
    differs[1:] = key[order[1:], 0] != key[order[:-1], 0]
    for column in range(1, 7):
        # only runs that are still equal are refined
        run = np.cumsum(differs)
        size = np.bincount(run)
        open_ = np.flatnonzero(size[run] > 1)
        if not len(open_):
            break
        own = order[open_]
        fine = np.lexsort((key[own, column], run[open_]))
        order[open_] = own[fine]
        own = order[open_]
        inner = np.zeros(len(open_), bool)
        inner[1:] = (run[open_][1:] == run[open_][:-1]) & (key[own[1:], column] != key[own[:-1], column])
        differs[open_] |= inner
    return order, differs


def _compare(fetched: DataFrame, buckets: int) -> DataFrame:
    """Windows whose suffix also begins in a document with a smaller id."""

    def settle(spans, row, doc, place, order, differs):
        row, doc, place = row[order], doc[order], place[order]
        new = np.flatnonzero(differs)
        least = np.repeat(np.minimum.reduceat(doc, new), np.diff(np.append(new, len(doc))))
        later = doc > least
        spans.add(row[later], doc[later], place[later], place[later] + LENGTH)

    def work(held, spans):
        phrases = [_unpack(d) for k, d in held if k == _PHRASES]
        if phrases:
            rows, docs, starts, places, at, parts = [], [], [], [], 0, []
            for brow, bdoc, who, start, width, data in phrases:
                width = width.astype(np.int64)
                size = width + LENGTH
                first = at + np.cumsum(size) - size
                owner = np.repeat(who, width + 1)
                rows.append(brow[owner])
                docs.append(bdoc[owner])
                starts.append(kernel.ragged(first, width + 1))
                places.append(kernel.ragged(start.astype(np.int64), width + 1))
                parts.append(data)
                at += len(data)
            order, differs = _sorted_suffixes(np.concatenate(parts), np.concatenate(starts))
            settle(spans, np.concatenate(rows), np.concatenate(docs), np.concatenate(places), order, differs)
        windows = [_unpack(d) for k, d in held if k == _WINDOWS]
        if windows:
            row, doc, place, one, two = (np.concatenate(c) for c in zip(*[(r[w], d[w], s.astype(np.int64), x, y) for r, d, w, s, x, y in windows], strict=True))
            order = np.lexsort((two, one))
            differs = np.ones(len(order), bool)
            differs[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
            settle(spans, row, doc, place, order, differs)

    def run(batches):
        spans = _Spans(buckets)
        place, held = None, []
        for b in batches:
            for kind, p, data, bucket in zip(*[b.column(c).to_pylist() for c in ("kind", "place", "data", "bucket")], strict=True):
                if kind == _REMOVED:
                    yield _rows(_REMOVED, [bucket], [data])
                    continue
                if p != place and held:
                    work(held, spans)
                    held = []
                    if sum(len(x[0]) for x in spans.held) >= FLUSH:
                        yield from spans.batches()
                place = p
                held.append((kind, data))
        if held:
            work(held, spans)
        yield from spans.batches()

    n = int(fetched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fetched.repartition(n, "place").sortWithinPartitions("place", "kind").mapInArrow(kernel.alone("suffixes", run), _PACKED)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), plain: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) and ``carry`` of every row.

    With ``plain``, ``kept`` is a string, without characters that were cut in part.  It is
    made here and not by a function over the result: that would take a second worker for
    each task, and all workers that an executor ever had stay and take turns.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, docs.count() // DOCS_PER_BUCKET)
    renamed = [F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)]
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), *renamed)
    row = F.xxhash64("doc", "text")
    texts = source.withColumn("row", row)
    # the bucket is the remainder of the unsigned row key, as numpy takes it
    place = F.expr(f"cast(pmod(pmod(row, {buckets}L) + case when row < 0 then {(1 << 64) % buckets}L else 0L end, {buckets}L) as int)")
    dealt = _packed_documents(texts.withColumn("place", place))
    asked = _settle(_parse(texts, parts, buckets), parts, buckets)
    removed = _compare(_fetch(dealt, asked, parts), buckets)
    kinds = [source.schema[f"carry_{i}"] for i in range(len(carry))]
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if plain else 'binary'}" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kinds)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _opened(left.column("data"))
        rows, ids, raw, bounds = _sided(left)
        mark = np.zeros(len(raw) + 1, np.int64)
        for data in right.column("data").to_pylist():
            brow, bdoc, who, start, size = _unpack(data)
            # equal rows share their ranges
            for first in _everywhere(rows, ids, brow, bdoc, who, start, bounds):
                np.add.at(mark, first[0], 1)
                np.add.at(mark, first[0] + size[first[1]], -1)
        gone = np.cumsum(mark[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        begin, _, owner = kernel.spans(gone, bounds)
        keep = raw[~gone].tobytes()
        edge = (bounds - total[bounds]).tolist()
        kept = [keep[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        out = [left.column("doc").combine_chunks(), np.diff(bounds), np.diff(total[bounds]), np.bincount(owner, minlength=len(rows))]
        out.append(pa.array([d.decode("utf-8", "ignore") for d in kept], pa.string()) if plain else kernel.blobs(kept))
        out += [left.column(f.name).combine_chunks() for f in kinds]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *[f.name for f in kinds]]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in out], names=names)

    found = dealt.groupBy("place").cogroup(removed.groupBy("place")).applyInArrow(kernel.alone("suffixes", run), schema)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)])


def _everywhere(rows, ids, brow, bdoc, who, start, bounds):
    """(byte position, record) for the records of a blob, for each of several equal rows."""
    pair = np.empty(len(rows), [("r", np.int64), ("d", np.int64)])
    pair["r"], pair["d"] = rows, ids
    order = np.argsort(pair, order=("r", "d"))
    ask = np.empty(len(brow), pair.dtype)
    ask["r"], ask["d"] = brow, bdoc
    low, high = np.searchsorted(pair[order], ask), np.searchsorted(pair[order], ask, "right")
    step = 0
    while (some := low + step < high).any():
        own = np.flatnonzero(some[who])
        yield bounds[order[low[who[own]] + step]] + start[own], own
        step += 1


def cleaned(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with what is left of every text; a character that was cut in part goes too."""
    others = tuple(c for c in docs.columns if c not in (id_col, text))
    found = deduplicate(docs, id_col, text, carry=others, plain=True)
    named = {id_col: F.col("doc_id"), text: F.col("kept")} | {c: F.col(f"`{c}`") for c in others}
    return found.select(*[named[c].alias(c) for c in docs.columns])
