"""Byte kernels and Spark helpers shared by the operators of this subpackage.

The kernels work on the UTF-8 bytes of many documents at once, so that numpy and
not the interpreter walks the text.  Documents are handled in chunks of a few MB;
a single longer document is one chunk of its own and is never cut.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.session import ship

CHUNK_BYTES = 1_000_000
BATCH_BYTES = 4_000_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_PRIME = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


_caches: dict[str, dict] = {}


def cache(operator: str) -> dict:
    """What an operator keeps in its worker between batches and tasks.

    Workers serve one operator after the other, so when another one asks, the things
    that the last ones kept are let go and the memory is given back.
    """
    others = [name for name, kept in _caches.items() if kept and name != operator]
    if others:
        for name in others:
            _caches[name].clear()
        _powers.clear()
        give_back()
    return _caches.setdefault(operator, {})


def give_back() -> None:
    """Memory that is free in this process goes back to the system."""
    gc.collect()
    trim()


def trim() -> None:
    """Buffers that are free go back to the system; cheap enough for every batch."""
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release is not None:
        release(0)


def let_go(operator: str) -> None:
    """At the end of a task: what ``operator`` kept goes, as idle workers would keep it too."""
    _caches.pop(operator, None)
    give_back()


def alone(operator: str, run: Callable) -> Callable:
    """``run`` of an operator without a cache, over batches or two sides of a group.

    What other operators kept in the worker is let go before it, and its own working
    memory is given back after it, so an idle worker is small.
    """

    def batches(rows):
        cache(operator)
        try:
            yield from run(rows)
        finally:
            _powers.clear()
            give_back()

    def sides(left, right):
        cache(operator)
        try:
            return run(left, right)
        finally:
            _powers.clear()
            give_back()

    return batches if run.__code__.co_argcount == 1 else sides


def prepared(spark: SparkSession) -> SparkSession:
    """Ships the package to the executors; bounds the Arrow batches, as texts are long."""
    ship(spark)
    if _bytes(spark.conf.get(_BATCH)) not in range(1, BATCH_BYTES + 1):
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
    return spark


def _bytes(text: str) -> int:
    return int(text.rstrip("b") or 0) if text.rstrip("b").lstrip("-").isdigit() else 0


def narrow(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, cast: ``narrow(df, doc_id=("doc_id", "long"))``.

    Extra columns of the input, whatever their names, never reach an operator.
    """
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(out) for out, (name, kind) in columns.items()])


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return narrow(docs, doc_id=(id_col, "long"), text=(text_col, "string"))


def held_out(column: Column, folds: int, fold: int) -> Column:
    """True for ids whose crc32 of the decimal text falls in ``fold``."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)) == fold


def cut(df: DataFrame) -> DataFrame:
    """Eager checkpoint in the shared folder named by ``spark.checkpoint.dir``."""
    from catalith.plans.lineage_cut import cut as shared

    return shared(df)


def filtered(docs: DataFrame, text: str, decide: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """Whole rows of ``docs``, all columns as they are, whose text ``decide`` accepts."""
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(np.asarray(decide(b.column(at)), bool)))

    return docs.mapInArrow(run, docs.schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of its own only where none is set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="catalith-shared-")
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- arrow and bytes


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the document boundaries; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(column):
        return raw[:0], np.zeros(1, np.int64)
    return raw[ends[0] : ends[-1]], ends.astype(np.int64) - ends[0]


def chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``size`` bytes."""
    n, first = len(bounds) - 1, 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = max(first + 1, min(last, n))
        yield first, last
        first = last


def spans(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of the runs where ``mask`` holds, cut at documents."""
    if not len(mask):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    change = np.empty(len(mask), bool)
    change[0] = True
    np.not_equal(mask[1:], mask[:-1], out=change[1:])
    change[bounds[:-1][bounds[:-1] < len(mask)]] = True
    at = np.flatnonzero(change)
    ends = np.append(at[1:], len(mask))
    keep = mask[at]
    starts, ends = at[keep], ends[keep]
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes above the space."""
    return spans(raw > 32, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """Final scrambling of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power_table(n: int, prime: int = _PRIME) -> tuple[np.ndarray, np.ndarray]:
    """``prime**i`` and its inverse modulo 2**64 for i < n; kept per worker."""
    key = f"{prime}"
    have = _powers.get(key)
    if have is None or have.shape[1] < n:
        size = max(n, CHUNK_BYTES + 16_384)
        inverse = pow(prime, -1, 1 << 64)
        table = np.ones((2, size), np.uint64)
        table[0, 1:] = np.uint64(prime)
        table[1, 1:] = np.uint64(inverse)
        np.multiply.accumulate(table, axis=1, out=table)
        _powers[key] = have = table
    return have[0], have[1]


def prefix(raw: np.ndarray, prime: int = _PRIME) -> np.ndarray:
    """Prefix sums of the polynomial hash of ``raw``; one longer than ``raw``."""
    power, _ = power_table(len(raw) + 1, prime)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=out[1:])
    return out


def unaligned(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``raw`` on, but for its last seven places."""
    return np.ndarray(max(len(raw) - 7, 0), "<u8", np.ascontiguousarray(raw), strides=(1,))


def block_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int = 256) -> np.ndarray:
    """64-bit hash of every span, eight bytes a step, each step scrambled.

    Spans of up to eight bytes have different hashes.  Unlike polynomials modulo 2**64
    this has no texts that are known to collide.
    """
    word = unaligned(np.concatenate([raw, np.zeros(8, np.uint8)]))
    size = ends - starts
    out = size.astype(np.uint64) * np.uint64(_PRIME)
    left, at = np.flatnonzero((size > 0) & (size <= longest)), 0
    while len(left):
        shift = (8 * (8 - np.minimum(size[left] - at, 8))).astype(np.uint64)
        out[left] = mix((out[left] ^ (word[starts[left] + at] << shift)) + np.uint64(0x9E3779B97F4A7C15))
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > longest).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, prime: int = _PRIME) -> np.ndarray:
    """64-bit hash of every span, equal for equal bytes."""
    _, inverse = power_table(len(sums), prime)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def batch(schema: str | Sequence[str], *columns) -> pa.RecordBatch:
    names = schema.split() if isinstance(schema, str) else list(schema)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def blobs(parts: Sequence[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


# ---------------------------------------------------------------- tables over the corpus


def summed_table(partial: DataFrame, slices: int, width: int, dtype: str = "int64") -> np.ndarray:
    """Sum of dense tables: ``partial`` has rows (slice int, data binary) from every task.

    The table has a fixed size (``slices * width`` numbers) whatever the corpus, so
    it may come to the driver.  A slice is added up as its rows stream by.
    """

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for s, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(d, dtype)
                held[s] = held[s] + x if s in held else x.copy()
        yield batch("slice data", pa.array(list(held), pa.int32()), blobs([x.tobytes() for x in held.values()]))

    n = max(1, min(slices, int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out = np.zeros((slices, width), dtype)
    for r in partial.repartition(n, "slice").mapInArrow(add, "slice int, data binary").collect():
        out[r["slice"]] = np.frombuffer(bytes(r["data"]), dtype)
    return out


def sliced(table: np.ndarray, slices: int) -> Iterator[pa.RecordBatch]:
    """The rows that ``summed_table`` adds up, without empty slices."""
    parts = table.reshape(slices, -1)
    used = np.flatnonzero(parts.any(axis=1))
    yield batch("slice data", pa.array(used, pa.int32()), blobs([parts[i].tobytes() for i in used]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most ``per_class`` labelled rows of each class outside
    ``fold``, and how many such rows each class has in all.

    The rows with the smallest hash of the id are taken, so the sample is the same
    for any partitioning.  The id list is at most ``2 * per_class`` long and is
    broadcast; the texts are not shuffled.  A repeated id counts once, with its
    greatest label; labels other than 0 and 1 are passed over.
    """
    known = (
        narrow(labels, doc_id=("doc_id", "long"), label=(label, "int"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rank = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    picked = [known.where(F.col("label") == c).orderBy(*rank).limit(per_class) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    return texts_of(docs).join(F.broadcast(ids), "doc_id"), counts


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Row weights that give the sample the class shares of all labelled rows; mean 1."""
    w = np.ones(len(y))
    for c in (0, 1):
        if (y == c).any():
            w[y == c] = counts.get(c, 0) / (y == c).sum()
    return w / w.mean() if len(w) else w


def runs(kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of the runs of equal non-zero ``kind``, cut at documents."""
    starts, ends, doc = spans(kind > 0, bounds)
    if not len(starts):
        return starts, ends, doc
    change = np.zeros(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[starts] = True
    change &= kind > 0
    begin = np.flatnonzero(change)
    last = ends[np.searchsorted(starts, begin, "right") - 1]
    return begin, np.minimum(np.append(begin[1:], len(kind)), last), np.searchsorted(bounds, begin, "right") - 1


class Spans:
    """Numbers byte spans by their content, exactly.

    A 64-bit hash proposes the number and the bytes decide: a span whose bytes are not
    those of its hash is numbered by its bytes alone.
    """

    def __init__(self):
        self.keys = np.empty(0, np.uint64)
        self.ids = np.empty(0, np.int64)
        self.first = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.raw = np.zeros(8, np.uint8)  # always with eight bytes more than are used
        self.odd: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.first)

    def _append(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        used = len(self.raw) - 8
        self.first = np.concatenate([self.first, used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.raw = np.concatenate([self.raw[:used], raw[ragged(starts, sizes)], np.zeros(8, np.uint8)])

    def bytes_of(self, first: int) -> list[bytes]:
        """The spans numbered ``first`` and up."""
        base = int(self.first[first]) if first < len(self) else 0
        data = self.raw[base:].tobytes()
        return [data[s : s + n] for s, n in zip((self.first[first:] - base).tolist(), self.size[first:].tolist(), strict=True)]

    def _equal(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        same = self.size[ids] == sizes
        mine, theirs = unaligned(np.concatenate([raw, np.zeros(8, np.uint8)])), unaligned(self.raw)
        left, at = np.flatnonzero(same), 0
        while len(left):
            rest = np.minimum(sizes[left] - at, 8)
            shift = (8 * (8 - rest)).astype(np.uint64)
            ok = ((mine[starts[left] + at] ^ theirs[self.first[ids[left]] + at]) << shift) == 0
            same[left[~ok]] = False
            at += 8
            left = left[ok & (rest == 8)]
            left = left[sizes[left] > at]
        return same

    def number(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every span, none empty; new ones are numbered from ``len(self)`` on."""
        sizes = ends - starts
        key, where, back = np.unique(block_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, key)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == key[known]
        ids = np.empty(len(key), np.int64)
        ids[known] = self.ids[place[known]]
        if not known.all():
            new = where[~known]
            ids[~known] = len(self) + np.arange(len(new))
            self._append(raw, starts[new], sizes[new])
            self.keys = np.insert(self.keys, place[~known], key[~known])
            self.ids = np.insert(self.ids, place[~known], ids[~known])
        out = ids[back]
        for i in np.flatnonzero(~self._equal(raw, starts, sizes, out)).tolist():
            data = raw[starts[i] : ends[i]].tobytes()
            if data not in self.odd:
                self.odd[data] = len(self)
                self._append(raw, starts[i : i + 1], sizes[i : i + 1])
            out[i] = self.odd[data]
        return out
