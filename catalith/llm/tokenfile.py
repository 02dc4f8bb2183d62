"""Token files of patched frame-of-reference blocks.

A shard holds the ids of consecutive documents.  Ids are dealt into blocks of 256.
A block subtracts its minimum and packs the rest at the bit width that holds all but
a tenth of its values; the high bits of the others go to an exception list of
(place, high bits).  The header indexes where every block starts and where every
document's ids start, so one document is read without decoding the blocks before it.

All numbers are little-endian.  Layout of a shard:

    magic "PFR1", uint32 documents, uint64 ids, uint32 blocks, uint64 ids before it
    in its part; int64 document ids; uint8 null flags of them; uint64 id bounds (documents + 1);
    uint32 block starts (blocks + 1); then per block: uint32 minimum, uint8 width,
    uint16 exceptions, packed bits, uint8 exception places, uint32 high bits

Shards are written as rows of a Parquet file in the shared folder, one part for
each range of document ids, in ascending order.

Defined results: a null or empty text is the end id alone; a null document id sorts
first; rows of one id follow each other in text order; an empty table gives no
shards and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel, pieces

BLOCK = 256
QUANTILE = 0.9
SHARD_IDS = 1_000_000
END = 2
_HEAD = struct.Struct("<4sIQIQ")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 1, 0)


def _pack(x: np.ndarray, w: int) -> np.ndarray:
    """Rows of 8 values of up to 16 bits, each row in ``w`` bytes; the first value lowest."""
    x = x.astype(np.uint64).reshape(-1, 8)
    at = (np.arange(4) * w).astype(np.uint64)
    low, high = np.bitwise_or.reduce(x[:, :4] << at, axis=1), np.bitwise_or.reduce(x[:, 4:] << at, axis=1)
    both = np.empty((len(x), 2), "<u8")
    both[:, 0] = low | high << np.uint64(4 * w) if w < 16 else low
    both[:, 1] = high >> np.uint64(64 - 4 * w)
    return both.view(np.uint8).reshape(len(x), 16)[:, :w]


def _unpack(packed: np.ndarray, w: int) -> np.ndarray:
    """The values of ``_pack``, eight a row."""
    full = np.zeros((len(packed), 16), np.uint8)
    full[:, :w] = packed
    low, high = full.view("<u8").T
    at, mask = (np.arange(4) * w).astype(np.uint64), np.uint64((1 << w) - 1)
    out = np.empty((len(packed), 8), np.uint32)
    out[:, :4] = low[:, None] >> at & mask
    upper = low >> np.uint64(4 * w) | high << np.uint64(64 - 4 * w) if w < 16 else high
    out[:, 4:] = upper[:, None] >> at & mask
    return out


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ``ids`` and their starts; the last block is filled up with its minimum."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(1, np.uint32)
    fill = np.full(blocks * BLOCK, ids[(blocks - 1) * BLOCK :].min(), np.uint32)
    fill[:n] = ids
    x = fill.reshape(blocks, BLOCK)
    low = x.min(axis=1)
    x = x - low[:, None]
    width = _bits(np.partition(x, int(QUANTILE * BLOCK) - 1, axis=1)[:, int(QUANTILE * BLOCK) - 1])
    high = x >> width[:, None].astype(np.uint32)
    patched = high > 0
    count = patched.sum(axis=1)
    size = 7 + width * (BLOCK // 8) + 5 * count
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros((blocks, 7), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4] = width
    head[:, 5:] = count.astype("<u2").view(np.uint8).reshape(blocks, 2)
    out[starts[:-1, None] + np.arange(7)] = head
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        if w <= 16:
            packed = _pack(x[own] & np.uint32((1 << w) - 1), w).reshape(len(own), -1)
        else:
            bits = (x[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
            packed = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
        out[starts[own][:, None] + 7 + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(patched)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    body = starts[row] + 7 + width[row] * (BLOCK // 8)
    out[body + rank] = place
    value = high[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(body + count[row] + 4 * rank)[:, None] + np.arange(4)] = value
    return out.tobytes(), starts.astype(np.uint32)


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts`` in ``data``."""
    starts = starts.astype(np.int64)
    if not len(starts):
        return np.empty(0, np.uint32)
    head = data[starts[:, None] + np.arange(7)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width, count = head[:, 4].astype(np.int64), np.ascontiguousarray(head[:, 5:]).view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        packed = data[starts[own][:, None] + 7 + np.arange(w * BLOCK // 8)]
        if w <= 16:
            out[own] = _unpack(packed.reshape(-1, w), w).reshape(len(own), BLOCK)
            continue
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        for k in range(w):
            out[own] |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
    row = np.repeat(np.arange(len(starts)), count)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    body = starts[row] + 7 + width[row] * (BLOCK // 8)
    place = data[body + rank]
    high = np.ascontiguousarray(data[(body + count[row] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
    out[row, place] |= high << width[row].astype(np.uint32)
    return (out + low[:, None]).ravel()


def write_shard(docs: list[int | None], bounds: np.ndarray, ids: np.ndarray, before: int) -> bytes:
    body, starts = pack_blocks(ids)
    head = _HEAD.pack(b"PFR1", len(docs), len(ids), len(starts) - 1, before)
    key = np.array([0 if d is None else d for d in docs], "<i8")
    null = np.array([d is None for d in docs], np.uint8)
    return b"".join([head, key.tobytes(), null.tobytes(), bounds.astype("<u8").tobytes(), starts.astype("<u4").tobytes(), body])


class Shard:
    """A shard read back; ``ids`` decodes only the blocks of the asked documents."""

    def __init__(self, data: bytes):
        magic, n, self.n_ids, blocks, self.before = _HEAD.unpack_from(data)
        if magic != b"PFR1":
            raise ValueError("not a token shard")
        at = _HEAD.size
        key = np.frombuffer(data, "<i8", n, at)
        null = np.frombuffer(data, np.uint8, n, at := at + 8 * n)
        self.docs = [None if z else k for k, z in zip(key.tolist(), null.tolist(), strict=True)]
        self.bounds = np.frombuffer(data, "<u8", n + 1, at := at + n).astype(np.int64)
        self.starts = np.frombuffer(data, "<u4", blocks + 1, at := at + 8 * (n + 1))
        self.body = np.frombuffer(data, np.uint8, offset=at + 4 * (blocks + 1))

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of the documents ``first..last`` of the shard."""
        lo, hi = self.bounds[first], self.bounds[len(self.docs) if last is None else last]
        block = lo // BLOCK
        part = unpack_blocks(self.body, self.starts[block : -(-hi // BLOCK)])
        return part[lo - block * BLOCK : hi - block * BLOCK]


def write(docs: DataFrame, tokenizer: str, end: int = END, id_col: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards of all documents in ascending id order, stored: (part, shard, n_ids, data)."""

    def run(batches):
        encoder = pieces.encoder(tokenizer)
        part = TaskContext.get().partitionId()
        held_docs: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        shard = before = 0

        def flush():
            nonlocal shard, before
            ids = np.concatenate(held)
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            row = kernel.batch("part shard n_ids data", pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()), kernel.blobs([write_shard(held_docs, bounds, ids, before)]))
            shard, before = shard + 1, before + len(ids)
            for x in (held_docs, held, sizes):
                x.clear()
            return row

        for b in batches:
            keys = b.column(0).to_pylist()
            for i, j, ids, bounds in encoder.encode(b.column(1)):
                ids, bounds = pieces.with_end(ids, bounds, end)
                held_docs.extend(keys[i:j])
                held.append(ids)
                sizes.append(np.diff(bounds))
                if sum(map(len, held)) >= shard_ids:
                    yield flush()
        if held_docs:
            yield flush()

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = kernel.texts_of(docs, id_col, text).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return kernel.stored(ordered.mapInArrow(run, "part int, shard int, n_ids long, data binary"), "tokens")


def read(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from stored shards."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    ahead, total = {}, 0
    for r in totals:
        ahead[r["part"]] = total
        total += r["n"]

    def run(batches):
        for b in batches:
            for part, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shard = Shard(data)
                ids = shard.ids().astype("<u4").tobytes()
                cut = shard.bounds * 4
                crc = [zlib.crc32(ids[p:q]) for p, q in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                yield kernel.batch("doc_id start n_tokens ids_crc32", pa.array(shard.docs, pa.int64()), shard.bounds[:-1] + (ahead[part] + shard.before), np.diff(shard.bounds), pa.array(crc, pa.int64()))

    return shards.select("part", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
