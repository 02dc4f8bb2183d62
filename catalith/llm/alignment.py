"""Alignment of two tokenizers' ids over a corpus by inverted pair bitmaps.

Both tokenizers split the bytes of a text (after one leading space).  A pair of tokens is
linked where their byte ranges overlap; offsets at which both end cut the tokens into
groups.  Neither tokenizer merges across the border before a single space between visible
characters, nor before such a line feed, so each distinct segment between borders is
encoded and aligned once per worker and documents are put together from segments.

A block of documents holds an inverted index: for every linked id pair the bitmaps of the
documents with bit k set in the number of links (multiplicity planes), kept as their
non-zero 64-bit words.  The OR of a pair's planes is its document bitmap.

1. Blocks are built where the texts are read, and stored.
2. Popcounts of the OR-merged planes go to buckets of pairs by a hash of the pair, and add
   up there, since documents of two blocks are different.  A frequent pair is one number
   of each block, so no bucket is hot; the best count of every first id is one table of
   that vocabulary's size.
3. Blocks ask the buckets for the counts of their pairs, and the postings of a block give
   every document its sums.

Defined results: documents without tokens (null, empty, or a text that either tokenizer
does not give back byte for byte) have zeros and an empty digest; rows count as documents
each, repeated or not; ids may be null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel
from catalith.llm.pieces import PieceEncoder

KEEP = 600_000
BLOCK_DOCS = 1 << 16
BLOCK_PAIRS = 3_000_000
_WORDS = BLOCK_DOCS // 64
_B_BITS = 15


def aligner(first: str, second: str) -> Aligner:
    """The worker's aligner of two tokenizer files."""
    kept = kernel.cache("alignment")
    if (first, second) not in kept:
        kept[first, second] = Aligner(first, second)
    return kept[first, second]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Aligned:
    """Documents of a chunk: counts, group texts, and linked pairs with their documents."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    pairs: np.ndarray  # (a, b, document) in one number, ascending
    times: np.ndarray


class Aligner:
    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(alphabet.get(c, 0) for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if len(self.b_bytes) > 1 << _B_BITS or len(self.a_bytes) > 1 << 32 - _B_BITS:
            raise ValueError("vocabularies too large for 32-bit pairs")
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id("▁")
        names_b = [self.b.id_to_piece(i) for i in range(len(self.b_bytes))]
        self.lines = not any("\n" in n for n in names_b)
        self.spaces = not any("▁" in n.lstrip("▁") for n in names_b)
        self._reset()

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _reset(self) -> None:
        self.spans = kernel.Spans()
        self.counts = np.empty((0, 3), np.int64)
        self.valid = np.empty(0, bool)
        self.links = np.empty(0, np.uint32)
        self.link_ends = np.zeros(1, np.int64)
        self.shown = np.empty(0, np.uint8)
        self.shown_ends = np.zeros(1, np.int64)

    def _second(self, segments: list[bytes]) -> list[list[int]]:
        """Ids of segments by the second tokenizer, which puts a space before each itself."""
        own = [s[1:] if s[:1] == b" " else s for s in segments]
        found = self.b.encode([s.decode() for s in own], num_threads=1)
        return [ids if s[:1] == b" " else ids[1:] if ids[:1] == [self.space] else [] for s, ids in zip(segments, found, strict=True)]

    def _learn(self, first: int) -> None:
        """Align the segments numbered ``first`` and up."""
        segments = self.spans.bytes_of(first)
        for at in range(0, len(segments), 20_000):
            some = segments[at : at + 20_000]
            a = [e.ids for e in self.a.encode_batch_fast([s.decode() for s in some], add_special_tokens=False)]
            b = self._second(some)
            valid = [b"".join([self.a_bytes[i] for i in x]) == s == b"".join([self.b_bytes[i] for i in y]) for s, x, y in zip(some, a, b, strict=True)]
            a = [x if ok else [] for x, ok in zip(a, valid, strict=True)]
            b = [x if ok else [] for x, ok in zip(b, valid, strict=True)]
            self._align(a, b, valid)

    def _align(self, a: list[list[int]], b: list[list[int]], valid: list[bool]) -> None:
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        ends = np.union1d(end_a, end_b)  # every stretch up to one of these lies in one token of each
        left, right = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        of = np.repeat(np.arange(len(a)), n_a)
        both = np.isin(end_a, end_b, assume_unique=True)
        groups = np.bincount(of[both], minlength=len(a))
        self.links = np.concatenate([self.links, (ids_a[left] << _B_BITS | ids_b[right]).astype(np.uint32)])
        n_links = n_a + n_b - groups
        self.link_ends = np.concatenate([self.link_ends, self.link_ends[-1] + np.cumsum(n_links)])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, groups], axis=1)])
        self.valid = np.concatenate([self.valid, valid])
        texts = self._spelled(ids_a, ids_b, np.flatnonzero(both) + 1, np.flatnonzero(np.isin(end_b, end_a, assume_unique=True)) + 1)
        ends = np.cumsum(groups).tolist()
        shown = ["".join(texts[s:e]).encode() for s, e in zip([0, *ends], ends, strict=False)]
        self.shown = np.concatenate([self.shown, np.frombuffer(b"".join(shown), np.uint8)])
        self.shown_ends = np.concatenate([self.shown_ends, self.shown_ends[-1] + np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)))])

    @staticmethod
    def _spelled(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """Text of every group, each with a closing semicolon."""
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        out, i, j = [], 0, 0
        for p, q in zip(cut_a.tolist(), cut_b.tolist(), strict=True):
            out.append(f"{','.join(a[i:p])}|{','.join(b[j:q])};")
            i, j = p, q
        return out

    def align(self, column: pa.Array) -> Iterator[tuple[int, int, Aligned]]:
        """For ranges of texts: first, last and their alignment."""
        raw, bounds = kernel.utf8(column)
        for first, last in kernel.chunks(bounds):
            for i in range(first, last, BLOCK_DOCS):
                j = min(i + BLOCK_DOCS, last)
                part = raw[bounds[i] : bounds[j]]
                inner = bounds[i : j + 1] - bounds[i]
                yield i, j, self._documents(np.insert(part, inner[:-1], 32), inner + np.arange(j - i + 1))

    def _documents(self, raw: np.ndarray, bounds: np.ndarray) -> Aligned:
        n = len(bounds) - 1
        starts = PieceEncoder.borders(raw, bounds, after_line=False) if self.spaces and self.lines else bounds[:-1]
        if len(self.spans) > KEEP:
            self._reset()
        before = len(self.spans)
        seg = self.spans.number(raw, starts, np.append(starts[1:], len(raw)))
        if len(self.spans) > before:
            self._learn(before)
        cut = np.searchsorted(starts, bounds)
        doc = np.repeat(np.arange(n), np.diff(cut))
        good = (np.diff(bounds) > 1) & (np.bincount(doc[~self.valid[seg]], minlength=n) == 0)
        use = good[doc]
        seg, doc = seg[use], doc[use]
        totals = np.zeros((n, 3), np.int64)
        np.add.at(totals, doc, self.counts[seg])
        first, size = self.link_ends[seg], self.link_ends[seg + 1] - self.link_ends[seg]
        linked = self.links[kernel.ragged(first, size)].astype(np.uint64) << np.uint64(16) | np.repeat(doc, size).astype(np.uint64)
        pairs, times = np.unique(linked, return_counts=True)
        first, size = self.shown_ends[seg], self.shown_ends[seg + 1] - self.shown_ends[seg]
        shown = self.shown[kernel.ragged(first, size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(doc, np.arange(n + 1))].tolist()
        digests = [hashlib.sha256(shown[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:], strict=False)]
        return Aligned(*totals.T, digests, pairs, times)


# ---------------------------------------------------------------- bitmaps


@dataclass
class Postings:
    """Multiplicity planes of the pairs of a block, as non-zero words sorted by (pair, place)."""

    keys: np.ndarray  # distinct pairs, ascending
    plane_ends: np.ndarray
    pair: np.ndarray
    place: np.ndarray
    word: np.ndarray

    @classmethod
    def build(cls, pairs: np.ndarray, times: np.ndarray) -> Postings:
        """From ascending (pair, document) numbers and how often each is linked."""
        keys, pair = np.unique(pairs >> np.uint64(16), return_inverse=True)
        doc = (pairs & np.uint64(0xFFFF)).astype(np.int64)
        held: list[tuple] = []
        for k in range(int(times.max(initial=0)).bit_length()):
            on = np.flatnonzero(times >> k & 1)
            at = pair[on] * _WORDS + (doc[on] >> 6)
            start = np.flatnonzero(np.diff(at, prepend=-1))
            bit = np.left_shift(np.uint64(1), (doc[on] & 63).astype(np.uint64))
            held.append((at[start], np.bitwise_or.reduceat(bit, start) if len(start) else bit))
        at = np.concatenate([h[0] for h in held]) if held else np.empty(0, np.int64)
        word = np.concatenate([h[1] for h in held]) if held else np.empty(0, np.uint64)
        return cls(keys.astype(np.uint32), np.cumsum([len(h[0]) for h in held]), at // _WORDS, at % _WORDS, word)

    def planes(self) -> Iterator[tuple[int, slice]]:
        first = 0
        for k, end in enumerate(self.plane_ends.tolist()):
            yield k, slice(first, end)
            first = end

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents (popcount of the OR of the planes) and links of every pair."""
        at = self.pair * _WORDS + self.place
        order = np.argsort(at, kind="stable")
        start = np.flatnonzero(np.diff(at[order], prepend=-1))
        merged = np.bitwise_or.reduceat(self.word[order], start) if len(start) else self.word
        docs, links = np.zeros((2, len(self.keys)), np.int64)
        np.add.at(docs, self.pair[order][start], np.bitwise_count(merged).astype(np.int64))
        for k, plane in self.planes():
            np.add.at(links, self.pair[plane], np.bitwise_count(self.word[plane]).astype(np.int64) << k)
        return docs, links

    def sums(self, scores: np.ndarray, documents: int) -> np.ndarray:
        """For each column of ``scores`` by pair: its sum over the links of every document."""
        out = np.zeros((documents, scores.shape[1]), np.int64)
        for k, plane in self.planes():
            for at in range(plane.start, plane.stop, 200_000):
                some = slice(at, min(at + 200_000, plane.stop))
                bits = np.unpackbits(self.word[some].astype("<u8").view(np.uint8), bitorder="little")
                on = np.flatnonzero(bits)
                row = at + (on >> 6)
                np.add.at(out, self.place[row] * 64 + (on & 63), scores[self.pair[row]] << k)
        return out

    def packed(self) -> list[bytes]:
        kinds = ("<u4", "<i8", "<u4", "<u2", "<u8")
        return [x.astype(t).tobytes() for x, t in zip((self.keys, self.plane_ends, self.pair, self.place, self.word), kinds, strict=True)]

    @classmethod
    def unpacked(cls, cells: list[bytes]) -> Postings:
        kinds = ("<u4", "<i8", "<u4", "<u2", "<u8")
        keys, ends, pair, place, word = (np.frombuffer(c, t) for c, t in zip(cells, kinds, strict=True))
        return cls(keys, ends, pair.astype(np.int64), place.astype(np.int64), word)


# ---------------------------------------------------------------- Spark

_CELLS = ("keys", "planes", "pair", "place", "word")
_BLOCK = "block long, doc_id array<long>, n_a binary, n_b binary, n_groups binary, groups_sha256 array<string>, " + ", ".join(f"{c} binary" for c in _CELLS)
_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def blocks(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each block of documents, with its inverted index."""

    def run(batches):
        tool, made = aligner(first, second), 0
        held: list[tuple] = []
        size = rows = 0

        def flush():
            nonlocal held, size, rows, made
            shift = np.cumsum([0] + [len(h[0]) for h in held])
            pairs = np.concatenate([h[1].pairs + np.uint64(s) for h, s in zip(held, shift[:-1].tolist(), strict=True)])
            times = np.concatenate([h[1].times for h in held])
            order = np.argsort(pairs, kind="stable")
            cells = Postings.build(pairs[order], times[order]).packed()
            ids = pa.array([pa.concat_arrays([h[0] for h in held]).to_pylist()], pa.list_(pa.int64()))
            counts = [kernel.blobs([np.concatenate([getattr(h[1], c) for h in held]).astype("<i8").tobytes()]) for c in ("n_a", "n_b", "n_groups")]
            digests = pa.array([[d for h in held for d in h[1].digests]], pa.list_(pa.string()))
            number = (TaskContext.get().partitionId() << 32) + made
            made, held, size, rows = made + 1, [], 0, 0
            return kernel.batch(["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", *_CELLS], pa.array([number], pa.int64()), ids, *counts, digests, *[kernel.blobs([c]) for c in cells])

        for b in batches:
            for i, j, found in tool.align(b.column(1)):
                if held and (rows + j - i > BLOCK_DOCS or size + len(found.pairs) > BLOCK_PAIRS):
                    yield flush()
                held.append((b.column(0).slice(i, j - i), found))
                size, rows = size + len(found.pairs), rows + j - i
        if held:
            yield flush()

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, _BLOCK)


def _buckets(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs by bucket, and the bounds of the buckets in it."""
    bucket = (kernel.mix(keys.astype(np.uint64) + np.uint64(1)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def counted(index: DataFrame, n: int) -> DataFrame:
    """(bucket, block, keys, docs, links): popcounts of every block by bucket of pairs."""

    def run(batches):
        for b in batches:
            for block, *cells in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                postings = Postings.unpacked(cells)
                docs, links = postings.counts()
                order, bounds = _buckets(postings.keys, n)
                used = np.flatnonzero(np.diff(bounds))
                columns = [[x[order][bounds[u] : bounds[u + 1]].astype(t).tobytes() for u in used] for x, t in ((postings.keys, "<u4"), (docs, "<i8"), (links, "<i8"))]
                yield kernel.batch("bucket block keys docs links", pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()), *map(kernel.blobs, columns))

    return index.select("block", *_CELLS).mapInArrow(run, "bucket int, block long, keys binary, docs binary, links binary")


def totals(counts: DataFrame) -> DataFrame:
    """(bucket, keys, docs, links): every pair of the corpus once, ascending in its bucket."""

    def merged(parts):
        keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros((2, len(keys)), np.int64)
        for i in (0, 1):
            np.add.at(sums[i], back, np.concatenate([p[i + 1] for p in parts]))
        return keys, *sums

    def run(batches):
        bucket, parts, size = None, [], 0

        def row():
            keys, docs, links = merged(parts)
            return kernel.batch("bucket keys docs links", pa.array([bucket], pa.int32()), *[kernel.blobs([x.astype(t).tobytes()]) for x, t in ((keys, "<u4"), (docs, "<i8"), (links, "<i8"))])

        for b in batches:
            for at, *cells in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if at != bucket and parts:
                    yield row()
                    parts, size = [], 0
                bucket = at
                parts.append([np.frombuffer(c, t) for c, t in zip(cells, ("<u4", "<i8", "<i8"), strict=True)])
                size += len(parts[-1][0])
                if size > 2 * len(parts[0][0]) + 500_000:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
        if parts:
            yield row()

    return counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, keys binary, docs binary, links binary")


def pairs(total: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links) of every linked pair of the corpus."""

    def run(batches):
        for b in batches:
            for cells in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                keys, docs, links = (np.frombuffer(c, t) for c, t in zip(cells, ("<u4", "<i8", "<i8"), strict=True))
                yield kernel.batch("a b n_docs n_links", (keys >> _B_BITS).astype(np.int32), (keys & (1 << _B_BITS) - 1).astype(np.int32), docs, links)

    return total.mapInArrow(run, "a int, b int, n_docs long, n_links long")


def best(total: DataFrame) -> np.ndarray:
    """The highest document count of every first id; as long as that vocabulary at most."""
    rows = pairs(total).groupBy("a").agg(F.max("n_docs").alias("n")).collect()
    out = np.zeros(max((r["a"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["a"]] = r["n"]
    return out


def answers(counts: DataFrame, total: DataFrame) -> DataFrame:
    """(block, bucket, docs): corpus counts of the pairs that every block holds."""

    def run(batches):
        table = None
        for b in batches:
            out = []
            for bucket, block, keys, docs in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                keys = np.frombuffer(keys, "<u4")
                if block == -1:
                    table = keys, np.frombuffer(docs, "<i8")
                else:
                    out.append((block, bucket, table[1][np.searchsorted(table[0], keys)].tobytes()))
            if out:
                blocks_, buckets, cells = zip(*out, strict=True)
                yield kernel.batch("block bucket docs", pa.array(blocks_, pa.int64()), pa.array(buckets, pa.int32()), kernel.blobs(cells))

    asked = counts.select("bucket", "block", "keys", F.lit(None).cast("binary").alias("docs"))
    known = total.select("bucket", F.lit(-1).cast("long").alias("block"), "keys", "docs")
    dealt = known.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "block")
    return dealt.mapInArrow(run, "block long, bucket int, docs binary")


def scored(index: DataFrame, found: DataFrame, top: np.ndarray, n: int) -> DataFrame:
    """Rows of all documents, with the sums that the postings of their block return."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        postings = Postings.unpacked([row[c] for c in _CELLS])
        order, _ = _buckets(postings.keys, n)
        docs = np.empty(len(order), np.int64)
        said = right.sort_by("bucket").column("docs").to_pylist()
        docs[order] = np.frombuffer(b"".join(said), "<i8")
        leading = (docs == top[postings.keys >> _B_BITS]).astype(np.int64) if len(docs) else docs
        n_a, n_b, n_groups = (np.frombuffer(row[c], "<i8") for c in ("n_a", "n_b", "n_groups"))
        sums = postings.sums(np.stack([leading, docs], axis=1), len(n_a))
        ids = pa.array(row["doc_id"], pa.int64())
        columns = [ids, n_a, n_b, n_groups, n_a + n_b - n_groups, sums[:, 0], sums[:, 1], pa.array(row["groups_sha256"], pa.string())]
        return pa.Table.from_batches([kernel.batch("doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", *columns)])

    return index.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, _ROWS)


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Token, group and link counts of every document, scored by corpus-wide pair counts."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = kernel.stored(blocks(docs, first, second, id_col, text), "blocks")
    counts = kernel.stored(counted(index, n), "counts")
    total = kernel.stored(totals(counts), "totals")
    return scored(index, answers(counts, total), best(total), n)
