"""Byte-pair encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the corpus are compiled, with their ids as outputs, into a
minimal acyclic automaton: states with equal right sides are one state, so suffixes
are shared, and every arc holds how many words come before it, so the sum along a
word's path is its number in the list of outputs.  The automaton is four flat arrays
in one file, which Spark carries to every executor and workers memory-map.  A word
that is not in the lexicon is merged exactly: the lowest ranked pair first, the
leftmost of equal ones, for many words at once in numpy.

Handles tokenizer files of the kind: BPE with an end-of-word suffix; special tokens;
NFC, white space and lower case as normalizer; a split pattern and byte-level letters
as pre-tokenizer; no decoder (decoding joins the tokens with a space).

Defined results: a null or empty text has no ids; special tokens in a text are
special; repeated rows are encoded each; an empty table gives no rows and an empty
lexicon; very long words are merged with a heap; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel

WORDS = 32_768
KEEP = 1_000_000
LONG = 256
_FAR = np.int32(2**31 - 1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Rules:
    """Vocabulary, merges and splitting rules of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.width = max(vocab.values()) + 1
        key = left * self.width + right
        _, first = np.unique(key[::-1], return_index=True)  # the last rule of a pair holds
        rank = len(key) - 1 - first
        order = np.argsort(key[rank])
        self.keys, self.ranks = key[rank][order], rank[order].astype(np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [texts.get(i, "") for i in range(max(texts) + 1)]
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.marked = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _FAR)

    def words(self, text: str) -> list[bytes | int]:
        """Words of a text without white space, as UTF-8, and ids of its special tokens."""
        if text.isascii() and text.isalpha():
            return [text.lower().encode()]
        out: list[bytes | int] = []
        at = 0
        for hit in self.marked.finditer(text) if self.marked and "<" in text else ():
            out += self._plain(text[at : hit.start()])
            out.append(self.special[hit.group()])
            at = hit.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[bytes]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [w.encode() for w in self.split.findall(text)]

    def merge(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of every word by the merge rules alone."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 6), (6, 12), (12, 24), (24, 64), (64, LONG)):
            own = np.flatnonzero((size > low) & (size <= high))
            for at in range(0, len(own), 50_000):
                rows = own[at : at + 50_000]
                for row, ids in zip(rows.tolist(), self._merge_many([words[i] for i in rows.tolist()], size[rows]), strict=True):
                    out[row] = ids
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = self._merge_long(words[i])
        return out

    def _merge_many(self, words: list[bytes], size: np.ndarray) -> list[np.ndarray]:
        n, width = len(words), int(size.max())
        raw = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), size)
        col = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        token = np.full((n, width + 1), -1, np.int32)
        token[row, col] = self.inner[raw]
        token[np.arange(n), size - 1] = self.final[raw[np.cumsum(size) - 1]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        pair = np.full((n, width + 1), _FAR, np.int32)
        some = token[:, 1:] >= 0
        pair[:, :-1][some] = self.rank(token[:, :-1][some], token[:, 1:][some])
        own = np.arange(n)
        while len(own):
            at = pair.argmin(axis=1)
            best = pair[np.arange(len(own)), at]
            live = best < _FAR
            if not live.all():
                own, pair, at, best = own[live], pair[live], at[live], best[live]
                if not len(own):
                    break
            k = np.arange(len(own))
            gone = after[own, at]
            nxt = after[own, gone]
            token[own, at] = self.result[best]
            token[own, gone] = -1
            after[own, at] = nxt
            before[own, np.minimum(nxt, width)] = at
            pair[k, gone] = _FAR
            pair[k, at] = _FAR
            here = token[own, at]
            right = np.flatnonzero(nxt < size[own])
            pair[right, at[right]] = self.rank(here[right], token[own[right], nxt[right]])
            prev = before[own, at]
            left = np.flatnonzero(prev >= 0)
            pair[left, prev[left]] = self.rank(token[own[left], prev[left]], here[left])
        keep = token >= 0
        return np.split(token[keep], np.cumsum(keep.sum(axis=1))[:-1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, np.uint8)
        token = self.inner[raw].tolist()
        token[-1] = int(self.final[raw[-1]])
        rules = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := rules.get(token[i] * self.width + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue
            token[i], token[j] = int(self.result[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := rules.get(token[x] * self.width + token[y])) is not None:
                    heapq.heappush(heap, (r, x, token[x], token[y]))
        return np.array([t for t in token if t >= 0], np.int32)


# ---------------------------------------------------------------- the automaton


def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The file of a minimal acyclic transducer; ``words`` sorted and distinct."""
    register: dict[tuple, int] = {}
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    path = [0]  # states of the last word

    def minimise(down_to: int, word: bytes) -> None:
        for depth in range(len(path) - 1, down_to, -1):
            child, parent = path.pop(), path[depth - 1]
            sign = (final[child], tuple(arcs[child].items()))
            arcs[parent][word[depth - 1]] = register.setdefault(sign, child)

    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        minimise(common, last)
        for b in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    minimise(0, last)

    renumber = {0: 0}
    order, stack = [0], [0]
    while stack:
        for child in arcs[stack.pop()].values():
            if child not in renumber:
                renumber[child] = len(order)
                order.append(child)
                stack.append(child)
    below: dict[int, int] = {}
    todo = [(0, False)]
    while todo:  # words below each state, children first
        state, ready = todo.pop()
        if ready:
            below[state] = int(final[state]) + sum(below[c] for c in arcs[state].values())
        elif state not in below:
            todo.append((state, True))
            todo.extend((c, False) for c in arcs[state].values() if c not in below)
    rows = []
    for state in order:
        ahead = int(final[state])
        for b, child in sorted(arcs[state].items()):
            rows.append((renumber[state] * 256 + b, renumber[child], ahead))
            ahead += below[child]
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    size = np.array([len(i) for i in ids], np.int64)
    parts = [
        table[:, 0].astype("<i8"),
        table[:, 1].astype("<i4"),
        table[:, 2].astype("<i4"),
        np.array([final[s] for s in order], np.uint8),
        np.concatenate([[0], np.cumsum(size)]).astype("<i4"),
        np.concatenate([*ids, np.empty(0)]).astype("<i4"),
    ]
    head = np.array([len(p) for p in parts], "<i8")
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A memory-mapped transducer."""

    def __init__(self, path: str):
        head = np.fromfile(path, "<i8", 6)
        at, parts = 48, []
        data = np.memmap(path, np.uint8, "r")
        for n, kind in zip(head.tolist(), ("<i8", "<i4", "<i4", "u1", "<i4", "<i4"), strict=True):
            size = n * np.dtype(kind).itemsize
            parts.append(data[at : at + size].view(kind))
            at += size
        self.key, self.to, self.ahead, self.final, self.first, self.ids = parts

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """Number of every word in the lexicon, -1 where it isn't; all words step at once."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        state, number = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.arange(n) if len(self.key) else np.empty(0, np.int64)
        found = np.full(n, -1)
        step = 0
        while len(live):
            done = size[live] == step
            ended = live[done]
            found[ended] = np.where(self.final[state[ended]] > 0, number[ended], -1)
            live = live[~done]
            key = state[live] * 256 + raw[start[live] + step]
            at = np.searchsorted(self.key, key)
            at[at == len(self.key)] = 0
            ok = self.key[at] == key
            live, at = live[ok], at[ok]
            state[live] = self.to[at]
            number[live] += self.ahead[at]
            step += 1
        return found

    def output(self, number: int) -> np.ndarray:
        return self.ids[self.first[number] : self.first[number + 1]]


class Encoder:
    """Ids of whole texts; keeps the chunks between white space that it has seen."""

    def __init__(self, rules: Rules, lexicon: Lexicon | None):
        self.rules, self.lexicon = rules, lexicon
        self._reset()
        texts = [f"{i} ".encode() for i in range(len(rules.tokens))]
        self.decimal = _store(texts)
        self.spelled = _store([f"{t} ".encode() for t in rules.tokens])

    def _reset(self) -> None:
        self.spans = kernel.Spans()
        self.ends = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.int32)

    def encode_words(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of distinct words: by the lexicon, or merged."""
        out: list = [None] * len(words)
        number = self.lexicon.numbers(words) if self.lexicon is not None else np.full(len(words), -1)
        for i in np.flatnonzero(number >= 0).tolist():
            out[i] = self.lexicon.output(number[i])
        new = np.flatnonzero(number < 0).tolist()
        for i, ids in zip(new, self.rules.merge([words[i] for i in new]), strict=True):
            out[i] = ids
        return out

    def _encode_chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.rules.words(t) for t in texts]
        place: dict[bytes, int] = {}
        for parts in split:
            for w in parts:
                if isinstance(w, bytes):
                    place.setdefault(w, len(place))
        known = self.encode_words(list(place))
        single = [known[place[p[0]]] if len(p) == 1 and isinstance(p[0], bytes) else np.concatenate([known[place[w]] if isinstance(w, bytes) else np.array([w], np.int32) for w in p] or [np.empty(0, np.int32)]) for p in split]
        return np.fromiter(map(len, single), np.int64, len(single)), np.concatenate([*single, np.empty(0, np.int32)])

    def _learn(self, first: int) -> None:
        """Ids of the chunks numbered ``first`` and up."""
        size, ids = self._encode_chunks([x.decode() for x in self.spans.bytes_of(first)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For ranges of texts: first, last, all ids and the id bounds of each text."""
        raw, bounds = kernel.utf8(column)
        for i, j in kernel.chunks(bounds, 1_000_000):
            part, edges = raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
            at, stop, doc = kernel.spans(~_BLANK[part], edges)
            if len(self.spans) > KEEP:
                self._reset()
            before = len(self.spans)
            chunk = self.spans.number(part, at, stop)
            if len(self.spans) > before:
                self._learn(before)
            size = self.ends[chunk + 1] - self.ends[chunk]
            ids = self.ids[kernel.ragged(self.ends[chunk], size)]
            count = np.bincount(doc, size, minlength=j - i).astype(np.int64) if len(doc) else np.zeros(j - i, np.int64)
            yield i, j, ids, np.concatenate([[0], np.cumsum(count)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Decoded texts in UTF-8."""
        return _joined(self.spelled, ids, bounds)

    def numerals(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Decimal ids with one space between them."""
        return _joined(self.decimal, ids, bounds)


def _store(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size


def _joined(store: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    data, first, size = store
    n = size[ids]
    text = data[kernel.ragged(first[ids], n)].tobytes()
    edge = np.concatenate([[0], np.cumsum(n)])[bounds].tolist()
    return [text[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def encoder(tokenizer: str, lexicon: str) -> Encoder:
    """The worker's encoder of a tokenizer file and a lexicon file sent by Spark."""
    kept, key = kernel.cache("lexicon"), (tokenizer, lexicon)
    if key not in kept:
        rules = next((e.rules for k, e in kept.items() if k[0] == tokenizer), None) or Rules(tokenizer)
        kept.clear()
        kept[key] = Encoder(rules, Lexicon(SparkFiles.get(lexicon)))
    return kept[key]


def build(docs: DataFrame, tokenizer: str, text: str = "text", words: int = WORDS) -> str:
    """Counts the words of all rows, compiles the most frequent and sends the file.

    At most ``words`` words, the more frequent ones, ties in byte order.
    Returns the file's name among Spark's files.
    """

    def count(batches):
        rules = Rules(tokenizer)
        held, total = kernel.Spans(), np.empty(0, np.int64)
        for b in batches:
            raw, bounds = kernel.utf8(b.column(0))
            for i, j in kernel.chunks(bounds, 4_000_000):
                part = raw[bounds[i] : bounds[j]]
                at, stop, _ = kernel.spans(~_BLANK[part], bounds[i : j + 1] - bounds[i])
                seen = held.number(part, at, stop)
                total = np.bincount(seen, minlength=len(held)) + np.pad(total, (0, len(held) - len(total)))
                if len(held) >= 500_000:
                    yield from _spelled_out(rules, held, total)
                    held, total = kernel.Spans(), np.empty(0, np.int64)
        yield from _spelled_out(rules, held, total)

    source = kernel.narrow(docs, text=(text, "string")).where("text IS NOT NULL")
    counted = source.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counted = kernel.stored(counted, "words")
    picked = sorted(bytes(r["word"]) for r in counted.orderBy(F.col("n").desc(), "word").limit(words).select("word").collect())
    data = compile_lexicon(picked, Rules(tokenizer).merge(picked))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="catalith-"), name)
    with open(path, "wb") as f:
        f.write(data)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def _spelled_out(rules: Rules, held: kernel.Spans, total: np.ndarray):
    counts: dict[bytes, int] = {}
    for chunk, n in zip(held.bytes_of(0), total.tolist(), strict=True):
        for w in rules.words(chunk.decode()):
            if isinstance(w, bytes):
                counts[w] = counts.get(w, 0) + n
    names = list(counts)
    for i in range(0, len(names), 50_000):
        part = names[i : i + 50_000]
        yield kernel.batch("word n", kernel.blobs(part), pa.array([counts[w] for w in part], pa.int64()))


def digests(docs: DataFrame, tokenizer: str, lexicon: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, by encoding and decoding it."""

    def run(batches):
        known = encoder(tokenizer, lexicon)
        for b in batches:
            for i, j, ids, bounds in known.encode(b.column(1)):
                plain, back = known.numerals(ids, bounds), known.decode(ids, bounds)
                sums = [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (plain, back)]
                yield kernel.batch("doc_id n_tokens ids_sha256 decoded_sha256", b.column(0).slice(i, j - i), np.diff(bounds), *sums)

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, tokenizer: str, lexicon: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""

    def run(batches):
        known = encoder(tokenizer, lexicon)
        for b in batches:
            for i, j, ids, bounds in known.encode(b.column(1)):
                offsets = pa.array(bounds.astype(np.int32))
                yield kernel.batch("doc_id ids", b.column(0).slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())))

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, "doc_id long, ids array<int>")
