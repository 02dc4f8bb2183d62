"""Toxicity classifier: averaged subword embeddings and a linear softmax.

A text is lowercased and every word becomes its letter n-grams of 3 to 5 bytes, with
the word edges as letters, hashed to a fixed number of buckets.  The document vector
is the average of the bucket embeddings, and a linear softmax over two classes reads
it.  Embeddings and softmax are trained together in numpy, so a misspelling not seen
before shares most of its n-gram vectors with the word it came from.

Training takes a bounded sample (``PER_CLASS`` labelled rows of each class).  Both
layers are linear, so a trained model is one number per bucket, and scoring a text of
any length is a lookup and a mean.

Defined results: null and empty texts and texts without an n-gram get the score of
the bias alone; repeated rows are scored each; without labelled rows of both classes
every score is the share of class 1 (0 without any label); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalith.llm import kernel

BUCKETS_LOG2 = 18
DIM = 4
SIZES = (3, 4, 5)
PER_CLASS = 1_200
MIN_DOCS = 4
SCALE = 100.0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[:33] = 32
_LOWER[[ord(c) for c in ".,;:!?\"()[]|"]] = 32


@dataclass
class Model:
    effect: np.ndarray  # logit of class 1 over class 0 for each bucket
    bias: float


def _grams(column: pa.Array):
    """For chunks of documents: first, (bucket, document) of every n-gram."""
    raw, bounds = kernel.utf8(column)
    for i, j in kernel.chunks(bounds, 500_000):
        ends = bounds[i + 1 : j + 1] - bounds[i]
        # one edge before the chunk and one after every document
        part = np.insert(_LOWER[raw[bounds[i] : bounds[j]]], np.concatenate([[0], ends]), 32)
        doc = np.repeat(np.arange(j - i), np.diff(np.concatenate([[0], ends])) + 1)
        doc = np.concatenate([[0], doc])
        sums = kernel.prefix(part)
        gap = np.concatenate([[0], np.cumsum(part == 32)])
        found, where = [], []
        for n in SIZES:
            if len(part) < n:
                continue
            start = np.arange(len(part) - n + 1)
            inner = gap[start + n - 1] == gap[start + 1]  # no edge but at the first and last place
            start = start[inner & (part[start + 1] != 32)]
            found.append((kernel.hashes(sums, start, start + n) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64))
            where.append(doc[start + 1])
        yield i, j, np.concatenate(found) if found else np.empty(0, np.int64), np.concatenate(where) if where else np.empty(0, np.int64)


def train(bucket: np.ndarray, doc: np.ndarray, share: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 80, rate: float = 0.05, sparse: float = 3e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings of the used buckets and the softmax layer, by full-batch Adam.

    ``share`` is the part of the document's n-grams that fall in the bucket; rows are
    sorted by document.  A group penalty (``sparse``) sets the embeddings of n-grams
    that tell nothing to exactly zero: one telling word must outweigh the thousands
    of other n-grams of a long text.  Returns (used buckets, embeddings, softmax
    weights, bias).
    """
    docs_of = np.bincount(bucket, minlength=1)
    keep = docs_of[bucket] >= MIN_DOCS
    doc, share = doc[keep], share[keep].astype(np.float32) * np.float32(SCALE)
    used, place = np.unique(bucket[keep], return_inverse=True)
    n = len(y)
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.01, (len(used), DIM)).astype(np.float32)
    soft = (rng.normal(0, 0.1, (DIM, 2)) + [-0.5, 0.5]).astype(np.float32)
    bias = np.zeros(2, np.float32)
    target = np.stack([1 - y, y], 1)
    params, rates = [emb, soft, bias], [rate, 0.2 * rate, 0.2 * rate]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, epochs + 1):
        pool = np.stack([np.bincount(doc, share * emb[place, d], minlength=n) for d in range(DIM)], 1)
        z = pool @ soft + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target) * weight[:, None] / n
        gp = g @ soft.T
        ge = np.stack([np.bincount(place, share * gp[doc, d], minlength=len(used)) for d in range(DIM)], 1)
        for k, (par, q) in enumerate(zip(params, [ge, pool.T @ g, g.sum(0)], strict=True)):
            q = q.astype(np.float32)
            m[k] += 0.1 * (q - m[k])
            v[k] += 0.01 * (q * q - v[k])
            size = v[k] / (1 - 0.99**t)
            if k:
                par -= rates[k] * m[k] / (1 - 0.9**t) / (np.sqrt(size) + 1e-8)
            else:
                step = rate / (np.sqrt(size.sum(axis=1, keepdims=True)) + 1e-8)
                par -= step * m[k] / (1 - 0.9**t)
                norm = np.sqrt((par**2).sum(axis=1, keepdims=True))
                par *= np.maximum(0, 1 - step * sparse / np.maximum(norm, 1e-9))
    return used, emb, soft, bias


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0, per_class: int = PER_CLASS) -> Model:
    """Model from the labelled rows outside ``fold``."""
    sample, counts = kernel.labelled_sample(docs, labels, label, folds, fold, per_class)

    def features(batches):
        for b in batches:
            column = b.column("text")
            ids, ys = b.column("doc_id").to_pylist(), b.column("label").to_pylist()
            for i, j, bucket, doc in _grams(column):
                key, count = np.unique((doc << BUCKETS_LOG2) | bucket, return_counts=True)
                cuts = np.searchsorted(key >> BUCKETS_LOG2, np.arange(j - i + 1))
                bucket = (key & ((1 << BUCKETS_LOG2) - 1)).astype(np.int32)
                share = count / np.maximum(np.bincount(doc, minlength=j - i), 1)[key >> BUCKETS_LOG2]
                parts = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield kernel.batch(
                    "doc_id label bucket share",
                    pa.array(ids[i:j], pa.int64()),
                    pa.array(ys[i:j], pa.int32()),
                    kernel.blobs([bucket[p:q].tobytes() for p, q in parts]),
                    kernel.blobs([share[p:q].astype(np.float32).tobytes() for p, q in parts]),
                )

    kind = "doc_id long, label int, bucket binary, share binary"
    rows = sample.select("doc_id", "text", "label").mapInArrow(features, kind).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bucket"])))
    y = np.array([r["label"] for r in rows], np.float64)
    total = sum(counts.values())
    effect = np.zeros(1 << BUCKETS_LOG2, np.float32)
    if len(set(y)) < 2:
        prior = counts.get(1, 0) / total if total else 0.0
        return Model(effect, float(np.log(max(prior, 1e-12)) - np.log(max(1 - prior, 1e-12))))
    bucket = np.concatenate([np.frombuffer(bytes(r["bucket"]), np.int32) for r in rows]).astype(np.int64)
    share = np.concatenate([np.frombuffer(bytes(r["share"]), np.float32) for r in rows])
    doc = np.repeat(np.arange(len(rows)), [len(r["bucket"]) // 4 for r in rows])
    used, emb, soft, bias = train(bucket, doc, share, y, kernel.class_weights(y, counts))
    effect[used] = SCALE * (emb @ (soft[:, 1] - soft[:, 0]))
    return Model(effect, float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches):
        for b in batches:
            z = np.full(b.num_rows, model.bias)
            for i, j, bucket, doc in _grams(b.column(1)):
                n = np.bincount(doc, minlength=j - i)
                z[i:j] += np.bincount(doc, model.effect[bucket], minlength=j - i) / np.maximum(n, 1)
            yield kernel.batch("doc_id score", b.column(0), 1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, "doc_id long, score double")
