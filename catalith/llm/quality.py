"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Random indexing gives every token a sparse random index vector; the vector of a
token is the sum of the index vectors of the tokens up to two places around it, over
the whole corpus.  Tokens are runs of letters, of digits and of other marks, hashed
to a fixed number of buckets, so the table has one size whatever the corpus.  A
document is the mean and the spread of its token vectors.  A network with one hidden
layer, written in numpy, maps that to a logit, and a temperature fitted on rows that
the training didn't see turns it into a probability.

Labels are learned from a bounded sample (``PER_CLASS`` rows of each class); the word
vectors cover all documents.

Defined results: null and empty texts are the zero vector and get the network's
score for it; repeated rows are scored each; without labelled rows of both classes
every score is the share of class 1 (0.5 without any label); other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalith.llm import kernel

BUCKETS_LOG2 = 14
DIM = 64
WINDOW = 2
PER_CLASS = 6_000
_SLICES = 128
_KIND = np.full(256, 3, np.uint8)
_KIND[:33] = 0
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = 1
_KIND[128:] = 1


@dataclass
class Model:
    vectors: np.ndarray  # one row per bucket
    layers: list[np.ndarray]
    centre: np.ndarray
    scale: np.ndarray
    temperature: float
    prior: float


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two places and two signs of each bucket's index vector."""
    h = kernel.mix(np.arange(1 << BUCKETS_LOG2, dtype=np.uint64) + np.uint64(0x51ED27))
    first = (h & np.uint64(DIM - 1)).astype(np.int64)
    second = (first + 1 + ((h >> np.uint64(8)).astype(np.int64) % (DIM - 1))) % DIM
    signs = np.stack([(h >> np.uint64(40)) & np.uint64(1), (h >> np.uint64(41)) & np.uint64(1)]).astype(np.int64) * 2 - 1
    return np.stack([first, second]), signs


def _tokens(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, doc = kernel.runs(_KIND[raw], bounds)
    h = kernel.hashes(kernel.prefix(raw), starts, ends)
    return (h >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64), doc


def _chunks(column: pa.Array, size: int = 500_000):
    raw, bounds = kernel.utf8(column)
    for i, j in kernel.chunks(bounds, size):
        yield i, j, *_tokens(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of token vectors over all rows: float32, bucket by dimension."""
    size = 1 << BUCKETS_LOG2

    def gather(batches):
        place, sign = _index_vectors()
        total = np.zeros(size * DIM, np.int64)
        for b in batches:
            for _, _, token, doc in _chunks(b.column(0)):
                for step in range(1, WINDOW + 1):
                    near = doc[step:] == doc[:-step]
                    left, right = token[:-step][near], token[step:][near]
                    for target, context in ((left, right), (right, left)):
                        for p, s in zip(place, sign, strict=True):
                            cell, up = target * DIM + p[context], s[context] > 0
                            total += np.bincount(cell[up], minlength=size * DIM)
                            total -= np.bincount(cell[~up], minlength=size * DIM)
        yield from kernel.sliced(total, _SLICES)

    partial = kernel.narrow(docs, text=(text, "string")).where("text IS NOT NULL").mapInArrow(gather, "slice int, data binary")
    table = kernel.summed_table(partial, _SLICES, size * DIM // _SLICES).reshape(size, DIM).astype(np.float64)
    mass = np.abs(table).sum(axis=1)
    if mass.sum():
        table = table - np.outer(mass, table.sum(axis=0) / mass.sum())
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the token vectors of every text."""
    out = np.zeros((len(column), 2 * DIM), np.float32)
    for i, _, token, doc in _chunks(column, 200_000):
        if not len(token):
            continue
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        n = np.diff(np.append(first, len(doc)))[:, None]
        x = vectors[token]
        mean = np.add.reduceat(x, first, axis=0) / n
        np.square(x, out=x)
        out[i + doc[first], :DIM] = mean
        out[i + doc[first], DIM:] = np.sqrt(np.maximum(np.add.reduceat(x, first, axis=0) / n - mean**2, 0))
    return out


def _logits(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, hidden @ w2 + b2[0]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = 48, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4) -> list[np.ndarray]:
    """Adam on the weighted logistic loss of a network with one hidden layer."""
    rng = np.random.default_rng(7)
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at : at + 128]
            xb = x[rows]
            h, z = _logits(xb, layers)
            g = weight[rows] * (_sigmoid(z) - y[rows]) / len(rows)
            gh = np.outer(g, layers[2]) * (h > 0)
            grads = [xb.T @ gh + decay * layers[0], gh.sum(0), h.T @ g + decay * layers[2], np.array([g.sum()])]
            t += 1
            for p, q, mm, vv in zip(layers, grads, m, v, strict=True):
                mm += 0.1 * (q - mm)
                vv += 0.001 * (q * q - vv)
                p -= rate * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.999**t)) + 1e-8)
    return layers


def fit_temperature(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 71))
    loss = [np.sum(weight * (np.logaddexp(0, z / t) - y * z / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, per_class: int = PER_CLASS) -> Model:
    """Word vectors over ``docs`` and a network on its labelled rows outside ``fold``."""
    vectors = word_vectors(docs)
    sample, counts = kernel.labelled_sample(docs, labels, label, folds, fold, per_class)

    def features(batches):
        for b in batches:
            x = pooled(b.column("text"), vectors)
            yield kernel.batch("doc_id label x", b.column("doc_id"), b.column("label"), kernel.blobs([r.tobytes() for r in x]))

    rows = sorted(sample.select("doc_id", "text", "label").mapInArrow(features, "doc_id long, label int, x binary").collect())
    x = np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in rows], np.float64).reshape(len(rows), 2 * DIM)
    y = np.array([r["label"] for r in rows], np.float64)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    if len(set(y)) < 2:
        return Model(vectors, [], np.zeros(2 * DIM), np.ones(2 * DIM), 1.0, prior)
    weight = kernel.class_weights(y, counts)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - centre) / scale
    unseen = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.ones(len(x), bool)
    seen = ~unseen if len(x) >= 50 else unseen
    layers = fit_network(x[seen], y[seen], weight[seen])
    temperature = fit_temperature(_logits(x[unseen], layers)[1], y[unseen], weight[unseen])
    return Model(vectors, layers, centre, scale, temperature, prior)


def predict(column: pa.Array, model: Model) -> np.ndarray:
    """Score of every text of a column."""
    if not model.layers:
        return np.full(len(column), model.prior)
    x = (pooled(column, model.vectors) - model.centre) / model.scale
    return _sigmoid(_logits(x, model.layers)[1] / model.temperature)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches):
        for b in batches:
            yield kernel.batch("doc_id score", b.column(0), predict(b.column(1), model))

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    return kernel.filtered(docs, text, lambda column: predict(column, model) >= least)
