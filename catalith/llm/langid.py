"""Language identification with rank-order n-gram profiles.

Every language has a profile: its most frequent letter n-grams of 1 to 3 letters
(within a word, with the word edge as a letter), in order of frequency.  A document
is compared by the out-of-place distance: the sum over its own most frequent
n-grams of the difference of the two ranks, or of the profile length where the
profile lacks the n-gram.  The nearest profile wins.

Profiles are learned from all given rows and have at most ``grams`` entries per
language, so the model stays small whatever the corpus.

Defined results: a null text, an empty text and a text without a letter give
``und`` with score 0; ties of frequency are broken by the n-gram, ties of distance
by the language name; repeated rows count and are predicted again each; with no
profile every row is ``und``; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel

UNKNOWN = "und"
GRAMS = 400
_BITS = 21
_NONE = (1 << _BITS) - 1


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """One flag for each code point, is it a letter, and one place to fill in."""
    kept = kernel.cache("langid")
    if not kept:
        kept["letter"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        kept["place"] = np.zeros(0x110000, np.int32)
    return kept["letter"], kept["place"]


def _chunked(texts: list[str | None], size: int = 250_000):
    first, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > size:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts)


def _halves(texts: list[str | None], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gram_counts`` of fewer groups at a time; a group's texts stay together."""
    kinds = np.unique(groups)
    found = []
    for some in (kinds[: len(kinds) // 2], kinds[len(kinds) // 2 :]):
        own = np.flatnonzero(np.isin(groups, some))
        g, k, n = gram_counts([texts[i] for i in own.tolist()], np.searchsorted(some, groups[own]))
        found.append((some[g], k, n))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def gram_counts(texts: list[str | None], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, gram, count) sorted by group and gram; a gram packs up to three code points.

    A unigram is (none, none, a), a bigram (none, a, b); 0 stands for a word edge.
    """
    lowered = [(t or "").lower() + " " for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = np.frombuffer((" " + "".join(lowered)).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, place = _letters()
    code = np.where(letter[code], code, 0)
    seen = np.zeros(0x110000, bool)
    seen[code] = True
    seen[0] = False
    alphabet = np.flatnonzero(seen)
    base = len(alphabet) + 2  # 0 is the edge, base - 1 stands for no letter
    if (int(groups.max(initial=0)) + 1) * base**3 >= 1 << 62:  # (group, gram) would not fit 64 bits
        return _halves(texts, groups)
    place[alphabet] = np.arange(1, len(alphabet) + 1)
    x = place[code].astype(np.int64)
    group = np.concatenate([[0], np.repeat(groups, sizes)])
    n_groups = int(groups.max()) + 1 if len(groups) else 1
    none = base - 1
    a, b, c = x[:-2], x[1:-1], x[2:]
    flat = np.concatenate([
        (((group * base + none) * base + none) * base + x)[x > 0],
        (((group[1:] * base + none) * base + x[:-1]) * base + x[1:])[(x[1:] + x[:-1]) > 0],
        (((group[2:] * base + a) * base + b) * base + c)[(b > 0) & ((a > 0) | (c > 0))],
    ])
    space = n_groups * base**3
    if space <= 1 << 22:
        dense = np.bincount(flat, minlength=1)
        key = np.flatnonzero(dense)
        count = dense[key]
    else:
        flat.sort()
        edge = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
        key, count = flat[edge], np.diff(np.append(edge, len(flat)))
    points = np.concatenate([[0], alphabet, [_NONE]]).astype(np.int64)
    gram = (points[key // base**2 % base] << (2 * _BITS)) | (points[key // base % base] << _BITS) | points[key % base]
    return key // base**3, gram, count


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", grams: int = GRAMS) -> dict[str, np.ndarray]:
    """The profiles: for each language its ``grams`` most frequent n-grams, in order.

    Counts cover all rows with a language.  Every task sends one row for each
    (language, n-gram); the sums are cut to ``grams`` per language in each reducer
    before a language meets in one place.
    """
    source = kernel.narrow(docs, lang=(lang, "string"), text=(text, "string")).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches):
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def fold():
            g, k, n = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((k, g))
            g, k, n = g[order], k[order], n[order]
            edge = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])]))
            held[:] = [(g[edge], k[edge], np.add.reduceat(n, edge))] if len(g) else []

        for b in batches:
            texts = b.column(1).to_pylist()
            groups = np.array([names.setdefault(x, len(names)) for x in b.column(0).to_pylist()], np.int64)
            for i, j in _chunked(texts):
                held.append(gram_counts(texts[i:j], groups[i:j]))
                if len(held) >= 32:
                    fold()
        if held:
            fold()
        label = list(names)
        for g, k, n in held:
            for i in range(0, len(g), 50_000):
                yield kernel.batch("lang gram n", pa.array([label[x] for x in g[i : i + 50_000]], pa.string()), k[i : i + 50_000], n[i : i + 50_000])

    def top(batches):
        kept: dict[str, list] = {}
        for b in batches:
            for name, k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept.setdefault(name, []).append((-n, k))
                if len(kept[name]) > 8 * grams:
                    kept[name] = sorted(kept[name])[:grams]
        rows = [(name, k, -n) for name, v in kept.items() for n, k in sorted(v)[:grams]]
        yield kernel.batch("lang gram n", pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()))

    kind = "lang string, gram long, n long"
    sums = source.mapInArrow(count, kind).groupBy("lang", "gram").agg(F.sum("n").alias("n")).mapInArrow(top, kind)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "gram"))), 1, grams)
    rows = sums.groupBy("lang").agg(best["gram"].alias("grams")).collect()
    return {r["lang"]: np.array(r["grams"], np.int64) for r in sorted(rows, key=lambda r: r["lang"])}


def predict_batch(texts: list[str | None], profiles: dict[str, np.ndarray], grams: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest profile (-1: no letter), its score, and the runner-up's distance lead."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not profiles:
        return best, score, score
    tables = []
    for p in profiles.values():
        order = np.argsort(p)
        tables.append((p[order], order))
    lead = np.zeros(len(texts))
    for i, j in _chunked(texts):
        doc, gram, count = gram_counts(texts[i:j], np.arange(j - i))
        if not len(doc):
            continue
        order = np.lexsort((gram, -count, doc))
        doc, gram = doc[order], gram[order]
        sizes = np.bincount(doc, minlength=j - i)
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keep = rank < grams
        doc, gram, rank = doc[keep], gram[keep], rank[keep]
        used = np.minimum(sizes, grams)
        far = np.empty((len(tables), j - i))
        for at, (sorted_grams, places) in enumerate(tables):
            hit = np.searchsorted(sorted_grams, gram)
            hit[hit == len(sorted_grams)] = 0
            found = sorted_grams[hit] == gram
            far[at] = np.bincount(doc, np.where(found, np.abs(places[hit] - rank), grams), minlength=j - i)
        some = used > 0
        first = far.argmin(axis=0)
        near = far.min(axis=0)
        best[i:j] = np.where(some, first, -1)
        score[i:j] = np.where(some, 1.0 - near / np.maximum(used * grams, 1), 0.0)
        if len(tables) > 1:
            lead[i:j] = np.where(some, (np.partition(far, 1, axis=0)[1] - near) / np.maximum(used * grams, 1), 0.0)
    return best, score, lead


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text: str = "text", grams: int = GRAMS) -> DataFrame:
    """(doc_id, lang_pred, score, lead) for every row.

    ``score`` is 1 minus the distance over its greatest possible value; ``lead`` is
    how much farther the second language is, on the same scale.
    """
    names = [*profiles, UNKNOWN]

    def run(batches):
        for b in batches:
            best, score, lead = predict_batch(b.column(1).to_pylist(), profiles, grams)
            yield kernel.batch("doc_id lang_pred score lead", b.column(0), pa.array([names[i] for i in best], pa.string()), score, lead)

    return kernel.texts_of(docs, id_col, text).mapInArrow(run, "doc_id long, lang_pred string, score double, lead double")


def accepted(docs: DataFrame, profiles: dict[str, np.ndarray], least: float, text: str = "text", grams: int = GRAMS) -> DataFrame:
    """The rows of ``docs`` with a language at ``least`` or more, with all their columns."""

    def decide(column: pa.Array) -> np.ndarray:
        best, score, _ = predict_batch(column.to_pylist(), profiles, grams)
        return (best >= 0) & (score >= least)

    return kernel.filtered(docs, text, decide)
