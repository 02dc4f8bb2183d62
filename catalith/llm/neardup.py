"""MinHash near-duplicates: improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of five-word shingles.  The weight of a shingle is one
plus the logarithm of its count in the document, times the mean damped inverse
document frequency of its words; the document frequencies cover all rows and are kept in a
table of fixed size, by word hash.  Improved consistent weighted sampling draws a (shingle, level) pair such that
two documents draw the same one with the probability of their weighted Jaccard
similarity.  ``BANDS`` bands of ``ROWS`` draws give the buckets: a pair at similarity
0.8 shares none with probability 0.0009.

Documents with the same words are one from here on.  In every bucket each document is
first verified against the smallest id, by the weighted Jaccard similarity of the
whole texts.  Once those links have been joined to classes, only pairs of a bucket
whose classes still differ are left, and all of them are verified: pairs within a
class can't change it.  So no bucket emits all its pairs, and no candidate is dropped.

Defined results: texts without a word link with nothing; texts of one to four words
are one shingle; rows with the same id are one document with all its texts; a null id
takes no part; the class id is the least id of the class; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm import kernel
from catalith.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS = 23
ROWS = 6
DF_LOG2 = 18
GROUP = 48_000
_SLICES = 64
_PARTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) at 65,536 places, and their logarithms."""
    kept = kernel.cache("neardup")
    if not kept:
        u = (np.arange(65_536) + 0.5) / 65_536
        x = np.full(65_536, 1.7)
        low, high = np.zeros(65_536), np.full(65_536, 40.0)
        for _ in range(60):  # bisection of 1 - (1 + x) exp(-x) = u
            x = (low + high) / 2
            over = 1 - (1 + x) * np.exp(-x) > u
            high, low = np.where(over, x, high), np.where(over, low, x)
        kept["r"], kept["log"] = x.astype(np.float32), np.log(x).astype(np.float32)
    return kept["r"], kept["log"]


def _words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, doc = kernel.words(raw, bounds)
    return kernel.block_hashes(raw, starts, ends), doc


def _digests(raw: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128-bit digest of the words of every document that has one, one space between them."""
    starts, ends, doc = kernel.words(raw, bounds)
    size = ends - starts
    follows = np.zeros(len(doc), bool)
    follows[1:] = doc[1:] == doc[:-1]
    data = raw[kernel.ragged(starts - follows, size + follows)]  # with the blank before a word
    at = np.cumsum(size + follows) - size - follows
    data[at[follows]] = 32
    text, edge = data.tobytes(), np.append(at[~follows], len(data)).tolist()
    return [hashlib.blake2b(text[s:e], digest_size=16).digest() for s, e in zip(edge, edge[1:], strict=False)]


def shingles(word: np.ndarray, doc: np.ndarray, idf: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight), sorted by document and shingle."""
    n = len(word)
    value, total, full = np.zeros(n, np.uint64), np.zeros(n), np.zeros(n, np.int64)
    own = idf[(word >> np.uint64(64 - DF_LOG2)).astype(np.int64)]
    for k in range(WORDS):
        if n <= k:
            break
        same = doc[k:] == doc[: n - k]
        value[: n - k] += np.where(same, word[k:] * _PARTS[k], np.uint64(0))
        total[: n - k] += np.where(same, own[k:], 0)
        full[: n - k] += same
    size = np.bincount(doc, minlength=n_docs)
    first = np.zeros(n, bool)
    first[(np.cumsum(size) - size)[size > 0]] = True
    keep = (full == WORDS) | (first & (size[doc] < WORDS))
    value, weight, doc = kernel.mix(value[keep]), total[keep] / full[keep], doc[keep]
    order = np.lexsort((value, doc))
    value, doc, weight = value[order], doc[order], weight[order]
    edge = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])) if len(value) else np.empty(0, np.int64)
    count = np.diff(np.append(edge, len(value)))
    return doc[edge], value[edge], (weight[edge] * (1 + np.log(count))).astype(np.float32)


def band_keys(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Bucket keys, one row for each document that has a shingle, one column per band.

    Documents go in groups of about ``GROUP`` shingles, whose work arrays stay in the
    processor's cache and are used again for every draw.
    """
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    edge = np.append(first, len(doc))
    out = np.empty((len(first), bands), np.uint64)
    log_weight = np.log(weight)
    for i, j in kernel.chunks(edge, GROUP):
        own = slice(edge[i], edge[j])
        _draw(shingle[own], log_weight[own], edge[i : j + 1] - edge[i], out[i:j], rows)
    return out


def _draw(shingle: np.ndarray, log_weight: np.ndarray, edge: np.ndarray, out: np.ndarray, rows: int) -> None:
    r_table, log_table = _gamma_tables()
    at, size, n = edge[:-1], np.diff(edge), len(shingle)
    x, y = np.empty((2, n), np.uint64)
    lanes = x.view("<u2").reshape(-1, 4)
    r, beta, level, a = np.empty((4, n), np.float32)
    place = np.empty(n, np.int64)
    for band in range(out.shape[1]):
        key = np.full(len(at), band + 1, np.uint64)
        for row in range(rows):
            seed = np.uint64((0x9E3779B97F4A7C15 * (2 * (band * rows + row) + 1) + 0x632BE59BD9B4E019 * 2) & (2**64 - 1) | 1)
            np.multiply(shingle, seed, out=x)
            np.right_shift(x, np.uint64(32), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint64(0xD6E8FEB86659FD93), out=x)
            np.copyto(place, lanes[:, 0])
            np.take(r_table, place, out=r, mode="clip")
            np.multiply(lanes[:, 1], np.float32(1 / 65_536), out=beta)
            np.divide(log_weight, r, out=level)
            np.add(level, beta, out=level)
            np.floor(level, out=level)
            np.subtract(level, beta, out=beta)
            np.add(beta, np.float32(1), out=beta)
            np.multiply(r, beta, out=r)
            np.copyto(place, lanes[:, 3])
            np.take(log_table, place, out=a, mode="clip")
            np.subtract(a, r, out=a)
            hit = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, at), size))
            pick = hit if len(hit) == len(at) else hit[np.searchsorted(hit, at)]  # the least shingle of equal ones
            key = kernel.mix(key * _PARTS[1] + shingle[pick] + level[pick].astype(np.int64).astype(np.uint64) * _PARTS[2])
        out[:, band] = key


def word_idf(docs: DataFrame, text: str = "text") -> np.ndarray:
    """sqrt(1 + ln((1 + rows) / (1 + rows with the word))) by word bucket, over all rows."""

    def count(batches):
        table = np.zeros(1 << DF_LOG2, np.int64)
        rows = 0
        for b in batches:
            rows += b.num_rows
            raw, bounds = kernel.utf8(b.column(0))
            for i, j in kernel.chunks(bounds):
                word, doc = _words(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                key = (doc << DF_LOG2) | (word >> np.uint64(64 - DF_LOG2)).astype(np.int64)
                key.sort()
                key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
                table += np.bincount(key & ((1 << DF_LOG2) - 1), minlength=1 << DF_LOG2)
        yield from kernel.sliced(table, _SLICES)
        yield kernel.batch("slice data", pa.array([_SLICES], pa.int32()), kernel.blobs([np.full(len(table) // _SLICES, rows, np.int64).tobytes()]))

    partial = kernel.narrow(docs, text=(text, "string")).mapInArrow(count, "slice int, data binary")
    summed = kernel.summed_table(partial, _SLICES + 1, (1 << DF_LOG2) // _SLICES)
    return np.sqrt(1 + np.log((1 + summed[-1, 0]) / (1 + summed[:-1].ravel())).clip(min=0)).astype(np.float32)


def signatures(texts: DataFrame, idf: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, same, total, keys): digest of the words, total weight, bucket keys."""

    def run(batches):
        for b in batches:
            raw, bounds = kernel.utf8(b.column(1))
            for i, j in kernel.chunks(bounds, 500_000):
                word, doc = _words(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                d, s, w = shingles(word, doc, idf, j - i)
                if not len(d):
                    continue
                keys = band_keys(d, s, w, bands, rows)
                digest = _digests(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                here = np.unique(doc)
                yield kernel.batch(
                    "doc_id same total keys",
                    b.column(0).take(pa.array(here + i)),
                    kernel.blobs(digest),
                    np.add.reduceat(w.astype(np.float64), np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (len(here) + 1) * bands, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel())),
                )

    return texts.mapInArrow(run, "doc_id long, same binary, total double, keys array<long>")


def similarity(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of every pair of texts."""
    out = np.zeros(len(left))
    lraw, lbounds = kernel.utf8(left)
    rraw, rbounds = kernel.utf8(right)
    both = lbounds + rbounds
    for i, j in kernel.chunks(both, 1_000_000):
        sides = []
        for raw, bounds in ((lraw, lbounds), (rraw, rbounds)):
            word, doc = _words(raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            sides.append(shingles(word, doc, idf, j - i))
        d, s, w = (np.concatenate(x) for x in zip(*sides, strict=True))
        total = np.bincount(d, w, minlength=j - i)
        order = np.lexsort((s, d))
        d, s, w = d[order], s[order], w[order]
        twice = np.flatnonzero((d[1:] == d[:-1]) & (s[1:] == s[:-1]))
        common = np.bincount(d[twice], np.minimum(w[twice], w[twice + 1]), minlength=j - i)
        out[i:j] = common / np.maximum(total - common, 1e-30)
    return out


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity."""

    def run(batches):
        for b in batches:
            keep = similarity(b.column("ta"), b.column("tb"), idf) >= least - 1e-6
            mask = pa.array(keep)
            yield kernel.batch("a b", b.column("a").filter(mask), b.column("b").filter(mask))

    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _pairs_across(key, side, doc, total, label, keys, column, idf, least) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one block pair that reach the similarity, as indices."""
    a, b = np.flatnonzero(side), np.flatnonzero(~side)
    low, high = np.minimum(total[a][:, None], total[b]), np.maximum(total[a][:, None], total[b])
    ok = (label[a][:, None] != label[b]) & (low >= (least - 1e-6) * high)
    x, y = np.nonzero(ok)
    x, y = a[x], b[y]
    same = keys[x] == keys[y]
    own = same.argmax(axis=1)
    first = same.any(axis=1) & (keys[x, own] == key)  # each pair in the first bucket that it shares
    x, y = x[first], y[first]
    if not len(x):
        return x, y
    used, back = np.unique(np.concatenate([x, y]), return_inverse=True)
    taken = column.take(pa.array(used))
    raw, bounds = kernel.utf8(taken)
    word, owner = _words(raw, bounds)
    d, s, w = shingles(word, owner, idf, len(used))
    weight = np.bincount(d, w, minlength=len(used))
    p, q = back[: len(x)], back[len(x) :]
    if len(x) > 64:
        # sqrt(u * v) >= min(u, v), so a matrix product bounds what two texts share
        name, place = np.unique(s, return_inverse=True)
        bound = np.zeros((len(used), len(used)), np.float32)
        root = np.sqrt(w)
        for at in range(0, len(name), 8_192):
            part = (place >= at) & (place < at + 8_192)
            dense = np.zeros((len(used), min(8_192, len(name) - at)), np.float32)
            dense[d[part], place[part] - at] = root[part]
            bound += dense @ dense.T
        may = bound[p, q] * 1.0001 >= (least - 1e-6) / (1 + least) * (weight[p] + weight[q])
        x, y, p, q = x[may], y[may], p[may], q[may]
    sim = similarity(taken.take(pa.array(p)), taken.take(pa.array(q)), idf) if len(x) else np.empty(0)
    good = sim >= least - 1e-6
    return x[good], y[good]


def across(named: DataFrame, held: DataFrame, idf: np.ndarray, least: float, block: int = 200) -> DataFrame:
    """Links (a, b) between rows of one bucket that bear different labels.

    ``named`` has (key, doc_id, label).  In a bucket with several labels the rows
    without its most frequent one meet all rows of other labels, in blocks of at most
    about ``block`` by ``block`` texts, so a large bucket is many tasks and no pair
    becomes a row unless it is a link.
    """
    shares = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = shares.groupBy("key").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("labels"))
    count = [F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("ni"), F.ceil(F.col("n") / block).cast("int").alias("nj")]
    main = kernel.cut(main.where("labels > 1").select("key", "main", *count))
    mixed = kernel.cut(named.join(main, "key"))
    at = F.xxhash64("doc_id", F.lit(5))
    minor = mixed.where("label <> main").withColumn("i", F.pmod(at, F.col("ni")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)))
    other = mixed.withColumn("j", F.pmod(at, F.col("nj")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)))
    rows = minor.select("key", "i", "j", F.lit(True).alias("side"), "doc_id", "label").union(other.select("key", "i", "j", F.lit(False).alias("side"), "doc_id", "label"))
    rows = rows.join(held, "doc_id").select("key", "i", "j", "side", "doc_id", "label", "total", "keys", "text")

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def work(t: pa.Table):
            t = t.combine_chunks()
            group = np.stack([t.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cuts = np.append(np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])), len(group))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = t.slice(lo, hi - lo)
                doc, side = part.column("doc_id").to_numpy(), part.column("side").to_numpy()
                if side.all() or not side.any():
                    continue
                keys = part.column("keys").combine_chunks()
                keys = keys.flatten().to_numpy().reshape(len(doc), -1)
                x, y = _pairs_across(group[lo, 0], side, doc, part.column("total").to_numpy(), part.column("label").to_numpy(), keys, part.column("text").combine_chunks(), idf, least)
                found.append((doc[x], doc[y]))

        def out():
            a, b = (np.concatenate(c) for c in zip(*found, strict=True))
            found.clear()
            return kernel.batch("a b", pa.array(a, pa.int64()), pa.array(b, pa.int64()))

        def same(x: pa.RecordBatch, y: pa.RecordBatch) -> bool:
            return all(x.column(c)[-1] == y.column(c)[0] for c in range(3))

        for b in batches:
            if not b.num_rows:
                continue
            # a block pair may go on in the next batch: keep its rows for then
            edge = b.num_rows - 1
            tail = [b.column(c) for c in range(3)]
            while edge and all(tail[c][edge - 1] == tail[c][b.num_rows - 1] for c in range(3)):
                edge -= 1
            if edge == 0 and waiting and same(waiting[-1], b):
                waiting.append(b)
                continue
            head = [*waiting, b.slice(0, edge)]
            work(pa.Table.from_batches(head))
            waiting = [b.slice(edge)]
            if found:
                yield out()
        if waiting:
            work(pa.Table.from_batches(waiting))
        if found:
            yield out()

    n = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, kept) of every document id."""
    texts = kernel.texts_of(docs, id_col, text)
    idf = word_idf(texts)
    signed = kernel.stored(signatures(texts.where("doc_id IS NOT NULL AND text IS NOT NULL"), idf, bands, rows), "signed")
    row = F.min(F.struct("doc_id", "total", "keys")).alias("row")
    once = kernel.stored(signed.groupBy("same").agg(row).select("same", "row.*"), "once")

    member = once.select(F.explode("keys").alias("key"), "doc_id", "total")
    head = member.groupBy("key").agg(F.min(F.struct("doc_id", "total")).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    head = kernel.cut(head.select("key", F.col("head.doc_id").alias("b"), F.col("head.total").alias("bt")))
    bucket = kernel.cut(member.join(head, "key"))
    close = F.least("total", "bt") >= F.lit(least - 1e-6) * F.greatest("total", "bt")
    star = kernel.cut(bucket.where((F.col("doc_id") != F.col("b")) & close).select(F.col("doc_id").alias("a"), "b").distinct())

    inside = star.select(F.explode(F.array("a", "b")).alias("doc_id")).union(bucket.select("doc_id")).distinct()
    wanted = texts.where("text IS NOT NULL").join(inside, "doc_id", "left_semi")
    held = kernel.stored(wanted, "texts")
    links = kernel.cut(verified(star, held, idf, least))

    label = components(links)
    named = kernel.cut(bucket.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    late = across(named, held.join(once.select("doc_id", "total", "keys"), "doc_id"), idf, least)

    copies = signed.join(once.select("same", F.col("doc_id").alias("b")), "same").select(F.col("doc_id").alias("a"), "b").where("a <> b").distinct()
    label = components(links.union(late).union(copies))
    ids = texts.where("doc_id IS NOT NULL").select("doc_id").distinct()
    found = ids.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("class_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))
