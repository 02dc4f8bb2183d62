"""Vector operators against brute force, with odd vectors and many equal ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import metricjoin, vptree

ODD = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] * 8), (905, [float("inf")] + [0.0] * 7), (906, [1.0, 2.0]), (None, [1.0] * 8)]


def vectors(n=600, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 8))
    base[n // 2 :] = base[rng.integers(0, 40, n - n // 2)] + rng.normal(scale=0.15, size=(n - n // 2, 8))
    x = base.astype(np.float32).astype(float)
    x[100:200] = x[7]  # many equal ones
    x[200:210] = 2 * x[7]
    return [(i, v.tolist()) for i, v in enumerate(x)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.select("*", F.lit(1).alias("label"), F.lit(0).alias("cell"), F.lit("q").alias("v"))


def cosines(rows):
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


@pytest.mark.parametrize("rows_per_shard", [64, 10_000])
def test_search(spark, monkeypatch, rows_per_shard):
    monkeypatch.setattr(vptree, "SHARD_ROWS", rows_per_shard)
    monkeypatch.setattr(vptree, "ASKED", rows_per_shard // 8)  # the queries of a shard are several tasks
    rows = vectors()
    df = frame(spark, [*rows, *ODD, rows[3]])
    ask = df.where("vec_id % 20 = 0 OR vec_id = 150 OR vec_id >= 900")
    sims = cosines(rows)
    for factor, least in ((1.0, 1.0), (1.3, 0.9)):
        got = {}
        for r in vptree.nearest(df, ask, factor=factor).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert set(got) == {i for i in range(600) if i % 20 == 0} | {150}
        hits = 0
        for q, found in got.items():
            found.sort()
            assert [f[0] for f in found] == [1, 2, 3, 4, 5] and q not in [f[1] for f in found]
            assert all(abs(sims[q, i] - s) < 1e-12 for _, i, s in found)
            want = sorted((-round(sims[q, j], 12), j) for j in range(600) if j != q)[:5]
            hits += len({j for _, j in want} & {f[1] for f in found}) if factor > 1 else sum(abs(-w[0] - f[2]) < 1e-9 for w, f in zip(want, found))
        assert hits >= least * 5 * len(got)
    few = frame(spark, rows[:3])
    assert vptree.nearest(few, few).count() == 6
    assert vptree.nearest(df.limit(0), ask).count() == 0


def test_tree_with_factor_one_is_exact():
    rng = np.random.default_rng(1)
    x = vptree.directions([v.tobytes() for v in rng.normal(size=(800, 5))])
    q = x[::13]
    found, far = vptree.search_shard(x, np.arange(800), q, np.full(len(q), np.inf), 4, 1.0)
    want = np.sort(vptree.chords(q, x), axis=1)[:, :4]
    assert np.allclose(far, want) and (found >= 0).all()


@pytest.mark.parametrize("block", [2_000, 10_000_000])
def test_links(spark, monkeypatch, block):
    monkeypatch.setattr(metricjoin, "BLOCK_BYTES", block)
    rows = vectors()
    got = {r.vec_id: r for r in metricjoin.links(frame(spark, [*rows, *ODD, rows[3]])).collect()}
    near = cosines(rows) >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(600)
    for _ in range(600):
        new = np.minimum(label, np.where(near, label[None, :], 600).min(axis=1))
        if (new == label).all():
            break
        label = new
    for i in range(600):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), label[i], label[i] == i)
    for i in range(900, 907):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert len(got) == 607
    assert metricjoin.links(frame(spark, [])).count() == 0 and metricjoin.links(frame(spark, ODD[:6])).count() == 6
