"""Vector operators on a table with vectors of several lengths."""

import numpy as np

from catalith.llm import metricjoin, vptree


def mixed():
    """Sixty vectors of 8 components, and twenty of 5 with two equal ones."""
    rng = np.random.default_rng(5)
    long, short = rng.normal(size=(60, 8)), rng.normal(size=(20, 5))
    long[30:40] = long[:10] + rng.normal(scale=0.1, size=(10, 8))
    short[11] = short[3]
    short[12] = short[3] + 0.05
    return [(i, v.tolist()) for i, v in enumerate(long)], [(100 + i, v.tolist()) for i, v in enumerate(short)]


def cosines(rows):
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_links_of_every_length(spark):
    groups = mixed()
    df = spark.createDataFrame([r for g in groups for r in g], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in metricjoin.links(df).collect()}
    assert len(got) == 80
    for rows in groups:
        near = cosines(rows) >= 0.9
        np.fill_diagonal(near, False)
        label = np.array([i for i, _ in rows])
        for _ in rows:
            label = np.minimum(label, np.where(near, label[None, :], 1_000).min(axis=1))
        for at, (i, _) in enumerate(rows):
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[at].sum(), label[at], label[at] == i)
    assert got[111].component_id == 103 and not got[111].kept


def test_search_in_every_length(spark):
    groups = mixed()
    df = spark.createDataFrame([r for g in groups for r in g], "vec_id long, embedding array<double>")
    got = {}
    for r in vptree.nearest(df, df.where("vec_id % 10 = 1"), factor=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {1, 11, 21, 31, 41, 51, 101, 111}
    for rows in groups:
        sims = cosines(rows)
        for at, (q, _) in enumerate(rows):
            if q in got:
                want = sorted((-round(sims[at, j], 12), i) for j, (i, _) in enumerate(rows) if i != q)[:5]
                assert sorted(got[q]) == [(n + 1, i) for n, (_, i) in enumerate(want)]
