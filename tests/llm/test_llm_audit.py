"""Filter interactions against running every order document by document."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from catalith.llm import audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    counts = Counter()
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and t in first and i > first[t],
        }
        part, failed = lang or "", [f for f in "ABCDE" if fails[f]]
        for order in map("".join, permutations("ABCDE")):
            gone = min([order.index(f) + 1 for f in failed], default=6)
            for step, f in enumerate(order, 1):
                key = part, order, step
                counts[key, "kept"] += gone > step
                counts[key, "removed"] += gone == step
                counts[key, "redundant"] += fails[f] and gone < step
                counts[key, "unique_fails"] += failed == [f]
                counts[key, "good_lost"] += gone == step and i in good
                counts[key, "toxic_lost"] += gone == step and i in toxic
                counts[(part, f), "shapley"] += gone == step
    return counts


def check(spark, docs, labels):
    masked = audit.masks(spark.createDataFrame(docs, DOCS).repartition(3))
    got = audit.audit(audit.weighted(masked, spark.createDataFrame(labels, LABELS))).collect()
    want = plain(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})
    for r in got:
        key = r.part, r.filter_order, r.step
        assert [r[c] for c in audit.COUNTS[:-1]] == [want[key, c] for c in audit.COUNTS[:-1]], key
        assert r.shapley == want[(r.part, r.filter_order[r.step - 1]), "shapley"]


def test_equals_running_every_order(spark):
    rng = random.Random(1)
    pool = [f"w{i}" for i in range(300)]
    texts = ["", None, " \t\n", "x y", "A" * 50, "\x1fa\x1f b", "é" * 9 + "Z"]
    for _ in range(80):
        words = rng.choices(pool, k=rng.choice([5, 99, 100, 101, 130])) if rng.random() < 0.5 else rng.sample(pool, 120)
        text = rng.choice([" ", "\n", "\x0b"]).join(words)
        texts.append(text.upper() if rng.random() < 0.2 else text + rng.choice(["", "", " #", "*"]))
    texts += rng.choices(texts, k=60)
    docs = [(rng.choice([None, i, i, i, 3]), t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    docs += docs[:5]
    labels = [(rng.randrange(len(docs)), rng.choice([0, 1, None, 2]), rng.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1)]
    check(spark, docs, labels)


def test_edges_of_the_conditions(spark):
    words = [f"v{i}" for i in range(100)]
    docs = [(i, t, "x") for i, t in enumerate([" ".join(words), " ".join(words[:99]), " ".join(words[:80] + words[:20]), " ".join(words[:79] + words[:21]), "A" + "b" * 9, "A" + "b" * 8, " ".join(words)])]
    check(spark, docs, [(6, 1, 1), (6, 0, 0)])


def test_no_rows(spark):
    masked = audit.masks(spark.createDataFrame([], DOCS))
    assert audit.audit(audit.weighted(masked, spark.createDataFrame([], LABELS))).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", "en", "x", 9, True), (2, "a", "en", "y", 8, False)], DOCS + ", digest string, mask int, first boolean")
    rows = audit.masks(docs).collect()
    assert sorted((r.doc_id, r.part, r["mask"]) for r in rows) == [(1, "en", 1), (2, "en", 17)]


@pytest.mark.parametrize("k", [1, 3])
def test_other_numbers_of_filters(k):
    rng = np.random.default_rng(k)
    mask, weights = np.arange(1 << k), rng.integers(0, 50, (1 << k, 3))
    found = audit.interactions(mask, weights, k)
    order, _ = audit.orders_of(k)
    for o, names in enumerate(order):
        left = set(mask.tolist())
        for s, f in enumerate(names):
            hit = {m for m in left if m >> f & 1}
            left -= hit
            assert found["removed"][o, s] == weights[sorted(hit), 0].sum()
            assert found["kept"][o, s] == weights[sorted(left), 0].sum()
    for f in range(k):
        assert (found["shapley"][order == f] == found["removed"][order == f].sum()).all()
