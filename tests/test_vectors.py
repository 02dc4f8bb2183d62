"""Vector search against brute force, on both physical ways."""

import math
import random

import pytest
from pyspark.sql import functions as F

from catalith.functions.vectors import cosine, format_vector, parse_vector
from catalith.operators import vector as V
from catalith.sources import cells

SCHEMA = "id long, grp string, embedding array<float>"


def corpus_rows(n=80, dims=6, seed=3):
    rnd = random.Random(seed)
    rows = [(i, f"g{rnd.randrange(4)}", [float(rnd.randrange(-3, 4)) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, "g0", rows[i][2]) for i in range(5)]  # exact ties
    return rows + [(900, "g1", [0.0] * dims), (901, "g1", None)]


def brute(corpus, requests, k, floor=None, allowed=None, per_group=False):
    out = []
    for qid, q in requests:
        scored = []
        for i, grp, v in corpus:
            if v is None or not any(v) or (allowed is not None and grp not in allowed[qid]):
                continue
            dot = sum(a * b for a, b in zip(q, v))
            sim = round(dot / (math.sqrt(sum(a * a for a in q)) * math.sqrt(sum(b * b for b in v))), 12)
            if floor is None or sim >= floor:
                scored.append((grp if per_group else "", -sim, i))
        scored.sort()
        seen = {}
        for grp, _, i in scored:
            seen[grp] = seen.get(grp, 0) + 1
            if seen[grp] <= k:
                out.append((qid, i, seen[grp]))
    return sorted(out)


REQUESTS = [(1, [1.0, 2.0, 0.0, -1.0, 3.0, 1.0]), (2, [0.0, -1.0, 2.0, 2.0, 0.0, 1.0])]


@pytest.fixture(scope="module")
def frames(spark):
    rows = corpus_rows()
    corpus = spark.createDataFrame(rows, SCHEMA).repartition(5)
    requests = spark.createDataFrame(REQUESTS, "qid long, vector array<float>")
    return rows, corpus, requests


def got(df):
    return sorted((r["qid"], r["id"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("limit", [V.MAX_CLOSURE_FLOATS, 0], ids=["closure", "blocks"])
def test_topk_both_ways(frames, limit, monkeypatch):
    rows, corpus, requests = frames
    monkeypatch.setattr(V, "CORPUS_BLOCK", 20)
    monkeypatch.setattr(V, "REQUEST_BLOCK", 2_048)
    for k in (1, 4, 500):
        assert got(V.vector_topk(corpus, requests, k, max_closure_floats=limit)) == brute(rows, REQUESTS, k)
    assert got(V.vector_topk(corpus, requests, 3, floor=0.5, max_closure_floats=limit)) == brute(rows, REQUESTS, 3, 0.5)
    found = V.vector_topk_per_group(corpus, requests, 2, group_col="grp", max_closure_floats=limit)
    assert got(found) == brute(rows, REQUESTS, 2, per_group=True)


def test_groups_and_empty_corpus(frames):
    rows, corpus, requests = frames
    asked = requests.withColumn("gs", F.when(F.col("qid") == 1, F.array(F.lit("g1"))).otherwise(F.array(F.lit("g2"), F.lit("g3"))))
    found = V.vector_topk(corpus, asked, 3, group_col="grp", request_groups="gs")
    assert got(found) == brute(rows, REQUESTS, 3, allowed={1: {"g1"}, 2: {"g2", "g3"}})
    assert V.vector_topk(corpus.limit(0), requests, 3).count() == 0


def test_limit_then_floor_differs_from_floor_then_limit(spark, frames):
    rows, corpus, requests = frames
    tables = corpus.withColumn("name", F.lit("n")).withColumn("schema_name", F.lit("")).withColumn("description", F.lit("x" * 300))
    hits = V.semantic_table_search(tables, requests, 5, min_similarity=0.9).collect()
    limited = [p for p in brute(rows, REQUESTS, 5) if p in brute(rows, REQUESTS, 500, 0.9)]
    assert sorted((r["qid"], r["id"], r["rank"]) for r in hits) == limited
    assert all(r["schema_name"] == "public" and len(r["description"]) == 200 for r in hits)


def test_fusion_without_intent_uses_question(spark, frames):
    _, corpus, _ = frames
    asked = spark.createDataFrame([(1, REQUESTS[0][1], None), (2, REQUESTS[1][1], REQUESTS[0][1])], "qid long, question_vector array<float>, intent_vector array<float>")
    stored = corpus.withColumn("best_run", F.lit(1))
    rows = V.vector_fusion(stored, asked, corpus_intent="embedding").collect()
    assert all(r["score"] == pytest.approx(r["question_score"]) for r in rows if r["qid"] == 1)
    for r in rows:
        if r["qid"] == 2:
            assert r["score"] == pytest.approx(0.6 * r["intent_score"] + 0.4 * r["question_score"])


def test_all_probes_give_the_exact_answer(frames):
    _, corpus, requests = frames
    usable = corpus.where("id <> 900")
    centres = V.fit_cells(usable, 4)
    celled = V.assign_cells(usable, centres)
    approx = V.vector_topk_approx(celled, centres, requests, 5, probes=4)
    exact = V.vector_topk(usable, requests, 5)
    assert got(approx) == got(exact)
    assert {r["recall"] for r in V.recall(exact, approx).collect()} == {1.0}


def test_large_batches_prune_as_small_ones(spark, frames):
    _, corpus, requests = frames
    usable = corpus.where("id <> 900")
    centres = V.fit_cells(usable, 4)
    celled = V.assign_cells(usable, centres)
    small = V.vector_topk_approx(celled, centres, requests, 5, probes=2)
    blocks = V.vector_topk_approx(celled, centres, requests, 5, probes=2, max_closure_floats=1, request_block=1, corpus_block=7)
    assert got(blocks) == got(small)


def test_stored_cells_skip_files_and_take_insertions(spark, tmp_path):
    rnd = random.Random(11)
    axis = lambda c: [float(c == i) for i in range(8)]
    rows = [(i, [x + rnd.gauss(0, 0.05) for x in axis(i % 8 if i % 3 else 0)]) for i in range(900)]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>")
    centres = spark.createDataFrame([(c, axis(c)) for c in range(8)], "cell int, centre array<double>")
    root = str(tmp_path / "cells")
    with pytest.raises(ValueError):
        cells.read_cells(spark, root)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task
    try:
        assert cells.insert_vectors(corpus.where("id < 500"), centres, root) == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    first = cells.read_cells(spark, root)
    assert first.count() == 500
    # data without its record is not seen, and the next insertion takes its place
    V.assign_cells(corpus, centres).write.partitionBy("cell").parquet(f"{root}/part=1")
    assert cells.read_cells(spark, root).count() == 500
    assert cells.insert_vectors(corpus.where("id >= 500"), centres, root) == 1
    stored = cells.read_cells(spark, root)
    assert stored.count() == 900
    hot = stored.where("cell = 0 AND part = 0").select(F.input_file_name()).distinct().count()
    assert 1 < hot <= cells.SPREAD
    requests = spark.createDataFrame([(1, axis(2)), (2, [x + 0.01 for x in axis(3)])], "qid int, vector array<double>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the metrics of a final adaptive plan are not at hand
    try:
        hits = V.vector_topk_approx(stored, centres, requests, 5, probes=1).select("*")
        leaves = hits._jdf.queryExecution().executedPlan().collectLeaves()
        hits._jdf.javaToPython().count()
        assert leaves.size() == 1
        read = leaves.apply(0).metrics().apply("numFiles").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    probed = stored.where("cell IN (2, 3)").select(F.input_file_name()).distinct().count()
    assert read == probed < len(stored.inputFiles())
    found = got(hits)
    assert found == got(V.vector_topk(corpus, requests, 5))


def test_vector_text_and_cosine(spark):
    df = spark.createDataFrame([("[1,2.5]", [1.0, 0.0]), ("oops", [0.0, 0.0])], "t string, v array<double>")
    rows = df.select(parse_vector("t").alias("p"), cosine("v", F.array(F.lit(2.0), F.lit(0.0))).alias("c"), format_vector("v").alias("f")).collect()
    assert rows[0]["p"] == [1.0, 2.5] and rows[1]["p"] is None
    assert rows[0]["c"] == 1.0 and rows[1]["c"] is None
    assert rows[0]["f"] == "[1.0,0.0]"


def test_vectors_of_two_lengths_are_refused(spark, frames):
    _, _, requests = frames
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="different length"):
        V.vector_topk(mixed, requests, 1).collect()
