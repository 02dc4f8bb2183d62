"""The query-log fold against a sequential reading of its rules."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalith.operators import querylog as Q

EVENT = st.tuples(
    st.integers(0, 3),  # gap to the previous event
    st.integers(0, 2),
    st.integers(0, 3),
    st.integers(0, 2),
    st.integers(0, 7),
    st.integers(0, 7),
    st.sampled_from([0.0, 0.1, 0.1 + 5e-7, 0.2]),
)


def build(raw):
    """Events as (ms, seq, s, n, t, m, brings, holds, score) in order."""
    out, ms = [], 0
    for seq, (gap, s, n, t, brings, extra, score) in enumerate(raw):
        ms += gap
        out.append((ms, seq, s, n, float(t), -ms, brings, brings | extra, score))
    return out


def sequential(events, state=None):
    core, context = state or (events[0], events[0])
    for e in events:
        if e[2:6] < core[2:6] or e[6] & ~core[7]:
            core = e
        if e[8] > context[8] + 1e-6 or (e[8] >= context[8] and e[0] > context[0]):
            context = e
    return core, context


@settings(max_examples=400, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=24), st.lists(st.integers(1, 6), min_size=1, max_size=24))
def test_slices_compose_to_the_sequential_fold(raw, sizes):
    events = build(raw)
    state, at, i = None, 0, 0
    while at < len(events):
        size = sizes[i % len(sizes)]
        state = Q._advance(state, Q._read_summary(Q._summary_text(events[at : at + size])))
        at, i = at + size, i + 1
    want = sequential(events)
    assert [tuple(x) for x in state] == [tuple(x) for x in want]


@settings(max_examples=400, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=24), st.lists(st.integers(1, 5), min_size=1, max_size=24), st.randoms(use_true_random=False), st.booleans())
def test_summaries_compose_in_any_tree(raw, sizes, rnd, resumed):
    events = build(raw)
    state = None
    if resumed and len(events) > 1:
        state, events = sequential(events[:1]), events[1:]
    parts, at, i = [], 0, 0
    while at < len(events):
        size = sizes[i % len(sizes)]
        parts.append(Q._read_summary(Q._summary_text(events[at : at + size])))
        at, i = at + size, i + 1
    while len(parts) > 1:
        k = rnd.randrange(len(parts) - 1)
        parts[k : k + 2] = [Q._read_summary(json.dumps(Q._composed(parts[k], parts[k + 1])))]
    want = sequential(events, state)
    assert [tuple(x) for x in Q._advance(state, parts[0])] == [tuple(x) for x in want]


def log(spark, rows):
    names = "query_id string, seq long, ts timestamp, status string, steps_count int, execution_time_ms double, verified boolean, quality_gate string, steps_summary string, context_score double"
    df = spark.createDataFrame(rows, names.replace("ts timestamp", "sec long"))
    return df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec")


def random_log(n, keys, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        rows.append(
            (
                key,
                i,
                1_700_000_000 + i // 3,
                rnd.choice(["completed", "error", "running", None]),
                rnd.choice([None, 1, 2, 3]),
                rnd.choice([None, 1.5, 2.5]),
                rnd.choice([True, False, None]),
                rnd.choice(["", "", None, "gate"]),
                rnd.choice(["", None, "steps"]),
                rnd.choice([None, 0.1, 0.5]),
            )
        )
    return rows


def brute(rows):
    out = {}
    for key in {r[0] for r in rows}:
        events = []
        for _, seq, sec, status, steps, time, verified, gate, summary, score in sorted(
            (r for r in rows if r[0] == key), key=lambda r: (r[2], r[1])
        ):
            rank = {"completed": 0, "error": 2}.get(status, 1)
            bits = int(bool(verified)) + (2 if gate else 0) + (4 if summary else 0)
            ms = sec * 1000
            events.append(
                (ms, seq, rank, 10**9 if steps is None else steps, 1e18 if time is None else time, -ms, bits, bits, score or 0.0)
            )
        core, context = sequential(events)
        out[key] = (core[1], context[1], len(events))
    return out


def result(df):
    rows = df.select("query_id", "core.seq", F.col("context.seq").alias("x"), "seen_count").collect()
    return {r[0]: (r[1], r[2], r[3]) for r in rows}


def test_hot_query_folds_like_a_short_one(spark):
    rows = random_log(600, 20, 7)
    df = log(spark, rows)
    want = brute(rows)
    assert result(Q.query_log_fold(df)) == want
    assert result(Q.query_log_fold(df, max_events=25)) == want


def test_resumed_fold_equals_one_fold(spark):
    rows = random_log(300, 10, 11)
    df = log(spark, rows)
    first = Q.query_log_fold(df.where("seq < 120"))
    for limit in (10_000, 5):
        assert result(Q.query_log_fold(df.where("seq >= 120"), first, max_events=limit)) == brute(rows)


def test_verified_event_of_worse_rank_and_late_tie(spark):
    rows = [
        ("a", 1, 10, "completed", 1, 1.0, False, "", "", 0.5),
        ("a", 2, 11, "error", 9, 9.0, True, "", "", None),
        ("b", 1, 10, "completed", 1, 1.0, False, "", "", 0.5),
        ("b", 2, 12, "completed", 1, 1.0, False, "", "", 0.5),
    ]
    assert result(Q.query_log_fold(log(spark, rows))) == {"a": (2, 1, 2), "b": (2, 2, 2)}


def test_rounds_of_summaries_equal_one_fold(spark):
    """One query in 27 slices, three of which meet in a task."""
    rows = [("hot", *r[1:]) for r in random_log(400, 5, 13)]
    ready = Q.prepared(log(spark, rows)).dropDuplicates(["query_id", "ms", "seq"])
    got = [(r["core"]["seq"], r["context"]["seq"]) for r in Q.fold_long(ready, None, 27, fan_in=3).collect()]
    assert got == [brute(rows)["hot"][:2]]
