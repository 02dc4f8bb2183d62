"""Short queries that are folded together, as texts."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalith.operators.querylog import query_log_fold
from catalith.streaming import querylog as streaming
from test_fold import EVENT, build, log, random_log, sequential
from test_streaming import Values


class Told:
    """States in memory that take one text a value, and the names of their calls."""

    def __init__(self):
        self.calls, self.states = [], {}

    def getValueState(self, name, *_):  # noqa: N802
        told = self

        class Own(Values):
            def __getattribute__(self, called):
                if called in ("get", "update", "getValue", "containsKey", "updateValue", "removeKey"):
                    told.calls.append((name, called))
                return super().__getattribute__(called)

        return self.states.setdefault(name, Own())

    getMapState = getValueState


def folds(segment, page):
    told, fold = Told(), streaming.PageFold(False, False, segment, page)
    fold.init(told)
    return told, fold


def given_rows(part):
    return [(0, q, json.dumps(e), f"{q} {e[1]}") for q, e in part]


def kept(told):
    found = {e["q"]: e["r"] for e in json.loads((told.states["page"].value or ['{"queries":[]}'])[0])["queries"]}
    own = {q: json.loads(v[0])["r"] for (q,), v in told.states["own"].held.items()}
    assert not set(found) & set(own)
    return found | own


@settings(max_examples=120, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=40), st.integers(1, 5), st.integers(0, 12), st.randoms(), st.lists(st.integers(1, 9), min_size=1, max_size=20))
def test_pages_equal_the_sequential_fold(raw, segment, page, rng, sizes):
    order = [(rng.choice(["a", "b", "c", None]), e) for e in build(raw)]
    order += rng.sample(order, len(order) // 2)
    rng.shuffle(order)
    (told, fold), at, i = folds(segment, page), 0, 0
    while at < len(order):
        part = order[at : at + sizes[i % len(sizes)]]
        at, i = at + len(part), i + 1
        was = kept(told) if i > 1 else {}
        out = {r[0]: json.loads(r[1]) for r in fold.handleInputRows((0,), given_rows(part), None)}
        now = kept(told)
        assert out == {q: r for q, r in now.items() if was.get(q) != r}
        for query, row in now.items():
            seen = sorted({e for q, e in order[:at] if q == query})
            want = sequential(seen)
            assert [(row[n]["ms"], row[n]["seq"]) for n in ("core", "context")] == [w[:2] for w in want]
            assert (row["seen_count"], row["created_ms"], row["last_seen_ms"]) == (len(seen), seen[0][0], seen[-1][0])
            assert row["own"] == f"{query} {want[0][1]}"


def test_short_queries_of_a_page_are_read_and_written_at_once():
    told, fold = folds(512, 512)
    for ms in range(4):
        told.calls.clear()
        part = [(f"q{q}", (ms, q, 1, 1, 1.0, -ms, 0, 0, 0.0)) for q in range(100)]
        assert len(list(fold.handleInputRows((0,), given_rows(part), None))) == 100
        assert told.calls == [("page", "get"), ("page", "update")]
    told.calls.clear()
    assert not list(fold.handleInputRows((0,), given_rows(part), None)) and told.calls == [("page", "get")]


def test_streamed_rows_keep_every_column(spark, tmp_path):
    rows = random_log(200, 12, 5)
    events = log(spark, rows).withColumns(
        {
            "question": F.concat(F.lit('why "'), "seq", F.lit("\\ ä한\n")),
            "context_features": F.when(F.col("seq") % 2 > 0, F.concat(F.lit("f"), "seq")),
            "sql_text": F.expr("CASE WHEN seq % 3 > 0 THEN concat('{\"a\": ', seq, '}') END"),
            "row_count": F.expr("CAST(seq % 5 AS INT)"),
            "verified_confidence": F.expr("CASE WHEN seq % 4 = 0 THEN double('NaN') ELSE seq / 7 END"),
            "verified_source": F.expr("timestamp_micros(1700000000123456 + seq)"),
            "value_mappings": F.expr("CASE WHEN seq % 4 > 0 THEN array(named_struct('natural_value', concat('v', seq))) END"),
        }
    )
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    for part in range(3):
        events.where(F.col("seq") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    schema = streaming.folded_schema(events)
    stream = streaming.read_event_files(spark, folder, events.schema, "*.parquet", max_files=1)
    streaming.start_fold(stream, check, available_now=True, segment=16, pages=2).awaitTermination()
    got = streaming.read_folded(spark, check, schema)
    assert got.columns == schema.names and [t for _, t in got.dtypes] == [f.dataType.simpleString() for f in schema.fields]
    want = query_log_fold(events).select(*schema.names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
