"""Streams that come late, out of order and more than once."""

import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.operators.querylog import query_log_fold
from catalith.sources import harvest
from catalith.streaming import querylog as streaming
from test_fold import EVENT, build, log, random_log, sequential


NAMES = ["query_id", "core", "context", "status", "seen_count", "created_ms", "last_seen_ms"]


def written(spark, parts, folder):
    for part in parts:
        log(spark, part).coalesce(1).write.mode("append").parquet(folder)


def test_late_and_repeated_events(spark, tmp_path):
    rows = random_log(300, 12, 7)
    events = log(spark, rows)
    order = list(rows)
    random.Random(3).shuffle(order)
    parts = [order[200:], order[:100], order[100:200], order[50:250], sorted(rows, key=lambda r: r[2])[:40]]
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    written(spark, parts[:3], folder)
    schema = streaming.folded_schema(events)
    assert streaming.read_folded(spark, check, schema).count() == 0
    stream = streaming.read_event_files(spark, folder, events.schema, "*.parquet", max_files=1)
    streaming.start_fold(stream, check, available_now=True, segment=4).awaitTermination()
    written(spark, parts[3:], folder)
    streaming.start_fold(stream, check, available_now=True, segment=4).awaitTermination()  # goes on from the checkpoint
    got = streaming.read_folded(spark, check, schema).select(*NAMES).collect()
    want = query_log_fold(events).select(*NAMES).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


class Values:
    """A value or map state in memory, which counts what is read."""

    reads = 0

    def __init__(self):
        self.held, self.value = {}, None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def getValue(self, key):  # noqa: N802
        Values.reads += 1
        return self.held.get(key)

    def containsKey(self, key):  # noqa: N802
        return key in self.held

    def updateValue(self, key, value):  # noqa: N802
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]


class Handle:
    def getValueState(self, *_):  # noqa: N802
        return Values()

    getMapState = getValueState


def processor(segment):
    names = ["query_id", "core", "context", "seen_count", "created_ms", "last_seen_ms"]
    result = T.StructType([T.StructField(n, T.StringType()) for n in names])
    fold = streaming.QueryFold(T.StructType([]), result, segment)
    fold.init(Handle())
    return fold


@settings(max_examples=150, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=40), st.integers(1, 5), st.randoms(), st.lists(st.integers(1, 9), min_size=1, max_size=20))
def test_any_order_of_arrival(raw, segment, rng, sizes):
    events = build(raw)
    order = events + rng.sample(events, len(events) // 2)
    rng.shuffle(order)
    fold, at, i, seen = processor(segment), 0, 0, []
    while at < len(order):
        part = order[at : at + sizes[i % len(sizes)]]
        at, i = at + len(part), i + 1
        seen = sorted({*seen, *part})
        out = list(fold.handleInputRows(("q",), [("q", *e) for e in part], None))
        want = sequential(seen)
        row = fold.row.get()
        assert (row[0][:2], row[1][:2]) == (want[0][:2], want[1][:2])
        assert row[2:] == (len(seen), seen[0][0], seen[-1][0])
        assert not out or tuple(out[0])[1:] == row


def test_cost_of_an_event_in_order_does_not_grow():
    fold = processor(8)
    for first in (0, 2000):
        for ms in range(first, first + 1000):
            Values.reads = 0
            list(fold.handleInputRows(("q",), [("q", ms, ms, 1, 1, 1.0, -ms, 0, 0, 0.0)], None))
            assert Values.reads < 12


def test_pairs_count_once_for_ever(spark, tmp_path):
    rows = [(q % 30, q % 7, "completed" if q % 3 else "error") for q in range(200)]
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    uses = spark.createDataFrame(rows, "query_id long, table_id long, status string")
    assert streaming.read_counts(spark, check).count() == 0
    os.makedirs(folder)
    stream = streaming.read_event_files(spark, folder, uses.schema, "*.parquet", max_files=1)
    for half in range(2):
        for batch in range(2):
            uses.where(F.col("query_id") % 2 == batch).coalesce(1).write.mode("append").parquet(folder)
        streaming.start_usage_counts(stream, check, available_now=True).awaitTermination()
    want = {}
    for q, t, s in set(rows):
        want[t] = want.get(t, 0) + (s == "completed")
    got = {r.table_id: r.usage_count for r in streaming.read_counts(spark, check).collect()}
    assert got == {t: n for t, n in want.items() if n}


def test_event_delivered_twice_is_one(spark):
    events = log(spark, random_log(60, 5, 2))
    once, twice = (sorted(map(str, query_log_fold(e).collect())) for e in (events, events.union(events)))
    assert once == twice


def test_harvest_keys_hold_the_schema(spark):
    columns = spark.createDataFrame([("a", "t", "id"), ("b", "t", "id")], "table_schema string, table_name string, column_name string")
    constraints = spark.createDataFrame([("pk", "a", "PRIMARY KEY")], "constraint_name string, table_schema string, constraint_type string")
    usage = spark.createDataFrame([("a", "t", "id", "pk")], "table_schema string, table_name string, column_name string, constraint_name string")
    flags = {r.table_schema: r.is_primary_key for r in harvest.harvest_flags(columns, constraints, usage).collect()}
    assert flags == {"a": True, "b": False}
    fks = spark.createDataFrame([(s, "fk", "t", c, "u", c, i) for s in "ab" for i, c in enumerate("xy")], "from_schema string, constraint_name string, from_table string, from_column string, to_table string, to_column string, ordinal int")
    assert sorted(r.position for r in harvest.fk_positions(fks).collect()) == [1, 1, 2, 2]


def test_a_short_query_is_read_and_written_at_once():
    """Three messages for each batch of a short query; one that grows beyond a segment keeps its events."""
    calls = []

    class Told(Values):
        def __getattribute__(self, name):
            if name in ("exists", "get", "update", "getValue", "containsKey", "updateValue", "removeKey"):
                calls.append(name)
            return super().__getattribute__(name)

    class Own:
        def getValueState(self, *_):  # noqa: N802
            return Told()

        getMapState = getValueState

    names = ["query_id", "core", "context", "seen_count", "created_ms", "last_seen_ms"]
    fold = streaming.QueryFold(T.StructType([]), T.StructType([T.StructField(n, T.StringType()) for n in names]), 8)
    fold.init(Own())
    events = [(ms, ms, ms % 3, 1, 1.0, -ms, 0, 0, 0.0) for ms in range(30)]
    for i, e in enumerate(reversed(events)):
        calls.clear()
        list(fold.handleInputRows(("q",), [("q", *e)], None))
        assert i >= 8 or calls == ["get", "update", "update"]
    calls.clear()
    assert list(fold.handleInputRows(("q",), [("q", *events[4])], None)) == []
    want = sequential(events)
    row = fold.row.get()
    assert (row[0][:2], row[1][:2], row[2:]) == (want[0][:2], want[1][:2], (30, 0, 29))
