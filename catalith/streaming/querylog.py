"""Streaming query-log fold and usage counts in Spark's state store.

No event is ever dropped for being late, and a micro-batch costs what its own events
cost, however many batches came before:

* the fold keeps the events of a query in segments of bounded size, in time order, with
  the state of the fold before each.  A new event is put into its segment, and the fold
  goes on from there until a segment starts from the state that it had before; for an
  event in time order that is the last segment alone.  One segment at a time is in memory.
  A query with no more events than a segment holds has them beside its index, so that it
  is read and written at once: every call of the state store is a message to the JVM, and
  so are short queries of one hash together (a page of no more events than a segment).
  Events, state and rows are JSON texts between the JVM and Python, which hands every
  column of a row and every field of a nested state over by itself otherwise; what goes
  with an event is a text that Python never takes apart;
* the counts keep every (query, table) pair that was seen, spread by the pair, and one
  number for each table, which batches add to after a partial aggregation.

Results are read from the state of the last committed batch.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from catalith.operators.querylog import CONTEXT, EPSILON, INSERTED, prepared, query_log_fold

SEGMENT = 512
PAGES = 131_072
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LONG = T.LongType()
# An event in the state: these fields, then the columns that go with it.
_EVENT = T.StructType([T.StructField(n, k) for n, k in zip("ms seq s n t m brings holds score".split(), (_LONG, _LONG, T.IntegerType(), _LONG, T.DoubleType(), _LONG, T.IntegerType(), T.IntegerType(), T.DoubleType()), strict=True)])
_FIELDS = _EVENT.names
_WIDTH = len(_EVENT)
_TEXT = T.StructType([T.StructField("row", T.StringType())])


def read_event_files(spark: SparkSession, folder: str, schema, pattern: str = "*", max_files: int = 1_000) -> DataFrame:
    """File stream of event parquet files, under sub-folders too."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", True).parquet(folder)


def folded_schema(events: DataFrame) -> T.StructType:
    """Schema of the fold's result, without running it."""
    empty = events.sparkSession.createDataFrame([], events.schema)
    return query_log_fold(empty).schema


def _flat(events: DataFrame) -> DataFrame:
    """Prepared events with the fields of the state."""
    ready = prepared(events)
    own = ["ms", "seq", *[F.col(f"rank.{f}").alias(f) for f in ("s", "n", "t", "m")], "brings", "holds", "score"]
    carried = [c for c in ready.columns if c not in ("query_id", "ms", "seq", "rank", "brings", "holds", "score")]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in _EVENT]
    return ready.select("query_id", *own, *carried).select("query_id", *typed, *carried)


class QueryFold(StatefulProcessor):
    """The fold of one query; ``columns`` go with an event, ``result`` is the row of a query."""

    def __init__(self, columns: T.StructType, result: T.StructType, segment: int = SEGMENT):
        self.columns, self.result, self.size = columns, result, segment
        self.names = columns.names

    def init(self, handle) -> None:
        event = T.StructType([*_EVENT.fields, *self.columns.fields])
        place = T.StructType(_EVENT.fields[:2])
        # the starts of the segments, or all events of a short query; how many events there are
        own = [T.StructField("starts", T.ArrayType(place)), T.StructField("rows", T.ArrayType(event)), T.StructField("seen_count", _LONG)]
        self.index = handle.getValueState("index", T.StructType(own))
        self.events = handle.getMapState("events", place, T.StructType([T.StructField("rows", T.ArrayType(event))]))
        self.before = handle.getMapState("before", place, T.StructType([T.StructField("core", event), T.StructField("context", event)]))
        rest = [f for f in self.result.fields if f.name != "query_id"]
        self.row = handle.getValueState("row", T.StructType(rest))

    # -- segments

    def _rows(self, start: tuple) -> list[tuple]:
        return [tuple(e) for e in self.events.getValue(start)[0]]

    def _insert(self, starts: list[tuple], new: list[tuple]) -> tuple[tuple | None, int]:
        """Put sorted events into their segments: the first segment changed, and how many are new."""
        first, added, at = None, 0, 0
        while at < len(new):
            if not starts:
                starts.append(new[0][:2])
                held: list[tuple] = []
                place = 0
            else:
                place = max(bisect_right(starts, new[at][:2]) - 1, 0)
                held = self._rows(starts[place])
            bound = starts[place + 1] if place + 1 < len(starts) else None
            known, fresh = {e[:2] for e in held}, []
            while at < len(new) and (bound is None or new[at][:2] < bound):
                if new[at][:2] not in known:
                    known.add(new[at][:2])
                    fresh.append(new[at])
                at += 1
            if not fresh:
                continue
            added += len(fresh)
            rows = sorted([*held, *fresh], key=lambda e: e[:2])
            old = starts.pop(place)
            if held and rows[0][:2] != old:
                self.events.removeKey(old)
                self._forget(old)
            cuts = [rows[i : i + self.size] for i in range(0, len(rows), self.size)]
            for i, part in enumerate(cuts):
                starts.insert(place + i, part[0][:2])
                self.events.updateValue(part[0][:2], (part,))
                if i or part[0][:2] != old:
                    self._forget(part[0][:2])
            self._touched.update(p[0][:2] for p in cuts)
            lowest = cuts[0][0][:2]
            first = lowest if first is None else min(first, lowest)
        return first, added

    def _forget(self, start: tuple) -> None:
        if self.before.containsKey(start):
            self.before.removeKey(start)

    def _state_at(self, start: tuple) -> tuple | None:
        found = self.before.getValue(start)
        return found and (tuple(found[0]), tuple(found[1]))

    def _refold(self, starts: list[tuple], first: tuple) -> tuple | None:
        """Fold from the segment before ``first`` on; the last state, or None if it stays as it was."""
        at = starts.index(first)
        while at and self._state_at(starts[at]) is None:
            at -= 1
        state = self._state_at(starts[at]) if at else None
        while at < len(starts):
            for e in self._rows(starts[at]):
                state = _advanced(state, e)
            self._touched.discard(starts[at])
            at += 1
            if at < len(starts):
                if self._state_at(starts[at]) == state and starts[at] not in self._touched:
                    later = [s for s in starts[at:] if s in self._touched]
                    if not later:
                        return None
                    at = starts.index(later[0])
                    state = self._state_at(starts[at])
                    continue
                self.before.updateValue(starts[at], state)
        return state

    # -- rows

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.index.get()
        starts, held, total = ([tuple(s) for s in known[0]], [tuple(e) for e in known[1]], known[2]) if known else ([], [], 0)
        events = (tuple(r[1:]) for r in rows)
        if not starts:
            own = {e[:2]: e for e in held}
            first = list(islice(events, self.size + 1))
            for e in first:
                own.setdefault(e[:2], e)
            if len(first) <= self.size and len(own) <= self.size:
                if len(own) > total:
                    yield self._stored(key, [], sorted(own.values(), key=lambda e: e[:2]), len(own))
                return
            events, total = chain(held, first, events), 0
        yield from self._segmented(key, starts, events, total)

    def _segmented(self, key, starts: list[tuple], events: Iterator[tuple], total: int) -> Iterator[Row]:
        """Put the events into the segments of a long query and fold from the first one changed."""
        self._touched: set[tuple] = set()
        added, chunk, firsts = 0, [], []

        def put():
            nonlocal added
            first, n = self._insert(starts, sorted(chunk, key=lambda e: e[:2]))
            chunk.clear()
            added += n
            if first is not None:
                firsts.append(first)

        for e in events:
            chunk.append(e)
            if len(chunk) >= 8 * self.size:
                put()
        put()
        if not added:
            return
        lowest = starts[max(bisect_right(starts, min(firsts)) - 1, 0)]
        state = self._refold(starts, lowest)
        if state is None:
            state = self._events_of(self.row.get(), starts)
        ends = self._rows(starts[0])[:1] + self._rows(starts[-1])[-1:]
        yield self._stored(key, starts, ends, total + added, state)

    def _stored(self, key, starts: list[tuple], rows: list[tuple], total: int, state: tuple | None = None) -> Row:
        """Keep the index and the row of a query; a short one is folded from all its events."""
        self.index.update((starts, [] if starts else rows, total))
        if not starts:
            for e in rows:
                state = _advanced(state, e)
        out = self._row(state, rows[0], rows[-1], total)
        self.row.update(out)
        return Row(*["query_id", *[f.name for f in self.result.fields if f.name != "query_id"]])(key[0], *out)

    def _events_of(self, row, starts: list[tuple]) -> tuple:
        """The core and context events of a stored row."""
        found = []
        for place in self._places(row):
            own = self._rows(starts[max(bisect_right(starts, place) - 1, 0)])
            found.append(next(e for e in own if e[:2] == place))
        return tuple(found)

    def _places(self, row) -> list[tuple]:
        """Time and sequence of the core and the context of a stored row."""
        names = [f.name for f in self.result.fields if f.name != "query_id"]
        held = [getattr(row, n) if hasattr(row, n) else row[names.index(n)] for n in ("core", "context")]
        return [(place[0], place[1]) for place in held]

    def _row(self, state: tuple, first: tuple, last: tuple, total: int) -> tuple:
        core, context = state
        value = {"core": _struct(core), "context": _struct(context), "seen_count": total, "created_ms": first[0], "last_seen_ms": last[0]}
        for name, event in [(n, context if n in CONTEXT else first if n in INSERTED else core) for n in self.names]:
            value[name] = event[_WIDTH + self.names.index(name)]
        return tuple(value[f.name] for f in self.result.fields if f.name != "query_id")

    def close(self) -> None:
        pass


def _struct(event: tuple) -> tuple:
    ms, seq, s, n, t, m, brings, holds, score = event[:_WIDTH]
    return ms, seq, (s, n, t, m), brings, holds, score


def _advanced(state: tuple | None, event: tuple) -> tuple:
    """The (core, context) events after ``event``; the rules of the batch fold."""
    if state is None:
        return event, event
    core, context = state
    if event[2:6] < core[2:6] or event[6] & ~core[7]:
        core = event
    if event[8] > context[8] + EPSILON or (event[8] >= context[8] and event[0] > context[0]):
        context = event
    return core, context


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


class _Query:
    """Index and row of the query that is folded, in memory."""

    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value: tuple) -> None:
        self.value = value


class _Segments:
    """The map state of the segments of all queries, seen from the query that is folded."""

    def __init__(self, state):
        self.state, self.query = state, None

    def getValue(self, start: tuple):  # noqa: N802
        found = self.state.getValue((self.query, *start))
        return found and json.loads(found[0])

    def containsKey(self, start: tuple) -> bool:  # noqa: N802
        return self.state.containsKey((self.query, *start))

    def updateValue(self, start: tuple, value: tuple) -> None:  # noqa: N802
        self.state.updateValue((self.query, *start), (_text(value),))

    def removeKey(self, start: tuple) -> None:  # noqa: N802
        self.state.removeKey((self.query, *start))


class _RowFold(QueryFold):
    """The fold of one query of a page; its row is a mapping, and what goes with an event one text."""

    def __init__(self, first: bool, context: bool, segment: int):
        super().__init__(T.StructType([T.StructField("carried", T.StringType())]), _TEXT, segment)
        self.first, self.context = first, context

    def _row(self, state: tuple, first: tuple, last: tuple, total: int) -> tuple:
        core, context = state
        value = {"core": dict(zip(_FIELDS, core)), "context": dict(zip(_FIELDS, context)), "own": core[_WIDTH], "seen_count": total, "created_ms": first[0], "last_seen_ms": last[0]}
        if self.first:
            value["first"] = first[_WIDTH]
        if self.context:
            value["other"] = context[_WIDTH]
        return (value,)

    def _places(self, row) -> list[tuple]:
        return [(row[0][name]["ms"], row[0][name]["seq"]) for name in ("core", "context")]


class PageFold(StatefulProcessor):
    """``QueryFold`` for the queries of a page: rows ``(page, query_id, event, carried)`` of texts to rows ``(query_id, row)``.

    A page holds its short queries together, up to as many events as a segment holds, so a
    batch reads and writes them with one message each.  Other queries have a value of their own.
    """

    result = T.StructType([T.StructField("query_id", T.StringType()), *_TEXT.fields])

    def __init__(self, first: bool, context: bool, segment: int = SEGMENT, page: int = SEGMENT):
        self.fold, self.size = _RowFold(first, context, segment), page

    def init(self, handle) -> None:
        name = T.StructType(self.result.fields[:1])
        place = T.StructType([*name.fields, *_EVENT.fields[:2]])
        self.page = handle.getValueState("page", _TEXT)
        self.own = handle.getMapState("own", name, _TEXT)
        self.fold.events = _Segments(handle.getMapState("events", place, _TEXT))
        self.fold.before = _Segments(handle.getMapState("before", place, _TEXT))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self.page.get()
        page = json.loads(found[0]) if found else {"queries": [], "more": False}
        held = {entry["q"]: entry for entry in page["queries"]}
        room = self.size - sum(len(entry["h"][1]) for entry in held.values())
        changed, more, out = False, page["more"], {}
        rows = iter(rows)
        while chunk := list(islice(rows, 8 * self.fold.size)):
            told: dict[str, list[tuple]] = {}
            for r in chunk:
                told.setdefault(r[1], []).append((None, *json.loads(r[2]), r[3]))
            for query, events in told.items():
                entry = held.get(query)
                if entry is None and more:
                    own = self.own.getValue((query,))
                    entry = own and json.loads(own[0])
                new = self._folded(query, entry, events, timerValues)
                if new is None:
                    continue
                out[query] = new["r"]
                before = len(held.pop(query)["h"][1]) if query in held else 0
                changed = changed or before > 0
                room += before
                # a query that has a value of its own keeps it
                if (before or entry is None) and not new["h"][0] and len(new["h"][1]) <= room:
                    held[query], changed = new, True
                    room -= len(new["h"][1])
                else:
                    self.own.updateValue((query,), (_text(new),))
                    changed, more = changed or not more, True
        if changed:
            self.page.update((_text({"queries": list(held.values()), "more": more}),))
        made = Row(*self.result.names)
        for query, row in out.items():
            yield made(query, _text(row))

    def _folded(self, query: str, entry: dict | None, events: list[tuple], timerValues) -> dict | None:
        """The entry of a query after these events, None if none of them is new."""
        fold = self.fold
        fold.index, fold.row = _Query(), _Query()
        fold.events.query = fold.before.query = query
        if entry is not None:
            fold.index.value, fold.row.value = entry["h"], (entry["r"],)
        if not list(fold.handleInputRows((query,), iter(events), timerValues)):
            return None
        return {"q": query, "r": fold.row.value[0], "h": fold.index.value}

    def close(self) -> None:
        pass


_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_STRICT = _EXACT | {"mode": "FAILFAST"}


def _as_texts(flat: DataFrame, carried: list[str], pages: int) -> DataFrame:
    """``(page, query_id, event, carried)``: the fields of the state as a JSON list, the columns that go with them as an object."""
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("null")) for n in _FIELDS]
    event = F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]"))
    page = F.pmod(F.xxhash64("query_id"), F.lit(pages)).alias("page")
    return flat.select(page, "query_id", event.alias("event"), F.to_json(F.struct(*carried), _EXACT).alias("carried"))


def _row_type() -> T.StructType:
    event = T.StructType(_EVENT.fields)
    texts = [T.StructField(n, T.StringType()) for n in ("own", "first", "other")]
    numbers = [T.StructField(n, _LONG) for n in ("seen_count", "created_ms", "last_seen_ms")]
    return T.StructType([T.StructField("core", event), T.StructField("context", event), *texts, *numbers])


def _from_texts(rows: DataFrame, columns: T.StructType, result: T.StructType) -> DataFrame:
    """Rows ``(query_id, r)`` of the fold, ``r`` of ``_row_type``, with the columns of the batch operator."""
    held = rows.select("query_id", "r", *[F.from_json(f"r.{n}", columns, _STRICT).alias(n) for n in ("own", "first", "other")])

    def folded_event(name: str) -> Column:
        own = F.col(f"r.{name}")
        rank = F.struct(*[own[f].alias(f) for f in ("s", "n", "t", "m")])
        return F.struct(own["ms"].alias("ms"), own["seq"].alias("seq"), rank.alias("rank"), *[own[f].alias(f) for f in ("brings", "holds", "score")])

    values = {"query_id": F.col("query_id"), "core": folded_event("core"), "context": folded_event("context")}
    values |= {n: F.col(f"r.{n}") for n in ("seen_count", "created_ms", "last_seen_ms")}
    for name in columns.names:
        values[name] = F.col("other" if name in CONTEXT else "first" if name in INSERTED else "own")[name]
    return held.select(*[values[f.name].alias(f.name) for f in result.fields])


@contextmanager
def _rocks(spark: SparkSession):
    """The state store that keyed state needs, for queries started inside."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if old is None else spark.conf.set(_PROVIDER, old)


def _start(rows: DataFrame, checkpoint: str, available_now: bool):
    writer = rows.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    with _rocks(rows.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def folded(events: DataFrame, segment: int = SEGMENT, pages: int = PAGES) -> DataFrame:
    """The stream of rows of ``query_log_fold``, a new one whenever a query has new events."""
    flat, result = _flat(events), folded_schema(events)
    columns = T.StructType([f for f in flat.schema.fields if f.name != "query_id" and f.name not in _EVENT.names])
    fold = PageFold(bool(set(INSERTED) & set(columns.names)), bool(set(CONTEXT) & set(columns.names)), segment, segment)
    rows = _as_texts(flat, columns.names, pages).groupBy("page").transformWithState(fold, fold.result, "update", "None")
    return _from_texts(rows.select("query_id", F.from_json("row", _row_type(), _STRICT).alias("r")), columns, result)


def start_fold(events: DataFrame, checkpoint: str, available_now: bool = False, segment: int = SEGMENT, pages: int = PAGES):
    """Start the fold; ``events`` has the columns of the batch operator.

    An event is one (query, time, sequence) and counts once, however often and late it is
    delivered.  ``pages`` stays the same for all runs from one checkpoint.
    """
    return _start(folded(events, segment, pages), checkpoint, available_now)


def _state(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame | None:
    """A state of the last committed batch; None before the first one."""
    try:
        return spark.read.format("statestore").options(**options).load(checkpoint)
    except PySparkException as error:
        if "STDS_" not in str(error.getCondition() or error):
            raise
        return None


def read_folded(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """The folded queries; ``schema`` as of ``folded_schema``, so a stream without input gives no rows."""
    pages = _state(spark, checkpoint, stateVarName="page")
    if pages is None:
        return spark.createDataFrame([], schema)
    entry = T.StructType([T.StructField("q", T.StringType()), T.StructField("r", _row_type())])
    page = T.StructType([T.StructField("queries", T.ArrayType(entry))])
    rows = pages.select(F.explode(F.from_json("value.row", page, _STRICT)["queries"]).alias("e"))
    own = _state(spark, checkpoint, stateVarName="own").select(F.from_json("user_map_value.row", entry, _STRICT).alias("e"))
    known = {"query_id", "core", "context", "seen_count", "created_ms", "last_seen_ms"}
    columns = T.StructType([f for f in schema.fields if f.name not in known])
    return _from_texts(rows.unionByName(own).select(F.col("e.q").alias("query_id"), "e.r"), columns, schema)


COUNTS = T.StructType([T.StructField("table_id", _LONG), T.StructField("usage_count", _LONG)])


def usage_counts(uses: DataFrame) -> DataFrame:
    """The stream of (table_id, usage_count); a (query, table) pair counts once, ever."""
    done = uses.where(F.col("status") == "completed").select(F.col("table_id").cast("long"), F.col("query_id").cast("long"))
    return done.dropDuplicates(["table_id", "query_id"]).groupBy("table_id").agg(F.count(F.lit(1)).alias("usage_count"))


def start_usage_counts(uses: DataFrame, checkpoint: str, available_now: bool = False):
    """Completed-query count per table of ``uses(query_id, table_id, status)``."""
    return _start(usage_counts(uses), checkpoint, available_now)


def read_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(table_id, usage_count); empty for a stream that had no input yet."""
    found = _state(spark, checkpoint, operatorId="0")
    if found is None:
        return spark.createDataFrame([], COUNTS)
    return found.select("key.table_id", F.col("value.count").alias("usage_count"))
