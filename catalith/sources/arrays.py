"""Files that hold one JSON array each, read in byte ranges.

Spark deals a file out in ranges of text that ends with ``}``.  Whether such a fragment
lies inside a string, and how deep, follows from the quotes and brackets before it: a first
pass sums up every range for both ways that it could start (outside or inside a string),
the sums of a file's ranges are put in order, and a second pass takes the elements out.  An
element across ranges is put together from its parts.

The driver holds one small row for each range, as Spark itself does for its file splits.
Elements that are not objects are passed over; an element that the file breaks off comes as
it is; a file without elements gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_BRACKET = re.compile(r"[\[{\]}]")


def _scan(text: str, inside: bool, depth: int) -> tuple[bool, int, int | None, int | None]:
    """State after a fragment and the brace that ends it; where an element of before ends
    inside the fragment, and where one begins that is still open then."""
    end, begin, at, open_before = None, None, 0, depth > 1
    for part in _ESCAPE.sub("..", text).split('"'):
        if not inside:
            for m in _BRACKET.finditer(part):
                if m.group() in "[{":
                    if depth == 1:
                        begin = at + m.start()
                    depth += 1
                else:
                    depth -= 1
                    if depth == 1:
                        if open_before and end is None:
                            end = at + m.end()
                        begin = None
        at += len(part) + 1
        inside = not inside
    inside = not inside
    return inside, depth if inside else depth - 1, end, begin


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "}").text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int]]:
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _starts(fragments: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """In a string, and depth, at the start of every range."""

    def run(batches):
        held: dict[tuple, list[tuple[bool, int]]] = {}
        for text, *key in _dealt(batches):
            ways = held.get(tuple(key), [(False, 0), (True, 0)])
            held[tuple(key)] = [_scan(text, inside, change)[:2] for inside, change in ways]
        if held:
            rows = [(*key, [w[0] for w in ways], [w[1] for w in ways]) for key, ways in held.items()]
            yield _batch(["file", "block", "ends", "changes"], [pa.string(), pa.int64(), pa.list_(pa.bool_()), pa.list_(pa.int64())], rows)

    found: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    sums = fragments.mapInArrow(run, "file string, block long, ends array<boolean>, changes array<long>")
    for r in sums.orderBy("file", "block").collect():
        if r["file"] != file:
            file, inside, depth = r["file"], False, 0
        found[file, r["block"]] = (inside, depth)
        inside, depth = r["ends"][inside], depth + r["changes"][inside]
    return found


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(value): the text of every object in the JSON arrays at ``path``."""
    fragments = _fragments(spark, path)
    starts = _starts(fragments)
    names, kinds = ["value", "whole", "file", "block", "opens"], [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.bool_()]

    def elements(batches):
        """(value, whole, file, block, opens): elements, or their parts in one range."""
        key, inside, depth, parts, opens = None, False, 0, [], False
        for text, *now in _dealt(batches):
            if tuple(now) != key:
                if parts:
                    yield "".join(parts), False, *key, opens
                key, parts, opens = tuple(now), [], False
                inside, depth = starts[key]
            going_on = depth > 1
            inside, depth, end, begin = _scan(text, inside, depth)
            if end is not None:
                yield "".join([*parts, text[:end]]), opens, *key, opens
                parts, opens, going_on = [], False, False
            if going_on:
                parts += [text, "}"]
            elif begin is not None:
                parts, opens = [text[begin:], "}"], True
            if parts and depth == 1 and not inside:
                yield "".join(parts), opens, *key, opens
                parts, opens = [], False
        if parts:
            yield "".join(parts), False, *key, opens

    def run(batches):
        rows, size = [], 0
        for r in elements(batches):
            rows.append(r)
            size += len(r[0])
            if size > 1_000_000:
                yield _batch(names, kinds, rows)
                rows, size = [], 0
        if rows:
            yield _batch(names, kinds, rows)

    found = fragments.mapInArrow(run, "value string, whole boolean, file string, block long, opens boolean")
    # At most two parts of a range: the end of an element, then the start of another.
    cut = found.where("NOT whole")
    ahead = Window.partitionBy("file").orderBy("block", "opens").rowsBetween(Window.unboundedPreceding, 0)
    numbered = cut.withColumn("element", F.sum(F.col("opens").cast("int")).over(ahead))
    ordered = F.array_sort(F.collect_list(F.struct("block", "value")))
    joined = numbered.groupBy("file", "element").agg(F.array_join(ordered["value"], "").alias("value"))
    return found.where("whole").select("value").unionByName(joined.select("value")).where(F.col("value").startswith("{"))


def write_array(texts: DataFrame, path: str, column: str = "value") -> None:
    """JSON texts as array files, one for each partition, indented as pretty printers do."""

    def run(batches):
        first = True
        for b in batches:
            lines = [f"  {t}" for t in b.column(0).to_pylist()]
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(["[" if first else ",", ",\n".join(lines)])], names=["value"])
                first = False
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])

    texts.select(column).mapInArrow(run, "value string").write.text(path)
