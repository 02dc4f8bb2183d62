"""JSON array files read in byte ranges, and typed properties."""

import json
import random

import pytest
from pyspark.sql import functions as F

from catalith.functions.values import typed_without_vectors
from catalith.operators import merge as M
from catalith.sources import arrays, dumps

ODD = ['}', '{', '"', "\\", '\\"}', "}, {", "[[", "]", "é🙂", "\n  },\n  {", "", "x" * 3000, '"}]']


def elements(n, seed):
    rng = random.Random(seed)
    return [{"id": str(i), "labels": ["A"] * rng.randrange(3), "properties": {"a": "".join(rng.choices(ODD, k=rng.randrange(4))), "n": [1, {"b": [{}, rng.choice(ODD)]}], "t": bool(i % 2)}} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 2])
def test_one_file_in_many_ranges(spark, tmp_path, small_splits, indent):
    want = []
    for k in range(3):
        part = elements(60, k) if k < 2 else []
        want += part
        (tmp_path / f"{k}.json").write_text(json.dumps(part, ensure_ascii=k == 0, indent=indent), encoding="utf-8")
    (tmp_path / "mixed.json").write_text('[1, "}", {"id": "m", "labels": [], "properties": {}}, [{"id": "inner"}], null]')
    want.append({"id": "m", "labels": [], "properties": {}})
    found = arrays.read_array(spark, str(tmp_path))
    assert arrays._fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    got = [json.loads(r.value) for r in found.collect()]
    key = lambda e: json.dumps(e, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))
    nodes = dumps.read_nodes(spark, str(tmp_path), array_file=True)
    assert nodes.count() == len(want)


def test_same_as_lines(spark, tmp_path, small_splits):
    rows = elements(80, 9)
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text(json.dumps(rows, indent=2))
    lines = dumps.read_nodes(spark, str(tmp_path / "lines"))
    array = dumps.read_nodes(spark, str(tmp_path / "array"), array_file=True)
    shown = lambda df: sorted(map(str, df.select("id", "labels", F.col("props")["t"]).collect()))
    assert shown(lines) == shown(array)


def test_written_arrays_come_back(spark, tmp_path):
    texts = spark.createDataFrame([(json.dumps(e),) for e in elements(50, 4)], "value string").repartition(4)
    arrays.write_array(texts, str(tmp_path / "out"))
    assert sorted(r.value for r in arrays.read_array(spark, str(tmp_path / "out")).collect()) == sorted(r.value for r in texts.collect())
    for f in (tmp_path / "out").glob("part-*"):
        json.loads(f.read_text())


def test_empty_and_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    assert arrays.read_array(spark, str(tmp_path)).count() == 0
    (tmp_path / "b.json").write_text('[{"id": "1"}, {"id": "2')
    assert sorted(r.value for r in arrays.read_array(spark, str(tmp_path)).collect()) == ['{"id": "1"}', '{"id": "2}']


def test_vectors_leave_typed_properties(spark):
    long, short = json.dumps([0.5] * 128), json.dumps([1, 2])
    text = f'{{"name": "n", "Embedding": [1], "profile": {long}, "few": {short}, "n": 3, "ok": true, "none": null, "in": {{"vector": 1}}}}'
    rows = spark.createDataFrame([(text,), (None,)], "t string").select(typed_without_vectors(F.parse_json("t")).alias("v"))
    first, second = rows.select(F.to_json("v").alias("j"), F.try_variant_get("v", "$.n", "int").alias("n"), F.try_variant_get("v", "$.ok", "boolean").alias("ok")).collect()
    assert json.loads(first.j) == {"name": "n", "few": [1, 2], "n": 3, "ok": True, "none": None, "in": {"vector": 1}}
    assert (first.n, first.ok) == (3, True) and second.j is None


def test_delete_order():
    refs = [("c", {"b": "id"}, "b"), ("b", {"a": "id"}, "a"), ("?d", {"a": "id"}, "a"), ("a", {"up": "id"}, "a")]
    assert M.delete_order(["a", "b", "c", "d"], refs) == ([["c", "d"], ["b"], ["a"]], [])
    ring = [("x", {"y": "id"}, "y"), ("y", {"x": "id"}, "x"), ("z", {"x": "id"}, "x")]
    levels, cut = M.delete_order(["x", "y", "z"], ring)
    assert levels[0] == ["z"] and sorted(s for level in levels for s in level) == ["x", "y", "z"] and len(cut) == 1


def test_cascade_in_any_order_of_references(spark):
    frames = {
        "a": spark.createDataFrame([(1,), (2,), (None,)], "id int"),
        "b": spark.createDataFrame([(10, 1), (20, 2), (30, None)], "id int, a int"),
        "c": spark.createDataFrame([(100, 10, 20), (200, 20, 20), (300, None, 10)], "id int, b int, b2 int"),
        "n": spark.createDataFrame([(1,), (2,)], "a int"),
    }
    refs = [("c", {"b2": "id"}, "b"), ("?n", {"a": "id"}, "a"), ("c", {"b": "id"}, "b"), ("b", {"a": "id"}, "a")]
    doomed = frames["a"].where("id = 1")
    counts = M.delete_counts(M.delete_marks(frames, "a", doomed, ["id"], refs)).collect()
    assert sorted(map(tuple, counts)) == [("a", 1, 2), ("b", 1, 2), ("c", 2, 1)]
    left = M.delete_cascade(frames, "a", doomed, ["id"], refs)
    assert sorted(r.id for r in left["c"].collect()) == [200]
    assert sorted((r.a or 0) for r in left["n"].collect()) == [0, 2]
    emptied, steps = M.clean_up(frames, refs, keep=["a"])
    assert emptied["a"].count() == 3 and emptied["c"].count() == 0
    assert [tuple(r) for r in steps.orderBy("step", "store").collect()] == [(0, "c", 3), (0, "n", 2), (1, "b", 3)]
