"""Scalar functions on the awkward values."""

import hashlib
import json

from pyspark.sql import functions as F

from catalith.functions import keys, text, values


def one(spark, column, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


def test_strip_and_query_id(spark):
    raw = "\t\n 한국어 질문  \n"
    assert one(spark, text.strip_ws("x"), row=(raw,)) == raw.strip()
    want = hashlib.md5(f"db:{raw.strip()}".encode()).hexdigest()[:12]
    assert one(spark, keys.query_id(F.lit("db"), "x"), row=(raw,)) == want
    assert one(spark, keys.query_id(F.lit(None), "x")) == hashlib.md5(b":").hexdigest()[:12]


def test_keywords_are_literals(spark):
    df = spark.createDataFrame([("a+b",), ("aab",), ("ÉTÉ",), (None,)], "x string")
    hits = [r["x"] for r in df.where(text.matches_keywords("x", ["a+b", "été"])).collect()]
    assert hits == ["a+b", "ÉTÉ"]
    assert df.where(text.matches_keywords("x", [])).count() == 0
    likes = spark.createDataFrame([("100%",), ("1000",), ("a_b",), ("axb",)], "x string")
    assert [r["x"] for r in likes.where(text.contains_any("x", ["0%", "A_B"])).collect()] == ["100%", "a_b"]


def test_missing_description_and_validity(spark):
    df = spark.createDataFrame([(None, None), ("", True), ("N/A", False), ("n/a", True)], "x string, v boolean")
    assert [r[0] for r in df.select(text.lacks_text("x")).collect()] == [True, True, True, False]
    assert [r[0] for r in df.select(text.is_valid("v")).collect()] == [True, True, False, True]


def test_status_rank_and_usage_type(spark):
    df = spark.createDataFrame([(" Completed ",), ("ERROR",), ("running",), (None,)], "x string")
    assert [r[0] for r in df.select(values.status_rank("x")).collect()] == [0, 2, 1, 1]
    purposes = ["group filter", "Where", "group by", "sum of join", "join", None, "", "other"]
    df = spark.createDataFrame([(p,) for p in purposes], "x string")
    got = [r[0] for r in df.select(values.usage_type("x")).collect()]
    assert got == ["FILTERS", "FILTERS", "GROUPS_BY", "AGGREGATES", "JOINS_ON", "SELECTS", "SELECTS", "SELECTS"]


def test_last_steps_keeps_ten_and_cuts_reasoning(spark):
    schema = "x array<struct<iteration:int,tool_name:string,reasoning:string,extra:string>>"
    steps = [(i, None, "r" * 500, "e") for i in range(12)]
    got = json.loads(one(spark, values.last_steps("x"), schema, (steps,)))
    assert [s["iteration"] for s in got] == list(range(2, 12))
    assert got[0]["tool_name"] is None and len(got[0]["reasoning"]) == 400 and "extra" not in got[0]
    assert len(json.loads(one(spark, values.last_steps("x"), schema, (steps[:2],)))) == 2
    assert one(spark, values.last_steps("x"), schema, ([],)) == ""
    assert one(spark, values.last_steps("x"), schema, (None,)) == ""


def test_type_text(spark):
    cases = [
        (("character varying", "varchar", 20, None, None), "varchar(20)"),
        (("character varying", "varchar", None, None, None), "character varying(varchar)"),
        (("character", "bpchar", 3, None, None), "char(3)"),
        (("numeric", "numeric", None, 10, 2), "numeric(10,2)"),
        (("numeric", "numeric", None, 10, None), "numeric(10)"),
        (("ARRAY", "_text", None, None, None), "ARRAY(_text)"),
        ((None, "geo", None, None, None), "geo"),
        (("integer", "integer", None, 32, 0), "integer"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], "d string, u string, c int, p int, s int")
    assert [r[0] for r in df.select(values.type_text("d", "u", "c", "p", "s")).collect()] == [w for _, w in cases]


def test_keys_keep_null_parts(spark):
    row = ("l", None, "t", "c")
    schema = "a string, b string, t string, c string"
    assert one(spark, keys.column_fqn("a", "b", "t", "c"), schema, row) == "l..t.c"
    assert one(spark, keys.column_vertex("a", "b", "t", "c"), schema, row) == "meta_ingest:C:l::t:c"
    assert one(spark, keys.table_vertex("a", "b", "t"), schema, row) == "meta_ingest:T:l::t"
    assert one(spark, keys.usage_fqn("b", "t", "c"), schema, row) == "public.t.c"
    assert one(spark, keys.node_key("robo", F.lit(None), "b", "t"), schema, row) == "robo::public:t"


def test_graph_values(spark):
    df = spark.createDataFrame([('{"id": 1}::vertex',), ('"text"',), ("bare",), ("[1]::path",), ("3::numeric",)], "x string")
    shown = [r[0] for r in df.select(F.to_json(values.graph_value("x"))).collect()]
    assert shown == ['{"id":1}', '"text"', '"bare"', "[1]", "3"]
    bad = spark.createDataFrame([("[1, 2]",), ("{",), (None,)], "x string")
    assert [r[0] for r in bad.select(F.to_json(values.json_or_empty("x"))).collect()] == ["[1,2]", "[]", "[]"]


def test_maps(spark):
    source = {"Host": "h", "PASSWORD": "x", "Api_Key": "k", "userid": "u"}
    assert one(spark, values.without_secrets("x"), "x map<string,string>", (source,)) == {"Host": "h"}
    assert one(spark, values.secret_keys("x"), "x map<string,string>", (source,)) == ["Api_Key", "PASSWORD", "userid"]
    props = spark.sql("SELECT map('a-b', '1', 'a b', '2', '9z', '3', 'gone', NULL) AS x")
    assert props.select(values.safe_properties("x")).first()[0] == {"a_b": "2", "_9z": "3"}
    long = json.dumps(list(range(128)))
    vectors = {"Embedding": "[1]", "name": "n", "big": long, "small": "[1,2]"}
    assert one(spark, values.without_vectors("x"), "x map<string,string>", (vectors,)) == {"name": "n", "small": "[1,2]"}
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": None}), (None, {"b": "2"}), ({"a": "1"}, None)], "c map<string,string>, i map<string,string>")
    assert [r[0] for r in df.select(values.merge_maps("c", "i")).collect()] == [{"a": "1", "b": None}, {"b": "2"}, {"a": "1"}]


def test_yes_no_dates_and_property_summary(spark):
    df = spark.createDataFrame([("YES",), ("no",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(values.yes_no("x")).collect()] == [True, False, True, True]
    assert str(one(spark, values.iso_date("x"), row=("2024-02-29",))) == "2024-02-29"
    assert one(spark, values.iso_date("x"), row=("soon",)) is None
    schema = "x array<struct<name:string,type:string,description:string,required:boolean>>"
    got = one(spark, values.property_summary("x"), schema, ([("a", None, None, True), (None, "t", "d", None)],))
    assert {k: tuple(v) for k, v in got.items()} == {"a": ("string", "", True)}
