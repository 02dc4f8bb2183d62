"""Dumps, snapshots, versioned stores, physical layer and reconciliation."""

import json
import random

import pytest
from pyspark.sql import functions as F

from catalith.operators import physical, recon
from catalith.sources import dumps, schemas, snapshot, store

DOCUMENT = {
    "version": 3,
    "contract_version": "1",
    "meta_db_label": "erp",
    "schema": "public",
    "source_engine": "",
    "source": {"host": "h", "port": "5432", "Password": "x"},
    "tables": [
        {"name": "a", "comment": "first", "columns": [{"column_name": "id", "ordinal_position": 1, "data_type": "integer", "udt_name": "integer", "is_nullable": "NO"}]},
        {"name": "b", "table_type": "VIEW", "columns": [{"column_name": "a_id", "ordinal_position": 1, "data_type": "integer", "is_unique": True}]},
    ],
    "primary_keys": [["a", "id"]],
    "foreign_keys": [
        {"constraint_name": "ba", "from_schema": "public", "from_table": "b", "from_column": "a_id", "to_schema": "public", "to_table": "a", "to_column": "id", "position": 1},
        {"constraint_name": "out", "from_schema": "public", "from_table": "b", "from_column": "a_id", "to_schema": "other", "to_table": "a", "to_column": "id", "position": 1},
    ],
}


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("snap") / "catalog.json"
    path.write_text(json.dumps(DOCUMENT, indent=2), encoding="utf-8")
    return snapshot.document_frames(snapshot.read_documents(spark, str(path)))


def test_document_to_physical_layer(frames):
    tables = snapshot.normalize(frames["tables"])
    shown = {r["name"]: (r["source_engine"], r["table_type"], r["source"]) for r in tables.collect()}
    clean = {"host": "h", "port": "5432"}
    assert shown == {"a": ("postgres", "BASE TABLE", clean), "b": ("postgres", "VIEW", clean)}
    columns = frames["columns"].withColumn("dtype", F.col("data_type"))
    nodes = physical.vertices(tables, columns, frames["primary_keys"])
    edges = physical.physical_edges(tables, columns, frames["foreign_keys"])
    counts = {r["kind"]: r["row_count"] for r in physical.summary(nodes, edges).collect()}
    assert counts == {"database": 1, "tables": 2, "columns": 2, "has_table": 2, "has_column": 2, "fk_to": 1}
    assert physical.contract_violations(nodes, "label").count() == 0
    assert physical.contract_violations(edges.withColumn("id", F.col("src")), "type").count() == 0
    column = nodes.where("id = 'meta_ingest:C:erp:public:a:id'").first()["props"]
    assert (column["is_primary_key"], column["nullable"], column["fqn"]) == ("true", "false", "erp.public.a.id")
    broken = nodes.withColumn("props", F.map_filter("props", lambda k, v: k != "datasource"))
    rows = physical.contract_violations(broken, "label").collect()
    assert {tuple(r["missing"]) for r in rows} == {("datasource",)} and len(rows) == 2


def test_refresh_is_scoped_to_its_label(spark, frames):
    nodes = spark.createDataFrame(
        [("x", "Table", "erp", {"_meta_ingest": "true"}), ("y", "Table", "crm", {"_meta_ingest": "true"}), ("z", "Note", "erp", {})],
        "id string, label string, meta_db_label string, props map<string,string>",
    )
    edges = spark.createDataFrame([("z", "x", "ABOUT", "erp", {}), ("z", "y", "ABOUT", "erp", {})], "src string, dst string, type string, meta_db_label string, props map<string,string>")
    fresh = nodes.where("id = 'x'").withColumn("id", F.lit("x2"))
    ids = lambda df, c: sorted(r[c] for r in df.collect())
    scoped = physical.refresh(nodes, edges, fresh, edges.limit(0))
    assert ids(scoped[0], "id") == ["x2", "y", "z"] and ids(scoped[1], "dst") == ["y"]
    whole = physical.refresh(nodes, edges, fresh, edges.limit(0), scope="all")
    assert ids(whole[0], "id") == ["x2", "z"] and ids(whole[1], "dst") == []


def test_violations_and_audit(spark):
    df = spark.createDataFrame(
        [("ok_1", "s", "pg", {"host": "h"}, 1), ("Bad", None, "", {"TOKEN": "t"}, 0), (None, "s", "pg", None, None)],
        "meta_db_label string, schema string, source_engine string, source map<string,string>, table_count int",
    )
    found = [(r["meta_db_label"], r["violation"]) for r in snapshot.violations(df).collect()]
    assert len([f for f in found if f[0] == "Bad"]) == 5 and ("Bad", "secret keys: TOKEN") in found
    assert sorted(v for label, v in found if label is None) == ["label is empty", "no tables"]
    line = snapshot.audit_lines(df.limit(1), "t:1/db").first()["line"]
    assert line == "ingest_audit: meta_db_label='ok_1' schema='s' source_engine='pg' source_host='h' source_port=None source_dbname=None target=t:1/db"


def test_dump_round_trip(spark, tmp_path):
    nodes = [{"neo4j_id": 7, "labels": ["A", "B"], "properties": {"name": "n", "big": [1, 2], "none": None}}]
    edges = [{"rel_id": 1, "rel_type": "T", "start_id": 7, "end_id": 8, "properties": {}}]
    (tmp_path / "nodes.json").write_text(json.dumps(nodes), encoding="utf-8")
    (tmp_path / "edges.json").write_text(json.dumps(edges), encoding="utf-8")
    node = dumps.read_nodes(spark, str(tmp_path / "nodes.json"), array_file=True).first()
    assert (node["id"], node["labels"], json.loads(node["props"]["big"])) == ("7", ["A", "B"], [1, 2])
    edge = dumps.read_edges(spark, str(tmp_path / "edges.json"), array_file=True).first()
    assert (edge["src"], edge["dst"], edge["type"]) == ("7", "8", "T")
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05' AS t, array(1, 2) AS a, map('k', 'v') AS m")
    dumps.write_json(df, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out")).first()["value"]
    assert json.loads(text)["a"] == [1, 2] and json.loads(text)["t"].startswith("2024-01-02T03:04:05")


def test_graph_store_and_versions(spark, tmp_path):
    nodes = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, label string")
    edges = spark.createDataFrame([("1", "2", "T")], "src string, dst string, type string")
    dumps.write_graph(nodes, edges, str(tmp_path / "g"))
    back, _ = dumps.read_graph(spark, str(tmp_path / "g"))
    plan = back.where("label = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan and back.count() == 2
    root = str(tmp_path / "s")
    store.write_version(nodes, root, 1)
    store.write_version(nodes.limit(1), root, 2)
    assert store.read_current(spark, root).count() == 1
    for ddl in schemas.SCHEMAS.values():
        assert store.empty(spark, ddl).count() == 0


def test_reconciliation_passes_on_itself_and_finds_the_damage(spark):
    source = spark.createDataFrame([(str(i), ["X"], f"n{i}") for i in range(30)], "id string, labels array<string>, name string")
    target = source.selectExpr("id", "labels[0] AS label", "name")
    edges = spark.createDataFrame([("1", "2", "PART_OF"), ("2", "3", "SUBCLASS_OF"), ("3", "4", "SUBCLASS_OF")], "src string, dst string, type string")
    checks = [
        recon.totals({"n": source, "e": edges}, {"n": target, "e": edges}),
        recon.labels(source, target),
        recon.types(edges, edges),
        recon.chains(edges, edges),
        recon.properties(source, target, sample=None),
    ]
    for df in checks:
        assert {r["status"] for r in df.collect()} == {"PASS"}
    damaged = target.where("id <> '7'").withColumn("name", F.when(F.col("id") == "3", "other").otherwise(F.col("name")))
    bad = recon.properties(source, damaged, sample=None).where("status = 'FAIL'")
    assert sorted(r["test"] for r in bad.collect()) == ["node:3", "node:7"]
    summary = recon.result_summary(recon.properties(source, damaged, sample=None)).first()
    assert tuple(summary) == (28, 2, 30)


def two_sides(spark, seed):
    """A graph and a damaged copy: names changed, lost and null, labels of one, two and no part, nodes and types on one side only."""
    rnd = random.Random(seed)
    source, target = [], []
    for i in range(300):
        labels = rnd.choice([[], ["A"], ["B"], ["x", "A"], ["y", "A"], ["x", "Only"]])
        name = rnd.choice(["n", None, "m" * (i % 4), "\u00e9"])
        source.append((f"i{i}", labels, name))
        fate = rnd.random()
        if fate < 0.03:
            continue
        label = labels[-1] if labels else "UnknownNode"
        target.append((f"i{i}", label, name if fate > 0.06 else rnd.choice(["z", None])))
    target += [("new1", "Fresh", "n"), ("new2", "A", None)]
    rels = [(False, rnd.choice(["T", "U", "V"])) for _ in range(90)]
    rels += [(True, t) for _, t in rels if t != "V"] + [(True, "W"), (True, "U")]
    return (
        spark.createDataFrame(source, "id string, labels array<string>, name string"),
        spark.createDataFrame(target, "id string, label string, name string"),
        spark.createDataFrame(rels, "migrated boolean, type string"),
    )


def test_digest_reconciliation_equals_the_joined_checks(spark):
    for seed, ranges in ((1, 1), (2, 7), (3, 4096)):
        source, target, rels = two_sides(spark, seed)
        old, new = rels.where("NOT migrated"), rels.where("migrated")
        checks = (
            recon.totals({"n": source, "e": old}, {"n": target, "e": new})
            .unionByName(recon.types(old, new))
            .unionByName(recon.labels(source, target))
        )
        props = recon.properties(source, target)
        tagged = recon.tagged_nodes(source, target)
        want = recon.result_summary(checks.unionByName(props)).collect()
        assert [tuple(r) for r in recon.summary(tagged, rels, ranges=ranges).collect()] == [tuple(r) for r in want]
        failed = sorted(map(tuple, props.where("status = 'FAIL'").collect()))
        assert failed and sorted(map(tuple, recon.differences(tagged, ranges=ranges).collect())) == failed


def test_digest_reconciliation_reads_equal_ranges_once(spark):
    source, target, rels = two_sides(spark, 4)
    same = source.select("id", F.when(F.size("labels") > 0, F.element_at("labels", -1)).otherwise("UnknownNode").alias("label"), "name")
    tagged = recon.tagged_nodes(source, same)
    assert recon.differences(tagged).count() == 0
    rows = recon._with_values(recon.tagged_nodes(source, same.withColumn("name", F.when(F.col("id") == "i7", "other").otherwise(F.col("name")))), ["name"], 64)
    assert rows.groupBy("__range").agg(*recon._digests()).where(~recon._equal()).count() == 1
    empty = tagged.where("false")
    assert [tuple(r) for r in recon.summary(empty, rels.where("false")).collect()] == [(2, 0, 2)]
    with pytest.raises(ValueError):
        recon.differences(tagged, ranges=recon.MAX_RANGES + 1)
