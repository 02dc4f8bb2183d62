"""Catalog lookups and foreign-key joins on a small hand-made catalog."""

import pytest
from pyspark.sql import functions as F

from catalith.operators import catalog, fk, usage


@pytest.fixture(scope="module")
def cat(spark):
    tables = spark.createDataFrame(
        [
            (1, "d", "s", "a", None, "first", True),
            (2, "d", "s", "b", "A", "", None),
            (3, "d", "s", "c", None, None, None),
            (4, "d", "s", "off", None, "N/A", False),
        ],
        "table_id long, db string, schema_name string, name string, original_name string, description string, is_valid boolean",
    )
    columns = spark.createDataFrame(
        [(11, 1, "id"), (12, 1, "ref"), (21, 2, "id"), (22, 2, "x_%"), (31, 3, "id"), (41, 4, "id")],
        "column_id long, table_id long, name string",
    ).selectExpr("*", "'int' AS dtype", "false AS nullable", "name = 'id' AS is_primary_key", "CAST(NULL AS STRING) AS description", "CAST(NULL AS BOOLEAN) AS is_valid")
    fks = spark.createDataFrame(
        [(12, 21, "ab"), (21, 31, "bc"), (31, 21, "cb"), (11, 11, "self"), (12, 41, "off")],
        "from_column_id long, to_column_id long, constraint_name string",
    )
    return tables, columns, fks


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_alias_equal_to_another_name(cat, spark):
    tables, _, _ = cat
    names = spark.createDataFrame([(" A ",), ("",), (None,), ("c",)], "name string")
    assert pairs(catalog.match_alias(tables, names), "key", "table_id") == [("a", 1), ("a", 2), ("c", 3)]
    assert pairs(catalog.tables_by_names(tables, names), "table_id") == [(1,), (3,)]
    assert pairs(catalog.first_match(tables).where("key = 'a'"), "table_id") == [(1,)]
    assert pairs(catalog.tables_without_description(tables), "table_id") == [(2,), (3,), (4,)]


def test_schemas_keep_tables_without_columns(cat):
    tables, columns, _ = cat
    rows = catalog.table_schemas(tables, columns.where("table_id <> 3")).collect()
    assert sorted((r["table_id"], [c["name"] for c in r["columns"]]) for r in rows) == [(1, ["id", "ref"]), (2, ["id", "x_%"]), (3, [])]


def test_anchor_words_are_literal(cat):
    tables, columns, _ = cat
    assert pairs(catalog.anchor_columns(tables, columns, ["_%"]), "column_name") == [("x_%",)]
    assert catalog.anchor_columns(tables, columns, [], []).count() == 0


def test_neighbours_and_relations(cat):
    edges = fk.fk_edges(*cat)
    assert pairs(fk.neighbors_any(edges).where("seed_table_id = 1"), "related_table_id") == [(2,), (4,)]
    assert pairs(fk.neighbors_any(edges).where("seed_table_id = 2"), "related_table_id") == [(1,), (3,)]
    top = fk.fk_relations(edges, 2).where("seed_table_id = 3")
    assert pairs(top, "relation_type", "related_table_id") == [("foreign_key", 2), ("referenced_by", 2)]
    own = fk.fk_relations(edges, 10).where("seed_table_id = 1 AND related_table_id = 1")
    assert pairs(own, "relation_type") == [("foreign_key",), ("referenced_by",)]
    valid = fk.fk_edges(*cat, valid_only=True)
    assert pairs(valid, "constraint_name") == [("ab",), ("bc",), ("cb",), ("self",)]


def test_paths_and_details_stay_inside_the_request(cat, spark):
    edges = fk.fk_edges(*cat)
    members = spark.createDataFrame([("r", 1), ("r", 2), ("r", 3), ("q", 1), ("q", 3)], "request_id string, table_id long")
    assert pairs(fk.fk_details(edges, members), "request_id", "constraint_name") == [("q", "self"), ("r", "ab"), ("r", "bc"), ("r", "cb"), ("r", "self")]
    found = fk.fk_paths(edges, members, max_hops=3)
    assert pairs(found, "request_id", "from_table_id", "to_table_id", "hops") == [("r", 1, 2, 1), ("r", 1, 3, 2), ("r", 2, 3, 1), ("r", 3, 2, 1)]


def test_related_tables_orientation_and_exclusion(cat, spark):
    edges = fk.fk_edges(*cat)
    rows = fk.related_tables(edges, limit=1, scored=True, mode="text2sql").where("seed_table_id = 3").collect()
    assert [(r["relation_type"], r["score"], r["fk_count"], r["node_key"]) for r in rows] == [("FK_OUT", 0.92, 1, "text2sql:d:s:b")]
    loaded = spark.createDataFrame([(1, 2)], "seed_table_id long, related_table_id long")
    rows = fk.related_tables(edges, loaded=loaded).where("seed_table_id = 1").collect()
    assert sorted((r["related_table_id"], r["excluded"], r["score"]) for r in rows) == [(1, 1, 0.97), (4, 1, 0.97)]


def test_importance_counts_a_self_key_once_per_column(cat):
    rows = fk.table_importance(*cat)
    assert pairs(rows, "table_id", "importance") == [(1, 3), (2, 3), (3, 2), (4, 1)]


def test_fallback_only_when_the_request_has_no_exact_hit(spark):
    mappings = spark.createDataFrame(
        [(1, "seoul", "S", "c", 5, True), (2, "seoul city", "SC", "c", 9, False), (3, "busan", "B", "c", 1, True)],
        "mapping_id long, natural_value string, code_value string, column_fqn string, usage_count int, verified boolean",
    )
    terms = spark.createDataFrame([("r1", "seoul"), ("r1", "city"), ("r2", " SEOUL"), ("r3", "zzz")], "request_id string, term string")
    assert pairs(usage.value_mapping(mappings, terms), "request_id", "mapping_id", "match") == [("r1", 1, "exact"), ("r2", 1, "substring"), ("r2", 2, "substring")]
    strict = usage.value_mapping(mappings, terms, verified_only=True, fallback=False)
    assert pairs(strict, "request_id", "mapping_id") == [("r1", 1)]


def test_history_page_past_the_end_and_queries_without_tables(spark):
    queries = spark.createDataFrame([(i, f"q{i}", "completed", i) for i in range(5)], "query_id long, question string, status string, created_at int")
    used = spark.createDataFrame([(4, 1), (4, 2)], "query_id long, table_id long")
    tables = spark.createDataFrame([(1, "b"), (2, "a")], "table_id long, name string")
    page = usage.history_page(queries, used, tables, page=1, page_size=2).collect()
    assert sorted((r["query_id"], [t["name"] for t in r["tables"]]) for r in page) == [(3, []), (4, ["a", "b"])]
    assert usage.history_page(queries, used, tables, page=9, page_size=2).count() == 0


def test_exists_batch(spark):
    rows = spark.createDataFrame([("d", "f"), ("d", "f")], "directory string, file string")
    wanted = spark.createDataFrame([("d", "f"), ("d", "g")], "directory string, file string")
    assert pairs(catalog.exists_batch(rows, wanted, ["directory", "file"]), "file", F.col("exists")) == [("f", True), ("g", False)]


def test_seek_pages_equal_sorted_pages(spark):
    """Every page, with ties, several ranges, missing times and pages past the end."""
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 4}:{i % 7:02d}:00" if i % 11 else None) for i in range(150)]
    df = spark.createDataFrame(rows, "query_id long, at string").select("query_id", F.col("at").cast("timestamp").alias("created_at"))
    order = [r.query_id for r in df.orderBy(F.col("created_at").desc(), "query_id").collect()]
    for first, size in ((0, 7), (40, 33), (130, 15), (140, 30), (150, 5)):
        got = usage.page_rows(df, first, size).orderBy(F.col("created_at").desc(), "query_id").collect()
        assert [r.query_id for r in got] == order[first : first + size]


def test_lookup_keeps_the_first_mappings_of_equal_values_and_plans_no_large_broadcast(spark):
    """Values told apart by case alone, equal usage, words in several cases; grams are never broadcast by file size."""
    names = ["Red Bolt", "red bolt", "RED NUT", None, "blé"]
    rows = [(i, names[i % 5], "c", "f", i % 3, True) for i in range(400)]
    mappings = spark.createDataFrame(rows, "mapping_id long, natural_value string, code_value string, column_fqn string, usage_count int, verified boolean")
    words = spark.createDataFrame([("red",), ("RED",), ("t",), ("BLÉ",), ("d b",), ("",), (None,), ("zz",)], "word string")
    got = usage.find_value_mapping(mappings, words, limit=7)
    want = []
    for w in ("red", "RED", "t", "BLÉ", "d b"):
        held = [r for r in rows if r[1] is not None and w.lower() in r[1].lower()]
        want += [(w, r[0]) for r in sorted(held, key=lambda r: (-r[4], r[0]))[:7]]
    assert pairs(got, "word", "mapping_id") == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    grams = [line for line in plan.splitlines() if "__gram" in line and "Join" in line]
    assert len(grams) == 2 and all("strategy=merge" in line for line in grams)


def test_requests_meet_the_first_mappings_of_a_value_only(spark):
    """Equal values far above the limit, rows given twice, a request with several terms of one value."""
    names = ["red bolt", "red nut", "blue nut"]
    rows = [(i, names[i % 3], "c", "f", i % 5, True) for i in range(300)]
    mappings = spark.createDataFrame(rows + rows[:40], "mapping_id long, natural_value string, code_value string, column_fqn string, usage_count int, verified boolean")
    terms = spark.createDataFrame([("x", "red nut"), ("x", "blue nut"), ("n", "RED"), ("n", "d "), ("m", "NUT")], "request_id string, term string")
    got = usage.value_mapping(mappings, terms, limit=6)
    order = lambda r: (-r[4], r[0])
    want = [("x", r[0], "exact") for r in sorted([r for r in rows + rows[:40] if r[1] != "red bolt" and r[1].endswith("nut")], key=order)[:6]]
    for who, word in (("n", "red"), ("m", "nut")):
        want += [(who, r[0], "substring") for r in sorted([r for r in rows if word in r[1]], key=order)[:6]]
    assert pairs(got, "request_id", "mapping_id", "match") == sorted(want)
    joined = usage.containing(usage._first_of_values(mappings.distinct(), 6), "natural_value", terms, "term")
    assert joined.count() <= 6 * len(names) * 5
