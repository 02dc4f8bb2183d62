"""The assembled catalog snapshot: fields, keys, files and how the rows meet."""

from bindings import harvests, load
from bindings.views import Bound
from catalith.plans.nesting import nest
from catalith.plans.sizing import MAX_PARENT_ROWS, parent_sizes, parents_together
from catalith.sources import harvest, snapshot

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical_plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_assembled_snapshot_holds_all_column_fields_and_both_kinds_of_keys(spark):
    tables = spark.createDataFrame([("d", "s", "a", None), ("d", "s", "b", "two"), ("d", "s", "bare", "x")], "meta_db_label string, schema string, name string, comment string")
    told = [("a", "y", 2, True, "c"), ("a", "x", 1, True, None), ("b", "z", 1, False, None)]
    columns = spark.createDataFrame([("d", "s", *row) for row in told], "meta_db_label string, schema string, name string, column_name string, ordinal_position int, is_primary_key boolean, col_comment string")
    own = [("d", "s", "a", "k", p, "s", "a", f, "s", "b", "z") for p, f in ((2, "y"), (1, "x"))]
    fks = spark.createDataFrame(own, "meta_db_label string, schema string, name string, constraint_name string, position int, from_schema string, from_table string, from_column string, to_schema string, to_table string, to_column string")
    found = {r["name"]: r for r in harvest.assemble(tables, columns, fks).collect()}
    assert sorted(found) == ["a", "b"]
    assert [tuple(c) for c in found["a"]["columns"]] == [(1, "x", None), (2, "y", "c")]
    assert found["a"]["primary_keys"] == ["x", "y"] and found["b"]["primary_keys"] == []
    assert [(k["position"], k["from_column"], k["to_table"]) for k in found["a"]["foreign_keys"]] == [(1, "x", "b"), (2, "y", "b")]
    assert found["b"]["foreign_keys"] == [] and found["b"]["comment"] == "two"


def test_catalog_assemble_shows_keys_defaults_and_comments(spark):
    rows = load.QUERIES["catalog_assemble"](spark, "/root/testdata/sf0.001")
    shown = rows.selectExpr("sum(length(foreign_keys)) AS f", "sum(length(primary_keys)) AS p", "max(contains(details, 'flag ')) AS c", "max(contains(details, ': 0 :')) AS d").first()
    assert shown["f"] > 0 and shown["p"] > 0 and shown["c"] and shown["d"]


def test_few_children_are_cut_into_the_same_parts_without_being_stored(spark):
    child = spark.range(101).selectExpr("CASE WHEN id % 3 > 0 THEN id % 3 END AS k", "id div 2 AS v").where("NOT (k = 2 AND v > 4)")
    for distinct in (False, True):
        shown = [sorted((str(r["k"]), r["part"], [x["v"] for x in r["vs"]]) for r in nest(child, ["k"], ["v"], "vs", 10, distinct, few).collect()) for few in (False, True)]
        assert shown[0] == shown[1] and max(len(x[2]) for x in shown[1]) == 10
    assert "Relation [" not in plan_of(nest(child, ["k"], ["v"], "vs", few=True))


def test_columns_meet_their_comments_and_keys_dealt_by_the_table(spark):
    b = Bound(spark, SF)
    with parents_together(spark):
        plan = physical_plan_of(harvests.assembled(b))
    assert "REPARTITION_BY_COL" in plan
    assert not [line for line in plan.splitlines() if "Exchange hash" in line and "column_name" in line]


def test_dealt_and_spread_columns_give_the_same_snapshot(spark):
    b = Bound(spark, SF)
    with parents_together(spark):
        near = sorted(map(str, harvests.assembled(b).collect()))
    b.largest_table = MAX_PARENT_ROWS + 1
    far = harvests.assembled(b)
    assert "REPARTITION" not in physical_plan_of(far)
    assert sorted(map(str, far.collect())) == near


def test_more_tasks_than_the_session_has_give_the_same_snapshot(spark):
    b = Bound(spark, SF)
    with parents_together(spark):
        few = sorted(map(str, harvests.assembled(b).collect()))
        b.tasks = 20
        many = harvests.assembled(b)
        plan = physical_plan_of(many)
        assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan
        assert not [line for line in plan.splitlines() if "Exchange hash" in line and "column_name" in line]
        assert sorted(map(str, many.collect())) == few


def test_a_large_parent_is_seen(spark):
    rows = spark.range(10).selectExpr("id % 2 AS a", "id % 4 < 2 OR id = 9 AS b")
    assert parent_sizes(rows, ["a", "b"])[0] == 3
    assert parent_sizes(rows.where("a > 1"), ["a"])[0] == 0


def test_snapshot_files_are_packed_and_read_back(spark, tmp_path):
    rows = spark.range(1000).selectExpr("concat('t', id) AS name", "array(named_struct('column_name', 'c')) AS columns")
    snapshot.write_snapshot(rows, str(tmp_path / "s"))
    files = list((tmp_path / "s").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sorted(spark.read.schema(rows.schema).json(str(tmp_path / "s")).collect()) == sorted(rows.collect())


def test_both_ends_of_the_keys_read_one_shuffle_of_the_attributes(spark, tmp_path):
    made = spark.range(40).selectExpr("id % 4 AS table_id", "CAST(id div 4 AS INT) AS attnum", "'s' AS table_schema", "concat('t', id % 4) AS table_name", "concat('c', id) AS column_name")
    made.write.parquet(str(tmp_path / "a"))
    attributes = spark.read.parquet(str(tmp_path / "a"))
    keys = spark.createDataFrame([("k", 1, 2, [1, 0], [3, 4]), ("k", 0, 0, [9], [9])], "constraint_name string, table_id long, ref_table_id long, conkey array<int>, confkey array<int>")
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        fks = harvest.harvest_fks(keys, attributes)
        found = sorted(tuple(r) for r in fks.collect())
        assert "ReusedExchange" in physical_plan_of(fks)
    finally:
        spark.conf.unset(name)
    assert found == [("k", "s", "t0", "c36", "s", "t0", "c36", 1), ("k", "s", "t1", "c1", "s", "t2", "c18", 2), ("k", "s", "t1", "c5", "s", "t2", "c14", 1)]


def test_constraints_find_their_columns_among_the_stored_ones(spark):
    b = Bound(spark, SF)
    assert "Aggregate [l_partkey" not in plan_of(harvests.constraint_keys(b)) + plan_of(harvests.physical_layer(b)[1])
