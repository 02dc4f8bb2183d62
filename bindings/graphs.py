"""Bindings of the graph, path and lineage operators (families G and parts of J, M, S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.catalogs import CAT, EDGES, edges
from bindings.logs import scratch
from bindings.registry import query
from bindings.views import Bound, duck
from catalith.operators import graph, lineage, paths
from catalith.operators import merge as M
from catalith.plans.lineage_cut import stored as once
from catalith.plans.ranking import frequencies
from catalith.sources import arrays, dumps

VE = ("V_node", "V_edge")


def labelled(b: Bound):
    """Nodes with a label list and string properties, as a dump holds them."""
    return b.V_node.selectExpr(
        "id",
        "CASE WHEN label = 'Region' THEN array() WHEN label = 'Nation' THEN array('Area', '1 Nation-x') ELSE array('Thing', label) END AS labels",
        "map('name', name, '1st key!', label, 'score', CASE WHEN label = 'Part' THEN 'NaN' ELSE id END) AS props",
        "label AS original",
        "name",
    )


# ---------------------------------------------------------------- dumps and load


@query("graph_nodes_from_dump", duck(*VE) + "SELECT id, label, name FROM V_node")
def graph_nodes_from_dump(b: Bound):
    dumped = b.V_node.selectExpr("to_json(named_struct('id', id, 'labels', array(label), 'properties', map('name', name))) AS value")
    nodes = dumps.parse_nodes(dumped)
    return nodes.select("id", F.element_at("labels", -1).alias("label"), F.col("props")["name"].alias("name"))


@query("graph_dump_array", duck(*VE) + "SELECT id, label, name, CAST(length(name) AS BIGINT) AS size FROM V_node")
def graph_dump_array(b: Bound):
    """Nodes written as array files and read in byte ranges, their properties with types."""
    path = f"{scratch(b)}/nodes"
    value = "to_json(named_struct('id', id, 'labels', array(label), 'properties', named_struct('name', name, 'note', concat('}{\"[', name, '\\\\'), 'size', length(name)))) AS value"
    arrays.write_array(b.V_node.selectExpr(value), path)
    nodes = dumps.typed_nodes(arrays.read_array(b.spark, path))
    at = lambda name, kind: F.try_variant_get("props", f"$.{name}", kind).alias(name)
    return nodes.select("id", F.col("labels")[0].alias("label"), at("name", "string"), at("size", "bigint"))


@query("graph_edges_from_dump", duck(*VE) + "SELECT src, dst, type FROM V_edge")
def graph_edges_from_dump(b: Bound):
    dumped = b.V_edge.selectExpr(
        "to_json(named_struct('rel_id', concat(src, '-', dst), 'rel_type', type, 'start_id', src, 'end_id', dst, 'properties', map('k', '1'))) AS value"
    )
    return dumps.parse_edges(dumped).select("src", "dst", "type")


@query("graph_dump_files", duck(*VE) + "SELECT id, label, name FROM V_node")
def graph_dump_files(b: Bound):
    """Nodes written as JSON lines to the shared folder and read back."""
    path = f"{scratch(b)}/nodes"
    dumps.write_json(b.V_node.selectExpr("id", "array(label) AS labels", "map('name', name) AS properties"), path)
    nodes = dumps.read_nodes(b.spark, path)
    return nodes.select("id", F.element_at("labels", -1).alias("label"), F.col("props")["name"].alias("name"))


@query(
    "graph_store_files",
    duck(*VE) + "SELECT 'node' AS part, id AS key, label FROM V_node UNION ALL SELECT 'edge', concat(src, '>', dst), type FROM V_edge",
)
def graph_store_files(b: Bound):
    """The graph written by label and type and read back."""
    path = scratch(b)
    dumps.write_graph(b.V_node, b.V_edge, path)
    nodes, edges = dumps.read_graph(b.spark, path)
    rows = nodes.selectExpr("'node' AS part", "id AS key", "label")
    return rows.unionByName(edges.selectExpr("'edge' AS part", "concat(src, '>', dst) AS key", "type AS label"))


@query(
    "graph_load",
    duck(*VE)
    + """SELECT 'node' AS part, id AS key, CASE label WHEN 'Region' THEN 'UnknownNode' WHEN 'Nation' THEN '_1_Nation_x' ELSE label END AS label,
concat_ws('|', concat('_1st_key_=', label), concat('name=', name), CASE WHEN label <> 'Part' THEN concat('score=', id) END) AS detail FROM V_node
UNION ALL SELECT CASE WHEN s.id IS NULL OR d.id IS NULL THEN 'skipped' ELSE 'edge' END, concat(src, '>', dst), type, '' FROM (SELECT CASE WHEN type = 'PART_OF' THEN concat('X', src) ELSE src END AS src, dst, type FROM V_edge) AS e LEFT JOIN V_node s ON s.id = e.src LEFT JOIN V_node d ON d.id = e.dst""",
)
def graph_load(b: Bound):
    broken = b.V_edge.selectExpr("CASE WHEN type = 'PART_OF' THEN concat('X', src) ELSE src END AS src", "dst", "type")
    nodes, kept, skipped = graph.graph_load(labelled(b), broken)
    pairs = F.array_sort(F.transform(F.map_entries("props"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    out = nodes.select(F.lit("node").alias("part"), F.col("id").alias("key"), "label", F.array_join(pairs, "|").alias("detail"))
    for part, df in (("edge", kept), ("skipped", skipped)):
        out = out.unionByName(df.selectExpr(f"'{part}' AS part", "concat(src, '>', dst) AS key", "type AS label", "'' AS detail"))
    return out


@query(
    "edge_resolution",
    duck(*VE)
    + """, n AS (SELECT id FROM V_node WHERE label <> 'Supplier' OR name < 'Supplier#000000050')
SELECT type, CASE WHEN src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n) THEN 'kept' ELSE 'skipped' END AS outcome, count(*) AS row_count FROM V_edge GROUP BY ALL""",
)
def edge_resolution(b: Bound):
    nodes = b.V_node.where("label <> 'Supplier' OR name < 'Supplier#000000050'")
    tagged = graph.with_known_ends(b.V_edge, nodes)
    both = tagged.withColumn("outcome", F.when(F.col("known"), "kept").otherwise("skipped"))
    return both.groupBy("type", "outcome").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "dump_to_tables",
    duck("V_node", "V_edge")
    + """SELECT 'table' AS part, name AS key, CASE WHEN label = 'Region' THEN 'stored' ELSE label END AS detail FROM V_node WHERE label IN ('Nation', 'Region')
UNION ALL SELECT 'column', n.id, s.name FROM V_node n JOIN V_edge e ON e.src = n.id JOIN V_node s ON s.id = e.dst WHERE n.label = 'Customer'
UNION ALL SELECT 'analyzer_table', name, 'Supplier' FROM V_node WHERE label = 'Supplier'
UNION ALL SELECT 'analyzer_column', id, name FROM V_node WHERE label = 'Part'""",
)
def dump_to_tables(b: Bound):
    from catalith.operators import loads

    parent = b.V_edge.where("type = 'LOCATED_IN'").join(b.V_node.selectExpr("id AS dst", "name AS parent"), "dst").selectExpr("src AS id", "parent")
    nodes = b.V_node.join(parent, "id", "left").selectExpr(
        "id",
        "CASE label WHEN 'Nation' THEN array('Table') WHEN 'Region' THEN array('Thing', 'Fabric_Table') WHEN 'Customer' THEN array('Column') WHEN 'Supplier' THEN array('Analyzer_Table') ELSE array('Analyzer_Column') END AS labels",
        "map('name', name, 'description', label, 'fqn', id, 'type', 'text', 'table_name', coalesce(parent, 'none')) AS props",
    )
    tables = b.region.selectExpr("'' AS db", "'public' AS schema_name", "r_name AS name", "'stored' AS description")
    columns = b.spark.createDataFrame([], "fqn string, name string, dtype string, db string, schema_name string, table_name string")
    out = loads.dump_to_tables(tables, columns, nodes)
    return (
        out["tables"]
        .selectExpr("'table' AS part", "name AS key", "description AS detail")
        .unionByName(out["columns"].selectExpr("'column' AS part", "fqn AS key", "table_name AS detail"))
        .unionByName(out["analyzer_tables"].selectExpr("'analyzer_table' AS part", "name AS key", "description AS detail"))
        .unionByName(out["analyzer_columns"].selectExpr("'analyzer_column' AS part", "fqn AS key", "name AS detail"))
    )


# ---------------------------------------------------------------- scans


@query("graph_nodes", duck("V_node") + "SELECT id, label, name FROM V_node WHERE label IN ('Region', 'Supplier', 'Part')")
def graph_nodes(b: Bound):
    return graph.nodes_by_label(b.V_node, ["Region", "Supplier", "Part"])


@query(
    "graph_edges",
    duck(*VE)
    + "SELECT src, dst, type, s.name AS src_name, s.label AS src_label, d.name AS dst_name, d.label AS dst_label FROM V_edge JOIN V_node s ON s.id = src JOIN V_node d ON d.id = dst WHERE type <> 'PART_OF'",
)
def graph_edges(b: Bound):
    return graph.edges_with_ends(b.V_edge, b.V_node, exclude="PART_OF")


@query(
    "graph_node_lookup",
    duck("V_node") + "SELECT id, label, name FROM V_node WHERE id IN (SELECT concat('P', CAST(l_partkey AS VARCHAR)) FROM lineitem WHERE l_returnflag = 'R')",
)
def graph_node_lookup(b: Bound):
    ids = b.lineitem.where("l_returnflag = 'R'").selectExpr("concat('P', l_partkey) AS id")
    return graph.node_lookup(b.V_node, ids)


@query("graph_search", duck("V_node") + "SELECT id, label, name FROM V_node WHERE contains(lower(name), 'ring') AND label = 'Part' ORDER BY id LIMIT 20")
def graph_search(b: Bound):
    return graph.node_search(b.V_node, "Ring", "Part")


@query(
    "node_property_keys",
    duck("V_node")
    + "SELECT id, CASE WHEN label = 'Part' THEN '1st key!|name|score' ELSE '1st key!|name|score' END AS keys FROM V_node",
)
def node_property_keys(b: Bound):
    return graph.property_keys(labelled(b)).withColumn("keys", F.array_join("keys", "|"))


@query(
    "graph_measured_as",
    duck(*VE)
    + "SELECT DISTINCT n.id, n.name, e.dst FROM V_edge e JOIN V_node n ON n.id = e.src WHERE e.type = 'LOCATED_IN' AND e.dst IN (SELECT src FROM V_edge WHERE type = 'PART_OF' AND dst = 'R1')",
)
def graph_measured_as(b: Bound):
    targets = b.V_edge.where("type = 'PART_OF' AND dst = 'R1'").select(F.col("src").alias("id"))
    return graph.connected(b.V_edge, b.V_node, "LOCATED_IN", targets).select("id", "name", "dst")


ENRICH = """, d AS (SELECT name, description AS dataset_description, schema_name AS table_type FROM V_tab WHERE description IS NOT NULL), st AS (SELECT concat('t', CAST(p_partkey AS VARCHAR)) AS physical_name, p_name AS term_name FROM part WHERE p_size > 20) """


def sourced(b: Bound):
    return b.V_node.withColumn("data_source", F.expr("concat('\"t', substring(id, 2), '\"')"))


def datasets(b: Bound):
    return b.V_tab.where("description IS NOT NULL").selectExpr("name", "description AS dataset_description", "schema_name AS table_type")


def standard_terms(b: Bound):
    return b.part.where("p_size > 20").selectExpr("concat('t', p_partkey) AS physical_name", "p_name AS term_name")


@query(
    "node_enrich",
    duck("V_node", "V_tab")
    + ENRICH
    + "SELECT n.id, n.name, d.dataset_description, d.table_type, st.term_name FROM V_node n LEFT JOIN d ON d.name = concat('t', substring(n.id, 2)) LEFT JOIN st ON st.physical_name = concat('t', substring(n.id, 2))",
)
def node_enrich(b: Bound):
    rows = graph.node_enrich(sourced(b), datasets(b), standard_terms(b))
    return rows.select("id", "name", "dataset_description", "table_type", "term_name")


# ---------------------------------------------------------------- counts


@query(
    "graph_counts",
    duck(*VE)
    + "SELECT 'node' AS kind, coalesce(label, '*') AS key, count(*) AS row_count FROM V_node GROUP BY ROLLUP (label) UNION ALL SELECT 'edge', coalesce(type, '*'), count(*) FROM V_edge GROUP BY ROLLUP (type)",
)
def graph_counts(b: Bound):
    return graph.graph_counts(b.V_node, b.V_edge)


@query(
    "graph_schema_report",
    duck(*VE)
    + """, n AS (SELECT CASE WHEN label = 'Region' THEN [] WHEN label = 'Nation' THEN ['Area', '1 Nation-x'] ELSE ['Thing', label] END AS labels FROM V_node)
SELECT 'combination' AS kind, array_to_string(labels, '+') AS key, count(*) AS row_count FROM n GROUP BY ALL
UNION ALL SELECT 'label', l, count(*) FROM (SELECT unnest(labels) AS l FROM n) AS u GROUP BY l UNION ALL SELECT 'type', type, count(*) FROM V_edge GROUP BY type""",
)
def graph_schema_report(b: Bound):
    return graph.schema_report(labelled(b), b.V_edge)


@query("graph_top_labels", duck("V_node") + "SELECT label, count(*) AS cnt FROM V_node GROUP BY label ORDER BY cnt DESC, label LIMIT 3")
def graph_top_labels(b: Bound):
    return frequencies(b.V_node, ["label"], 3)


CHAINS = [("PART_OF",), ("SUPPLIED_BY",), ("LOCATED_IN", "PART_OF"), ("SUPPLIED_BY", "LOCATED_IN"), ("LOCATED_IN", "LOCATED_IN")]


@query(
    "graph_chain_counts",
    duck("V_edge")
    + " UNION ALL ".join(
        [f"SELECT '{c[0]}' AS chain, count(*) AS paths FROM V_edge WHERE type = '{c[0]}'" for c in CHAINS if len(c) == 1]
        + [
            f"SELECT '{c[0]}-{c[1]}', count(*) FROM V_edge a JOIN V_edge b ON a.dst = b.src WHERE a.type = '{c[0]}' AND b.type = '{c[1]}' AND NOT (a.src = b.src AND a.dst = b.dst AND a.type = b.type)"
            for c in CHAINS
            if len(c) == 2
        ]
    ),
)
def graph_chain_counts(b: Bound):
    return graph.chain_counts(b.V_edge, CHAINS)


@query(
    "schema_node_counts",
    duck(*VE)
    + """SELECT n.id, n.name, coalesce(c.n, 0) AS node_count, length(n.name) > 8 AS has_json FROM V_node n LEFT JOIN (SELECT dst, count(*) AS n FROM V_edge WHERE type = 'LOCATED_IN' GROUP BY dst) AS c ON c.dst = n.id WHERE n.label = 'Nation'""",
)
def schema_node_counts(b: Bound):
    schemas = b.V_node.where("label = 'Nation'").selectExpr("id", "name", "CASE WHEN length(name) > 8 THEN '{}' END AS document")
    owned = b.V_edge.selectExpr("dst AS src", "src AS dst", "CASE type WHEN 'LOCATED_IN' THEN 'HAS_NODE' ELSE type END AS type")
    return graph.schema_node_counts(schemas, owned)


# ---------------------------------------------------------------- paths

PATHS = """WITH RECURSIVE {views}, p AS (SELECT src AS start, dst AS node, [src, dst] AS path, 1 AS depth FROM V_edge WHERE src IN (SELECT start FROM w) UNION ALL SELECT p.start, e.dst, list_append(p.path, e.dst), p.depth + 1 FROM p JOIN V_edge e ON e.src = p.node WHERE p.depth < 5),
b AS (SELECT start, node, depth, path, row_number() OVER (PARTITION BY start, node ORDER BY depth, path) AS rn FROM p)
SELECT w.start, w."end", b.depth IS NOT NULL AS found, CAST(b.depth AS BIGINT) AS depth, array_to_string(b.path, '>') AS path FROM w LEFT JOIN b ON b.start = w.start AND b.node = w."end" AND b.rn = 1"""
PAIRS = """w AS (SELECT DISTINCT concat('P', CAST(l_partkey AS VARCHAR)) AS start, concat('R', CAST(n_regionkey AS VARCHAR)) AS "end" FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
UNION SELECT concat('N', CAST(n_nationkey AS VARCHAR)), concat('N', CAST(n_nationkey AS VARCHAR)) FROM nation)"""


def wanted_pairs(b: Bound):
    bought = (
        b.lineitem.join(b.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(b.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(b.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .selectExpr("concat('P', l_partkey) AS start", "concat('R', n_regionkey) AS end")
        .distinct()
    )
    return bought.unionByName(b.nation.selectExpr("concat('N', n_nationkey) AS start", "concat('N', n_nationkey) AS end"))


@query("graph_shortest_path", PATHS.format(views=duck("V_edge")[5:] + ", " + PAIRS))
def graph_shortest_path(b: Bound):
    found = paths.shortest_paths(b.V_edge, wanted_pairs(b))
    return found.withColumn("path", F.array_join("path", ">"))


REVERSE = """, p1 AS (SELECT dst AS target, src AS head, [src, dst] AS chain, [type] AS types, 1 AS depth FROM V_edge WHERE dst IN (SELECT id FROM V_node WHERE label = 'Region')),
p2 AS (SELECT p.target, e.src AS head, list_prepend(e.src, p.chain) AS chain, list_prepend(e.type, p.types) AS types, 2 AS depth FROM p1 p JOIN V_edge e ON e.dst = p.head),
p3 AS (SELECT p.target, e.src AS head, list_prepend(e.src, p.chain) AS chain, list_prepend(e.type, p.types) AS types, 3 AS depth FROM p2 p JOIN V_edge e ON e.dst = p.head),
p AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)
SELECT target, CAST(depth AS BIGINT) AS depth, array_to_string(chain, '>') AS chain, array_to_string(types, '>') AS relation_types FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY depth, chain, types) AS rn FROM p) AS x """


def shown_paths(df):
    return df.select("target", "depth", F.array_join("chain", ">").alias("chain"), F.array_join("relation_types", ">").alias("relation_types"))


@query("graph_causal_paths", duck(*VE) + REVERSE + "WHERE rn <= 50")
def graph_causal_paths(b: Bound):
    targets = b.V_node.where("label = 'Region'").select("id")
    return shown_paths(paths.reverse_paths(b.V_edge, targets, max_depth=5))


@query("graph_causal_paths_all", duck(*VE) + REVERSE)
def graph_causal_paths_all(b: Bound):
    targets = b.V_node.where("label = 'Region'").select("id")
    return shown_paths(paths.reverse_paths(b.V_edge, targets, max_depth=4, limit=None))


@query(
    "graph_causal_enriched",
    duck(*VE, "V_tab")
    + ENRICH
    + """SELECT DISTINCT e.dst AS target, CAST(1 AS BIGINT) AS depth, n.id, n.label, e.type AS relation_type, d.dataset_description, st.term_name FROM V_edge e JOIN V_node n ON n.id = e.src
LEFT JOIN d ON d.name = concat('t', substring(n.id, 2)) LEFT JOIN st ON st.physical_name = concat('t', substring(n.id, 2))""",
)
def graph_causal_enriched(b: Bound):
    rows = paths.direct_causes(b.V_edge, sourced(b), b.V_node.select("id"), datasets(b), standard_terms(b))
    return rows.select("target", "depth", "id", "label", "relation_type", "dataset_description", "term_name")


@query(
    "graph_causal_enriched_deep",
    duck(*VE, "V_tab")
    + ENRICH
    + """, h1 AS (SELECT DISTINCT dst AS target, 1 AS depth, src AS id, type FROM V_edge),
h2 AS (SELECT DISTINCT h.target, 2 AS depth, e.src AS id, e.type FROM h1 h JOIN V_edge e ON e.dst = h.id), h3 AS (SELECT DISTINCT h.target, 3 AS depth, e.src AS id, e.type FROM h2 h JOIN V_edge e ON e.dst = h.id)
SELECT h.target, CAST(h.depth AS BIGINT) AS depth, n.id, n.label, h.type AS relation_type, d.dataset_description, st.term_name FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3) AS h JOIN V_node n ON n.id = h.id
LEFT JOIN d ON d.name = concat('t', substring(n.id, 2)) LEFT JOIN st ON st.physical_name = concat('t', substring(n.id, 2))""",
)
def graph_causal_enriched_deep(b: Bound):
    rows = paths.direct_causes(b.V_edge, sourced(b), b.V_node.select("id"), datasets(b), standard_terms(b), max_depth=3)
    return rows.select("target", "depth", "id", "label", "relation_type", "dataset_description", "term_name")


# ---------------------------------------------------------------- documents, models, exports


@query(
    "graph_model_dag",
    duck(*VE)
    + """, i AS (SELECT e.dst, string_agg(concat(n.id, ':', n.name, ':', CAST(length(n.name) % 5 AS VARCHAR)), '|' ORDER BY n.id) AS t FROM V_edge e JOIN V_node n ON n.id = e.src WHERE e.type = 'LOCATED_IN' AND n.label = 'Supplier' GROUP BY e.dst),
o AS (SELECT e.src, string_agg(concat(n.id, ':', n.name, ':0'), '|' ORDER BY n.id) AS t FROM V_edge e JOIN V_node n ON n.id = e.dst WHERE e.type = 'PART_OF' GROUP BY e.src)
SELECT m.id AS model_id, m.name, CAST(0 AS BIGINT) AS part, coalesce(i.t, '') AS inputs, coalesce(o.t, '') AS outputs FROM V_node m LEFT JOIN i ON i.dst = m.id LEFT JOIN o ON o.src = m.id WHERE m.label IN ('Nation', 'Region')""",
)
def graph_model_dag(b: Bound):
    models = b.V_node.where("label IN ('Nation', 'Region')").selectExpr("id AS model_id", "name")
    links = b.V_edge.where("type = 'PART_OF' OR (type = 'LOCATED_IN' AND startswith(src, 'S'))").selectExpr(
        "src", "dst", "CASE type WHEN 'LOCATED_IN' THEN 'READS_FIELD' ELSE 'PREDICTS_FIELD' END AS type", "'value' AS field"
    )
    lags = b.V_node.selectExpr("id AS src", "CASE label WHEN 'Supplier' THEN length(name) % 5 ELSE 0 END AS lag")
    links = links.join(lags, "src", "left")
    rows = graph.model_dag(models, links, b.V_node)
    for c in ("inputs", "outputs"):
        rows = rows.withColumn(c, F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["node_id"], x["node_name"], x["lag"].cast("string"))), "|"))
    return rows


@query(
    "model_field_links",
    "SELECT l_orderkey AS id, CASE WHEN l_returnflag = 'A' THEN 'READS_FIELD' ELSE 'PREDICTS_FIELD' END AS link_type, CASE WHEN l_returnflag = 'A' THEN coalesce(CASE WHEN l_linenumber > 3 THEN l_linestatus END, 'price') END AS feature, CAST(coalesce(CASE WHEN l_tax > 0.03 THEN l_linenumber END, 0) AS BIGINT) AS lag, coalesce(CASE WHEN l_tax < 0.07 THEN l_discount END, 1.0) AS p_value FROM lineitem WHERE l_returnflag <> 'R'",
)
def model_field_links(b: Bound):
    links = b.lineitem.selectExpr(
        "l_orderkey AS id",
        "CASE l_returnflag WHEN 'A' THEN 'READS_FIELD' WHEN 'N' THEN 'PREDICTS_FIELD' ELSE 'OTHER' END AS linkType",
        "'price' AS field",
        "CASE WHEN l_linenumber > 3 THEN l_linestatus END AS featureName",
        "CASE WHEN l_tax > 0.03 THEN l_linenumber END AS lag",
        "CASE WHEN l_tax < 0.07 THEN l_discount END AS grangerPValue",
    )
    rows = graph.field_links(links)
    return rows.selectExpr("id", "linkType AS link_type", "featureName AS feature", "lag", "grangerPValue AS p_value")


# Tables with a list of measures, which is left out where it is as long as a vector.
PROFILE = "CASE WHEN table_id % 3 = 0 THEN sequence(1, 100 + table_id % 60) END"


@query(
    "graph_export",
    duck(*CAT)
    + EDGES
    + f""", P AS (SELECT *, len({PROFILE.replace("sequence(1, 100 + table_id % 60)", "range(100 + table_id % 60)")}) AS n FROM V_tab)
SELECT 'node' AS part, CAST(table_id AS VARCHAR) AS key, 'Analyzer_Table' AS kind, name, concat_ws('|', db, schema_name, original_name, coalesce(description, '-'), CASE WHEN is_valid THEN 1 WHEN NOT is_valid THEN 0 END) AS detail, CASE WHEN n < 128 THEN CAST(n * (n + 1) // 2 AS BIGINT) END AS total FROM P
UNION ALL SELECT 'node', concat('col:', CAST(column_id AS VARCHAR)), 'Analyzer_Column', name, concat_ws('|', dtype, CASE WHEN nullable THEN 1 ELSE 0 END, CASE WHEN is_primary_key THEN 1 ELSE 0 END), NULL FROM V_col
UNION ALL SELECT 'relationship', concat('hc:', CAST(table_id AS VARCHAR), ':', CAST(column_id AS VARCHAR)), 'HAS_COLUMN', NULL, concat(CAST(table_id AS VARCHAR), '>col:', CAST(column_id AS VARCHAR)), NULL FROM V_col
UNION ALL SELECT 'relationship', concat('rel:', CAST(from_column_id AS VARCHAR), '-', CAST(to_column_id AS VARCHAR)), 'FK_TO_TABLE', NULL, concat(CAST(from_table_id AS VARCHAR), '>', CAST(to_table_id AS VARCHAR), ':', from_column, '>', to_column), NULL FROM E""",
)
def graph_export(b: Bound):
    """All nodes and relationships with typed properties; vectors and lists as long as one are left out."""
    rels = edges(b).selectExpr(
        "concat(from_column_id, '-', to_column_id) AS rel_id", "from_table_id", "to_table_id", "'FK_TO_TABLE' AS rel_type",
        "from_column AS source_column", "to_column AS target_column",
    )
    tables = b.V_tab.withColumn("profile", F.expr(PROFILE)).withColumn("Vector", F.array(F.lit(1.0)))
    nodes, relationships = graph.graph_export(tables, b.V_col, rels)

    def at(name: str, kind: str):
        return F.try_variant_get("properties", f"$.{name}", kind)

    flag = lambda c: at(c, "boolean").cast("int").cast("string")
    of_table = F.concat_ws("|", at("db", "string"), at("schema_name", "string"), at("original_name", "string"), F.coalesce(at("description", "string"), F.lit("-")), flag("is_valid"))
    of_column = F.concat_ws("|", at("dtype", "string"), flag("nullable"), flag("is_primary_key"))
    total = F.aggregate(at("profile", "array<bigint>"), F.lit(0).cast("long"), lambda a, x: a + x)
    left = nodes.where(at("Vector", "variant").isNull()).select(
        F.lit("node").alias("part"), F.col("node_id").alias("key"), F.col("label").alias("kind"), at("name", "string").alias("name"),
        F.when(F.col("label") == "Analyzer_Table", of_table).otherwise(of_column).alias("detail"), total.alias("total"),
    )
    ends = F.concat_ws(">", "start_id", "end_id")
    pair = F.concat(ends, F.lit(":"), at("sourceColumn", "string"), F.lit(">"), at("targetColumn", "string"))
    right = relationships.select(
        F.lit("relationship").alias("part"), F.col("relationship_id").alias("key"), F.col("type").alias("kind"), F.lit(None).cast("string").alias("name"),
        F.coalesce(pair, ends).alias("detail"), F.lit(None).cast("long").alias("total"),
    )
    return left.unionByName(right)


@query(
    "graph_entities",
    duck(*VE)
    + """SELECT 'node' AS part, src AS key, min(type) AS kind FROM V_edge GROUP BY src UNION ALL SELECT 'relationship', concat(src, '-', dst), type FROM V_edge WHERE type <> 'PART_OF'""",
)
def graph_entities(b: Bound):
    records = b.V_edge.selectExpr(
        "CASE WHEN type = 'PART_OF' THEN NULL ELSE src END AS node_id", "src AS id", "type AS labels",
        "CASE WHEN type <> 'PART_OF' THEN concat(src, '-', dst) END AS rel_id", "type AS rel_type", "src AS start_id", "dst AS end_id", "concat(type, dst) AS seq",
    )
    nodes, rels = graph.graph_entities(records, ["seq"])
    return nodes.selectExpr("'node' AS part", "entity_id AS key", "labels AS kind").unionByName(
        rels.selectExpr("'relationship' AS part", "relationship_id AS key", "type AS kind")
    )


@query(
    "scenario_list",
    "SELECT event_id AS scenario_id, event_type AS schema_id, CASE WHEN event_type = 'error' THEN '[]' ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS intervention FROM events WHERE event_type <> 'click'",
)
def scenario_list(b: Bound):
    scenarios = b.events.selectExpr(
        "event_id AS scenario_id", "event_type AS schema_id", "CASE event_type WHEN 'error' THEN concat('{', props) ELSE props END AS interventions"
    )
    links = b.events.where("event_type <> 'click'").selectExpr("event_id AS scenario_id")
    rows = graph.scenario_list(scenarios, links, ["interventions"])
    value = F.coalesce(F.try_variant_get("interventions", "$.k", "string"), F.to_json("interventions"))
    return rows.select("scenario_id", "schema_id", value.alias("intervention"))


# ---------------------------------------------------------------- lineage


@query(
    "lineage_edges",
    duck("V_lin")
    + """SELECT tbl AS src, proc AS dst, 'DATA_FLOW_TO' AS edge_type FROM V_lin WHERE side = 'SOURCE' UNION ALL SELECT proc, tbl, 'TRANSFORMS_TO' FROM V_lin WHERE side = 'TARGET'
UNION ALL SELECT DISTINCT s.tbl, t.tbl, 'DATA_FLOW_TO' FROM V_lin s JOIN V_lin t ON t.proc = s.proc WHERE s.side = 'SOURCE' AND t.side = 'TARGET'""",
)
def lineage_edges(b: Bound):
    return lineage.lineage_edges(b.V_lin)


@query(
    "save_lineage",
    duck("V_lin")
    + """, n AS (SELECT DISTINCT proc AS name, 'ETLProcess' AS node_type, NULL AS source_type FROM V_lin UNION ALL SELECT tbl, 'DataSource', max(side) FROM V_lin GROUP BY tbl),
o AS (SELECT DISTINCT tbl FROM V_lin WHERE side = 'SOURCE')
SELECT n.name, n.node_type, n.source_type, CASE WHEN o.tbl IS NULL THEN 'insert' ELSE 'update' END AS action FROM n LEFT JOIN o ON o.tbl = n.name AND n.node_type = 'DataSource'""",
)
def save_lineage(b: Bound):
    events = b.V_lin
    stored = events.where("side = 'SOURCE'").selectExpr("tbl AS name", "'DataSource' AS node_type", "'SOURCE' AS source_type").distinct()
    known = b.spark.createDataFrame([], "src string, dst string, edge_type string")
    return lineage.save_lineage(stored, known, events)["nodes"].withColumnRenamed(M.ACTION, "action")


STORED_PART = "proc LIKE '%0'"


@query(
    "save_lineage_edges",
    duck("V_lin")
    + f""", x AS (SELECT tbl AS src, proc AS dst, 'DATA_FLOW_TO' AS edge_type, {STORED_PART} AS stored FROM V_lin WHERE side = 'SOURCE'
UNION ALL SELECT proc, tbl, 'TRANSFORMS_TO', {STORED_PART} FROM V_lin WHERE side = 'TARGET'
UNION ALL SELECT s.tbl, t.tbl, 'DATA_FLOW_TO', s.{STORED_PART} FROM V_lin s JOIN V_lin t ON t.proc = s.proc WHERE s.side = 'SOURCE' AND t.side = 'TARGET')
SELECT src, dst, edge_type, CASE WHEN bool_or(stored) THEN 'stored' ELSE 'new' END AS origin FROM x GROUP BY src, dst, edge_type""",
)
def save_lineage_edges(b: Bound):
    """Stored edges stay, edges of the other processes are added, none comes twice."""
    events = once(b.V_lin, "lineage")
    nodes = lineage.lineage_nodes(events.where(STORED_PART))
    stored = once(lineage.lineage_edges(events.where(STORED_PART)), "lineage-edges")
    saved = lineage.save_lineage(nodes, stored, events)["edges"]
    origin = F.when(F.col(M.ACTION) == "insert", "new").otherwise("stored")
    return saved.select("src", "dst", "edge_type", origin.alias("origin"))


LIN_NODES = """, n AS (SELECT DISTINCT proc AS name, 'ETLProcess' AS node_type, NULL AS source_type, '{"operation_type": "UNKNOWN"}' AS x FROM V_lin
UNION ALL SELECT tbl, 'DataSource', max(side), CASE WHEN tbl < 't2' THEN '{"type": "VIEW"}' WHEN tbl < 't3' THEN '{"type": ' END FROM V_lin GROUP BY tbl) """


def lin_nodes(b: Bound):
    extra = F.expr(
        "CASE WHEN node_type = 'ETLProcess' THEN '{\"operation_type\": \"UNKNOWN\"}' WHEN name < 't2' THEN '{\"type\": \"VIEW\"}' WHEN name < 't3' THEN '{\"type\": ' END"
    )
    return lineage.lineage_nodes(b.V_lin).withColumn("extra_props", extra)


@query(
    "lineage_graph",
    duck("V_lin")
    + LIN_NODES
    + "SELECT name, node_type, source_type, CASE WHEN node_type = 'ETLProcess' THEN 'ETL' WHEN name < 't2' THEN 'VIEW' ELSE source_type END AS type FROM n",
)
def lineage_graph(b: Bound):
    return lineage.lineage_graph(lin_nodes(b)).select("name", "node_type", "source_type", "type")


@query(
    "lineage_stats",
    duck("V_lin")
    + LIN_NODES
    + """SELECT count(*) FILTER (WHERE node_type = 'ETLProcess') AS etl_count, count(*) FILTER (WHERE source_type = 'SOURCE') AS source_count, count(*) FILTER (WHERE source_type = 'TARGET') AS target_count, (SELECT count(*) FROM V_lin) AS flow_count FROM n""",
)
def lineage_stats(b: Bound):
    return lineage.lineage_stats(lin_nodes(b), b.V_lin)


@query(
    "etl_table_refs",
    duck("V_tab")
    + "SELECT DISTINCT l_orderkey AS ast_node_id, l_partkey AS table_id, CASE WHEN l_returnflag = 'A' THEN 'ETL_READS' ELSE l_returnflag END AS ref_type FROM lineitem JOIN V_tab ON table_id = l_partkey WHERE coalesce(is_valid, true)",
)
def etl_table_refs(b: Bound):
    refs = b.lineitem.selectExpr("l_orderkey AS ast_node_id", "concat('t', l_partkey) AS table_name", "nullif(l_returnflag, 'A') AS ref_type")
    return lineage.etl_table_refs(refs, b.V_tab.where("coalesce(is_valid, true)"))


# ---------------------------------------------------------------- graph writes

PROPS = "array_join(array_sort(transform(map_entries(props), e -> concat(e.key, '=', e.value))), '|') AS props"


@query(
    "merge_nodes",
    duck("V_node")
    + """SELECT n.id, CASE WHEN label = 'Part' THEN 'Process' ELSE label END AS label, CASE WHEN label IN ('Part', 'Supplier') THEN concat(CASE WHEN label = 'Supplier' THEN 'kind=old|' ELSE '' END, 'name=new|touched=', id) ELSE concat('kind=old|name=', name) END AS props,
CASE WHEN label = 'Part' THEN 'insert' WHEN label = 'Supplier' THEN 'update' ELSE 'keep' END AS action FROM V_node n""",
)
def merge_nodes(b: Bound):
    current = b.V_node.where("label <> 'Part'").selectExpr("id", "label", "map('name', name, 'kind', 'old') AS props")
    changes = b.V_node.where("label IN ('Part', 'Supplier')").selectExpr(
        "id", "CASE label WHEN 'Part' THEN 'Process' ELSE label END AS label", "map('name', 'new', 'touched', id) AS props", "1 AS seq"
    )
    rows = graph.merge_nodes(current, changes, ["seq"])
    return rows.selectExpr("id", "label", PROPS, f"{M.ACTION} AS action")


@query(
    "update_node_props",
    duck("V_node")
    + """, c AS (SELECT concat('P', CAST(l_partkey AS VARCHAR)) AS id, arg_max(l_returnflag, l_orderkey * 100000000 + l_linenumber * 10000000 + l_suppkey) AS flag, count(*) AS n FROM lineitem GROUP BY l_partkey)
SELECT v.id, v.label, CASE WHEN c.id IS NULL THEN concat('name=', v.name) ELSE concat('flag=', c.flag, '|name=', v.name) END AS props, CASE WHEN c.id IS NULL THEN 'keep' ELSE 'update' END AS action FROM V_node v LEFT JOIN c ON c.id = v.id""",
)
def update_node_props(b: Bound):
    nodes = b.V_node.selectExpr("id", "label", "map('name', name) AS props")
    changes = b.lineitem.selectExpr(
        "concat('P', l_partkey) AS id", "map('flag', l_returnflag) AS props", "l_orderkey * 100000000 + l_linenumber * 10000000 + l_suppkey AS seq"
    )
    rows = graph.update_node_props(nodes, changes, ["seq"])
    return rows.selectExpr("id", "label", PROPS, f"{M.ACTION} AS action")


@query(
    "replace_scope",
    duck(*VE)
    + """, fresh AS (SELECT id, CASE WHEN label = 'Supplier' THEN 'Resource' ELSE 'OntologyType' END AS label FROM V_node WHERE label IN ('Supplier', 'Nation'))
SELECT 'node' AS part, id AS key, label FROM V_node WHERE label IN ('Customer', 'Part') UNION ALL SELECT 'node', id, 'KPI' FROM V_node WHERE label = 'Region' UNION ALL SELECT 'node', concat(id, 'n'), label FROM fresh
UNION ALL SELECT 'edge', concat(src, 'n>', dst, 'n'), type FROM V_edge WHERE src IN (SELECT id FROM fresh) AND dst IN (SELECT id FROM fresh)""",
)
def replace_scope(b: Bound):
    # taken from the id, so that the scope is data and joins on it stay equi-joins
    schema = "CASE WHEN substring({}, 1, 1) IN ('S', 'N') THEN 's1' ELSE 's2' END AS schema_id"
    scoped = b.V_node.selectExpr("id", "label", schema.format("id"))
    nodes = scoped.selectExpr("id", "CASE label WHEN 'Region' THEN 'KPI' ELSE label END AS label", "schema_id")
    old = b.V_edge.selectExpr("src", "dst", "type", schema.format("src"))
    fresh_nodes = scoped.where("label IN ('Supplier', 'Nation')").selectExpr(
        "concat(id, 'n') AS id", "CASE label WHEN 'Supplier' THEN 'Resource' ELSE label END AS label", "schema_id"
    )
    fresh_edges = old.where("schema_id = 's1'").selectExpr("concat(src, 'n') AS src", "concat(dst, 'n') AS dst", "type", "schema_id")
    new_nodes, new_edges = graph.replace_schema(nodes, old, fresh_nodes, fresh_edges)
    return new_nodes.selectExpr("'node' AS part", "id AS key", "label").unionByName(
        new_edges.selectExpr("'edge' AS part", "concat(src, '>', dst) AS key", "type AS label")
    )


@query(
    "detach_delete",
    duck(*VE)
    + """SELECT 'node' AS part, id AS key FROM V_node WHERE label <> 'Supplier' OR name < 'Supplier#000000050' UNION ALL
SELECT 'edge', concat(src, '>', dst) FROM V_edge WHERE src NOT IN (SELECT id FROM V_node WHERE label = 'Supplier' AND name >= 'Supplier#000000050') AND dst NOT IN (SELECT id FROM V_node WHERE label = 'Supplier' AND name >= 'Supplier#000000050')""",
)
def detach_delete(b: Bound):
    doomed = b.V_node.where("label = 'Supplier' AND name >= 'Supplier#000000050'")
    nodes, kept = graph.detach_delete(b.V_node, b.V_edge, doomed)
    return nodes.selectExpr("'node' AS part", "id AS key").unionByName(kept.selectExpr("'edge' AS part", "concat(src, '>', dst) AS key"))
