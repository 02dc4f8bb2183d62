"""Path search on graphs with cycles, loops and parallel edges, against brute force."""

import random

from catalith.operators import graph, lineage, paths


def brute_paths(edges, targets, depth):
    """All edge-distinct paths of 1..depth edges into the targets."""
    out = []

    def back(chain, types, used, target):
        if types:
            out.append((target, len(types), tuple(chain), tuple(types)))
        if len(types) == depth:
            return
        for i, (s, d, t) in enumerate(edges):
            if d == chain[0] and i not in used:
                back([s, *chain], [t, *types], used | {i}, target)

    for target in targets:
        back([target], [], frozenset(), target)
    return sorted(out)


def random_edges(n, m, seed):
    rnd = random.Random(seed)
    found = {(f"n{rnd.randrange(n)}", f"n{rnd.randrange(n)}", rnd.choice("AB")) for _ in range(m)}
    return sorted(found | {("n0", "n0", "A"), ("n1", "n2", "A"), ("n2", "n1", "A")})


def found(df):
    return sorted((r["target"], r["depth"], tuple(r["chain"]), tuple(r["relation_types"])) for r in df.collect())


def test_reverse_paths_are_edge_distinct(spark):
    edges = random_edges(7, 12, 5)
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    targets = spark.createDataFrame([("n0",), ("n1",)], "id string")
    want = brute_paths(edges, ["n0", "n1"], 4)
    assert found(paths.reverse_paths(df, targets, 4, limit=None)) == want
    for limit in (3, 20):
        capped = [p for t in ("n0", "n1") for p in sorted((q for q in want if q[0] == t), key=lambda q: q[1:])[:limit]]
        assert found(paths.reverse_paths(df, targets, 4, limit=limit)) == sorted(capped)


def test_reverse_set_is_the_forward_set_of_the_reversed_graph(spark):
    edges = random_edges(6, 9, 9)
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    flipped = df.selectExpr("dst AS src", "src AS dst", "type")
    ids = df.selectExpr("src AS id").union(df.selectExpr("dst AS id"))
    forward = {(c[0], c[-1], t) for _, _, c, t in found(paths.reverse_paths(df, ids, 3, limit=None))}
    backward = {(c[-1], c[0], t[::-1]) for _, _, c, t in found(paths.reverse_paths(flipped, ids, 3, limit=None))}
    assert forward == backward


def test_cause_heads_are_the_heads_of_all_paths(spark):
    targets = spark.createDataFrame([("n0",), ("n1",), ("n4",)], "id string")
    for seed in (1, 5, 8):
        edges = random_edges(6, 9, seed)
        df = spark.createDataFrame(edges, "src string, dst string, type string")
        for depth in (1, 2, 3, 4):
            want = sorted({(t, n, c[0], k[0]) for t, n, c, k in brute_paths(edges, ["n0", "n1", "n4"], depth)})
            rows = paths.cause_heads(df, targets, depth)
            got = sorted((r["target"], r["depth"], r["id"], r["relation_type"]) for r in rows.collect())
            assert got == want, (seed, depth)
    named = spark.createDataFrame([("a", "a", "A", "e1"), ("a", "a", "A", "e2"), ("a", "b", "A", "e3")], "src string, dst string, type string, edge_id string")
    rows = paths.cause_heads(named, spark.createDataFrame([("b",)], "id string"), 4).collect()
    assert sorted((r["depth"], r["id"]) for r in rows) == [(1, "a"), (2, "a"), (3, "a")]  # e3, then each loop once


def test_causes_do_not_multiply_by_paths(spark):
    """Three ladders of ten rungs hold 10**3 paths a target at depth 4, and one state for each node."""
    rungs = [(f"r{k}_{i}", f"r{k - 1}_{j}", "A") for k in (1, 2, 3) for i in range(10) for j in range(10)]
    edges = spark.createDataFrame(rungs + [(f"r0_{i}", "end", "A") for i in range(10)], "src string, dst string, type string")
    targets = spark.createDataFrame([("end",)], "id string")
    steps = paths._closing(paths._steps(edges), 4)
    assert steps.where("again").count() == 0
    rows = paths.cause_heads(edges, targets, 4).collect()
    assert len(rows) == 40 and {r["depth"] for r in rows} == {1, 2, 3, 4}


def test_edges_that_nothing_enters_are_not_compared(spark):
    edges = [("p1", "s1", "A"), ("p2", "s1", "A"), ("s1", "n1", "B"), ("n1", "s1", "B"), ("n1", "n1", "C")]
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    steps = {(r["src"], r["dst"]): (r["onward"], r["again"]) for r in paths._closing(paths._steps(df), 3).collect()}
    assert steps == {("p1", "s1"): (False, False), ("p2", "s1"): (False, False), ("s1", "n1"): (True, True), ("n1", "s1"): (True, True), ("n1", "n1"): (True, True)}
    targets = spark.createDataFrame([("n1",), ("s1",)], "id string")
    for depth in (2, 3, 4):
        want = sorted({(t, n, c[0], k[0]) for t, n, c, k in brute_paths(edges, ["n1", "s1"], depth)})
        rows = paths.cause_heads(df, targets, depth).collect()
        assert sorted((r["target"], r["depth"], r["id"], r["relation_type"]) for r in rows) == want


def test_shortest_paths(spark):
    edges = random_edges(12, 18, 2)
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    nodes = sorted({e[0] for e in edges} | {e[1] for e in edges} | {"alone"})
    pairs = [(a, b) for a in nodes for b in nodes]
    want = {}
    for a in nodes:
        level = {(d,): None for s, d, _ in edges if s == a}
        seen, depth, front = set(), 1, sorted({(a, d) for s, d, _ in edges if s == a})
        while front and depth <= 5:
            best = {}
            for p in front:
                best[p[-1]] = min(best.get(p[-1], p), p)
            for node, p in best.items():
                want.setdefault((a, node), (depth, list(p)))
            front = [p for p in (best[n] for n in best if n not in seen)]
            seen |= set(best)
            front = [(*p, d) for p in front for s, d, _ in edges if s == p[-1] and d not in seen]
            depth += 1
        del level
    asked = spark.createDataFrame(pairs, "start string, end string")
    rows = paths.shortest_paths(df, asked, 5).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert (r["found"], r["depth"], r["path"]) == (
            (True, *want[r["start"], r["end"]]) if (r["start"], r["end"]) in want else (False, None, None)
        ), (r, want.get((r["start"], r["end"])))


def test_shortest_paths_go_from_the_side_with_fewer_ids(spark):
    edges = random_edges(20, 50, 3)
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    nodes = [f"n{i}" for i in range(20)]
    flat = [{"start": n, "end": "n0"} for n in nodes], [{"start": "n0", "end": n} for n in nodes]
    for rows, unused in zip(flat, ("array_insert(path", "array_insert(rest"), strict=True):
        asked = spark.createDataFrame(rows, "start string, end string")
        found_paths = paths.shortest_paths(df, asked, 5)
        assert unused not in found_paths._jdf.queryExecution().optimizedPlan().toString()
        got = {(r["start"], r["end"]): r["path"] for r in found_paths.collect()}
        for a, b in ((r["start"], r["end"]) for r in rows):
            front, want = {(a,)}, None
            for _ in range(5):
                front = {(*p, d) for p in front for s, d, _ in edges if s == p[-1]}
                if hit := [p for p in front if p[-1] == b]:
                    want = list(min(hit))
                    break
            assert got[a, b] == want


def test_chain_counts_do_not_reuse_a_loop(spark):
    edges = random_edges(6, 14, 4)
    df = spark.createDataFrame(edges, "src string, dst string, type string")
    chains = [("A",), ("A", "A"), ("A", "B"), ("Z", "A")]
    got = {r["chain"]: r["paths"] for r in graph.chain_counts(df, chains).collect()}
    two = lambda x, y: sum(1 for e in edges for f in edges if e is not f and e[1] == f[0] and (e[2], f[2]) == (x, y))
    assert got == {"A": sum(e[2] == "A" for e in edges), "A-A": two("A", "A"), "A-B": two("A", "B"), "Z-A": 0}


def test_graph_load_labels_and_missing_ends(spark):
    nodes = spark.createDataFrame(
        [("1", [], {"a b": "x", "n": "NaN"}), ("2", ["X", "9 lives!"], {}), ("3", None, None)],
        "id string, labels array<string>, props map<string,string>",
    )
    edges = spark.createDataFrame([("e1", "1", "2", "T", None), ("e2", "1", "9", "T", None), ("e3", "8", "9", "T", None)], "edge_id string, src string, dst string, type string, props map<string,string>")
    loaded, kept, skipped = graph.graph_load(nodes, edges)
    labels = {r["id"]: (r["label"], r["props"]) for r in loaded.collect()}
    assert labels["1"] == ("UnknownNode", {"a_b": "x"}) and labels["2"][0] == "_9_lives_" and labels["3"][0] == "UnknownNode"
    assert [r["edge_id"] for r in kept.collect()] == ["e1"]
    assert sorted(r["edge_id"] for r in skipped.collect()) == ["e2", "e3"]


def test_lineage_of_one_process(spark):
    events = spark.createDataFrame([("p", "a", "SOURCE"), ("p", "b", "TARGET"), ("p", "b", "TARGET")], "proc string, tbl string, side string")
    edges = {tuple(r) for r in lineage.lineage_edges(events).collect()}
    assert edges == {("a", "p", "DATA_FLOW_TO"), ("p", "b", "TRANSFORMS_TO"), ("a", "b", "DATA_FLOW_TO")}
    both = events.unionByName(spark.createDataFrame([("q", "b", "SOURCE")], events.schema))
    kinds = {r["name"]: r["source_type"] for r in lineage.lineage_nodes(both).collect()}
    assert kinds == {"p": None, "q": None, "a": "SOURCE", "b": "TARGET"}
