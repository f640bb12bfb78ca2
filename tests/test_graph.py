from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import graph as G


def _graph(spark, edges, vertices=None, extra=None):
    ids = sorted({v for e in edges for v in e[:2]} | set(vertices or []))
    v = spark.createDataFrame([(i,) for i in ids], "id string")
    cols = "src string, dst string" + (extra or "")
    e = spark.createDataFrame(edges, cols) if edges else spark.createDataFrame([], cols)
    return G.Graph(v, e)


def test_edge_counts_and_degrees(spark):
    g = _graph(spark, [("a", "b"), ("a", "b"), ("b", "c"), ("c", "c")])
    counts = {(r.src, r.dst): r["count"] for r in G.edge_counts(g).collect()}
    assert counts == {("a", "b"): 2, ("b", "c"): 1, ("c", "c"): 1}
    assert {r.id: r.inDegree for r in G.in_degrees(g).collect()} == {"b": 2, "c": 2}
    assert {r.id: r.outDegree for r in G.out_degrees(g).collect()} == {"a": 2, "b": 1, "c": 1}
    ratio = {r.id: r.degreeRatio for r in G.degree_ratio(g).collect()}
    assert ratio == {"b": 2.0, "c": 2.0}  # 'a' has no in-edges: dropped by the inner join


def test_graph_requires_columns(spark):
    with pytest.raises(ValueError):
        G.Graph(spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([("a", "b")], "src string, dst string"))


def test_subgraph_keeps_vertices(spark):
    g = _graph(spark, [("a", "b"), ("b", "c")])
    sub = G.subgraph(g, "src = 'a'")
    assert sub.vertices.count() == 3 and sub.edges.count() == 1
    sub2 = G.subgraph(g, "src = 'a'", drop_isolated=True)
    assert sorted(r.id for r in sub2.vertices.collect()) == ["a", "b"]


def test_motif_semantics(spark):
    g = _graph(spark, [("a", "b"), ("b", "a"), ("a", "a")])
    two = G.find_motif(g, "(x)-[e1]->(y); (y)-[e2]->(z)")
    rows = {(r.x.id, r.y.id, r.z.id) for r in two.collect()}
    # different names may bind the same vertex
    assert ("a", "b", "a") in rows and ("a", "a", "a") in rows
    loops = G.find_motif(g, "(x)-[e]->(x)")
    assert [r.x.id for r in loops.collect()] == ["a"]
    neg = G.find_motif(g, "(x)-[e]->(y); !(y)-[]->(x)")
    assert neg.count() == 0
    with pytest.raises(ValueError):
        G.find_motif(g, "(x)-[e1]->(y); (p)-[e2]->(q)")


def test_motif_anonymous_not_returned(spark):
    g = _graph(spark, [("a", "b"), ("b", "c")])
    m = G.find_motif(g, "(x)-[]->(y); (y)-[e]->()")
    assert m.columns == ["x", "y", "e"]
    assert [(r.x.id, r.y.id, r.e.dst) for r in m.collect()] == [("a", "b", "c")]


def test_timed_cycles(spark):
    rows = [
        ("a", "b", 1, "1/1/2020 0:00", "1/1/2020 1:00"),
        ("b", "c", 1, "1/2/2020 0:00", "1/2/2020 1:00"),
        ("c", "a", 1, "1/3/2020 0:00", "1/3/2020 1:00"),
        ("c", "a", 2, "1/3/2020 0:00", "1/3/2020 1:00"),  # other item: no cycle
        ("b", "c", 1, "12/31/2019 0:00", "12/31/2019 1:00"),  # earlier than ab: rejected
    ]
    g = _graph(spark, rows, extra=", item int, start_date string, end_date string")
    out = G.timed_cycles(g).collect()
    assert [(r.a_id, r.b_id, r.c_id, r.elapsed_s) for r in out] == [("a", "b", "c", 2 * 86400)]


def test_timed_cycles_plan_has_no_cartesian(spark):
    g = _graph(spark, [("a", "b", 1, "1/1/2020 0:00", "x")], extra=", item int, start_date string, end_date string")
    plan = G.timed_cycles(g)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pagerank_matches_power_iteration(spark):
    edges = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]
    g = _graph(spark, edges, vertices=["d"])  # d is a sink with no edges
    got = {r.id: r.pagerank for r in G.pagerank(g, max_iter=10).collect()}
    ids = ["a", "b", "c", "d"]
    idx = {v: i for i, v in enumerate(ids)}
    out = defaultdict(float)
    for s, _ in edges:
        out[s] += 1
    r = np.ones(4)
    for _ in range(10):
        contrib = np.zeros(4)
        for s, d in edges:
            contrib[idx[d]] += r[idx[s]] / out[s]
        r = 0.15 + 0.85 * contrib
    r = r * 4 / r.sum()
    for v in ids:
        assert got[v] == pytest.approx(r[idx[v]], rel=1e-9)
    assert sum(got.values()) == pytest.approx(4.0)


def _brute_shortest_paths(edges, sources, targets, max_len):
    # level-by-level walk enumeration: all walks of the first length that hits a target
    if sources & targets:
        return 0, {(v,) for v in sources & targets}
    walks = [((s,), ()) for s in sources]
    for length in range(1, max_len + 1):
        nxt = []
        for verts, es in walks:
            for i, (s, d) in enumerate(edges):
                if s == verts[-1]:
                    nxt.append((verts + (d,), es + (i,)))
        walks = nxt
        hits = {(v, e) for v, e in walks if v[-1] in targets}
        if hits:
            return length, hits
    return None, set()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=14))
def test_bfs_against_brute_force(spark, edge_list):
    edges = [(str(s), str(d), i) for i, (s, d) in enumerate(edge_list)]
    v = spark.createDataFrame([(str(i),) for i in range(7)], "id string")
    e = spark.createDataFrame(edges, "src string, dst string, eid int")
    g = G.Graph(v, e)
    paths = G.bfs(g, "id = '0'", "id = '5'", max_len=4)
    length, expected = _brute_shortest_paths([(s, d) for s, d, _ in edges], {"0"}, {"5"}, 4)
    rows = paths.collect()
    if length is None:
        assert rows == []
        return
    got = set()
    for r in rows:
        verts = [r["from"].id] + [r[f"v{k}"].id for k in range(1, length)] + [r["to"].id]
        es = tuple(r[f"e{k}"].eid for k in range(length))
        got.add((tuple(verts), es))
    assert got == expected


def test_bfs_length_zero_and_empty(spark):
    g = _graph(spark, [("a", "b")], vertices=["c"])
    zero = G.bfs(g, "id = 'a'", "id IN ('a', 'b')").collect()
    assert [(r["from"].id, r["to"].id) for r in zero] == [("a", "a")]
    assert G.bfs(g, "id = 'a'", "id = 'c'").count() == 0


def test_dangling_edges_and_vertex_subgraph(spark):
    v = spark.createDataFrame([("a",), ("b",)], "id string")
    e = spark.createDataFrame([("a", "b"), ("a", "z"), ("y", "b")], "src string, dst string")
    g = G.Graph(v, e)
    assert sorted((r.src, r.dst) for r in G.dangling_edges(g).collect()) == [("a", "z"), ("y", "b")]
    rep = G.edge_report(g).first()
    assert (rep.n_edges, rep.n_dangling) == (3, 2)
    sub = G.subgraph(g, "true", vertex_pred="id = 'a' OR id = 'b'")
    assert [(r.src, r.dst) for r in sub.edges.collect()] == [("a", "b")]
    counts = {r.kind: r.n for r in G.graph_counts(g).collect()}
    assert counts == {"vertices": 2, "edges": 3}


def test_timed_cycles_with_trip_table_column_names(spark):
    rows = [
        ("a", "b", "1", "8/6/2013 9:00", "8/6/2013 9:30"),
        ("b", "c", "1", "8/6/2013 10:00", "8/6/2013 10:30"),
        ("c", "a", "1", "8/6/2013 11:00", "8/6/2013 11:45"),
    ]
    v = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    e = spark.createDataFrame(rows, "src string, dst string, `Bike #` string, `Start Date` string, `End Date` string")
    out = G.timed_cycles(G.Graph(v, e), item="Bike #", start="Start Date", end="End Date").collect()
    assert [(r.a_id, r.ab_start, r.ca_end, r.elapsed_s) for r in out] == [("a", "8/6/2013 9:00", "8/6/2013 11:45", 7200)]
