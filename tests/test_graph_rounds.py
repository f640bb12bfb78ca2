"""PageRank over bucketed weights and breadth-first search from both ends."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as G


def _graph(spark, edges, vertices):
    return G.Graph(spark.createDataFrame([(v,) for v in vertices], "id long"), spark.createDataFrame(edges, "src long, dst long"))


def _ranks(edges, n, rounds, reset=0.15):
    out, many = Counter(s for s, _ in edges), Counter(edges)
    rank = dict.fromkeys(range(n), 1.0)
    for _ in range(rounds):
        given = defaultdict(float)
        for (s, d), c in many.items():
            given[d] += rank[s] * c / out[s]
        rank = {v: reset + (1 - reset) * given[v] for v in range(n)}
    total = sum(rank.values())
    return {v: r * n / total for v, r in rank.items()}


@pytest.mark.parametrize("hub_targets", [3, 1000])
def test_ranks_with_and_without_hubs(spark, hub_targets):
    n = 40
    edges = [(0, d) for d in range(1, n)] + [(s, (s * 7) % n) for s in range(1, n)] + [(5, 6)] * 4 + [(9, 0)]
    got = G.pagerank(_graph(spark, edges, range(n)), max_iter=5, checkpoint_every=2, hub_targets=hub_targets)
    want = _ranks(edges, n, 5)
    assert {r["id"]: pytest.approx(r["pagerank"], abs=1e-9) for r in got.collect()} == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("quarry_rank_weights")]


def test_ranks_without_edges(spark):
    got = G.pagerank(_graph(spark, [], [1, 2]), max_iter=2)
    assert {r["id"]: r["pagerank"] for r in got.collect()} == {1: 1.0, 2: 1.0}


def test_a_round_exchanges_only_what_is_handed_on(spark):
    edges = [(s, (s * k + 1) % 50) for s in range(50) for k in (3, 5)]
    g = _graph(spark, edges, range(50))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = g.vertices.distinct().repartition(parts, "id").checkpoint()
        name, hubs = G._rank_weights(g, parts, 1000)
        ranks = ids.withColumn("rank", F.lit(1.0))
        for _ in range(2):
            ranks = G._rank_round(ids, spark.table(name), hubs, ranks, 0.15)
        plan = ranks._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange" in line]
        assert hubs is None and len(exchanges) == 2 and all("hashpartitioning(dst" in line for line in exchanges)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _distances(edges, start):
    seen, level, out = {start}, {start}, [1]
    while level:
        level = {d for s, d in edges if s in level} - seen
        seen |= level
        out.append(len(level))
    return out


def test_search_from_both_ends_visits_fewer_vertices(spark):
    # a tree that fans out by five, and one line of vertices behind a single leaf
    edges = [(v, 5 * v + k) for v in range(32) for k in range(1, 6)] + [(157, 1000), (1000, 1001), (1001, 1002)]
    ids = sorted({v for e in edges for v in e})
    g = _graph(spark, edges, ids)
    hop = g.edges.distinct().checkpoint()
    one = lambda i: g.vertices.where(F.col("id") == i).select("id")
    ahead, back, meet = G._meeting_levels(hop, g.vertices.select("id"), one(0), one(1002), 10)
    assert meet is not None and len(ahead) + len(back) - 2 == 7
    visited = sum(level.count() for level in ahead + back)
    assert visited < sum(_distances(edges, 0)) / 2
    row, = G.bfs(g, "id = 0", "id = 1002", max_len=7).collect()
    places = [row["from"], *(row[f"v{k}"] for k in range(1, 7)), row["to"]]
    assert [p["id"] for p in places] == [0, 1, 6, 31, 157, 1000, 1001, 1002]
    assert G.bfs(g, "id = 0", "id = 1002", max_len=6).count() == 0


def test_search_keeps_parallel_edges_and_many_ends(spark):
    edges = [(1, 2), (1, 2), (2, 3), (4, 3), (4, 5), (3, 9), (5, 9), (3, 77)]  # 77 is no vertex
    g = _graph(spark, edges, [1, 2, 3, 4, 5, 9])
    rows = G.bfs(g, "id IN (1, 4)", "id = 9", max_len=4).collect()
    assert sorted((r["from"].id, r["v1"].id, r["to"].id) for r in rows) == [(4, 3, 9), (4, 5, 9)]
    assert G.bfs(g, "id = 1", "id = 3", max_len=4).count() == 2
    assert G.bfs(g, "id = 1", "id = 77", max_len=4).count() == 0
    assert G.bfs(g, "id = 9", "id = 1", max_len=4).count() == 0
