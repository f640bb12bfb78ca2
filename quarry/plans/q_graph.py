"""Checked queries for the graph family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_seconds, parse_timestamp
from quarry.operators import graph as G
from quarry.operators.ordered_join import ordered_join
from quarry.plans import testdata as td
from quarry.plans.registry import register
from quarry.plans.sqlparts import PART_CHAIN_EDGES, TRADE_EDGES, with_

def _r4(c) -> F.Column:
    return F.round(c, 4) + F.lit(0.0)


@register(
    "g1_graph_edges",
    with_(TRADE_EDGES) + "SELECT src, dst, order_key, line, item, start_date, end_date FROM trade_edges",
)
def g1_graph_edges(spark, sf):
    g = td.trade_graph(spark, sf)
    return g.edges


@register(
    "g1_dangling_edges",
    with_(TRADE_EDGES)
    + """SELECT count(*)::BIGINT AS n_edges,
       count(*) FILTER (WHERE src NOT IN (SELECT n_name FROM nation) OR dst NOT IN (SELECT n_name FROM nation))::BIGINT
         AS n_dangling
FROM trade_edges""",
)
def g1_dangling_edges(spark, sf):
    return G.edge_report(td.trade_graph(spark, sf))


@register(
    "g2_graph_counts",
    with_(TRADE_EDGES)
    + """SELECT 'vertices' AS kind, count(*)::BIGINT AS n FROM nation
UNION ALL SELECT 'edges', count(*)::BIGINT FROM trade_edges
UNION ALL SELECT 'raw_rows', count(*)::BIGINT FROM lineitem""",
)
def g2_graph_counts(spark, sf):
    g = td.trade_graph(spark, sf)
    raw = td.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n")).select(F.lit("raw_rows").alias("kind"), "n")
    return G.graph_counts(g).unionByName(raw)


@register(
    "g3_edge_counts",
    with_(TRADE_EDGES) + "SELECT src, dst, count(*)::BIGINT AS count FROM trade_edges GROUP BY src, dst",
)
def g3_edge_counts(spark, sf):
    return G.ranked_edge_counts(td.trade_graph(spark, sf))


@register(
    "g4_subgraph",
    with_(TRADE_EDGES)
    + "SELECT src, dst, order_key, line, item FROM trade_edges WHERE src = 'NATION_7' OR dst = 'NATION_7'",
)
def g4_subgraph(spark, sf):
    g = td.trade_graph(spark, sf)
    sub = G.subgraph(g, "src = 'NATION_7' OR dst = 'NATION_7'")
    return sub.edges.select("src", "dst", "order_key", "line", "item")


def _count_graph(spark, sf) -> G.Graph:
    g = td.trade_graph(spark, sf)
    return G.Graph(g.vertices, G.edge_counts(g))


@register(
    "g5_find_motif",
    with_(TRADE_EDGES)
    + """, ec AS (SELECT src, dst, count(*)::BIGINT AS cnt FROM trade_edges GROUP BY 1, 2)
SELECT ab.src AS a_id, bc.src AS b_id, ca.src AS c_id, ab.cnt AS ab_count, bc.cnt AS bc_count, ca.cnt AS ca_count
FROM ec ab JOIN ec bc ON ab.dst = bc.src JOIN ec ca ON bc.dst = ca.src AND ca.dst = ab.src""",
)
def g5_find_motif(spark, sf):
    m = G.find_motif(_count_graph(spark, sf), "(a)-[ab]->(b); (b)-[bc]->(c); (c)-[ca]->(a)", materialize=True)
    return m.select(
        F.col("a.id").alias("a_id"),
        F.col("b.id").alias("b_id"),
        F.col("c.id").alias("c_id"),
        F.col("ab.count").alias("ab_count"),
        F.col("bc.count").alias("bc_count"),
        F.col("ca.count").alias("ca_count"),
    )


@register(
    "j2_motif_negated",
    with_(TRADE_EDGES)
    + """, ec AS (SELECT src, dst, count(*)::BIGINT AS cnt FROM trade_edges GROUP BY 1, 2 HAVING count(*) >= 100)
SELECT ab.src AS a_id, ab.dst AS b_id, bc.dst AS c_id, ab.cnt AS ab_count, bc.cnt AS bc_count
FROM ec ab JOIN ec bc ON ab.dst = bc.src
WHERE NOT EXISTS (SELECT 1 FROM ec x WHERE x.src = bc.dst AND x.dst = ab.src)""",
)
def j2_motif_negated(spark, sf):
    cg = _count_graph(spark, sf)
    heavy = G.subgraph(cg, "count >= 100")
    m = G.find_motif(heavy, "(a)-[ab]->(b); (b)-[bc]->(c); !(c)-[]->(a)", materialize=True)
    return m.select(
        F.col("a.id").alias("a_id"),
        F.col("b.id").alias("b_id"),
        F.col("c.id").alias("c_id"),
        F.col("ab.count").alias("ab_count"),
        F.col("bc.count").alias("bc_count"),
    )


G6_SQL = with_(TRADE_EDGES) + """
SELECT ab.src AS a_id, bc.src AS b_id, ca.src AS c_id, ab.item AS item, ab.start_date AS ab_start,
       ca.end_date AS ca_end, (epoch(ca.start_ts) - epoch(ab.start_ts))::BIGINT AS elapsed_s
FROM trade_edges ab
JOIN trade_edges bc ON ab.dst = bc.src AND ab.item = bc.item
JOIN trade_edges ca ON bc.dst = ca.src AND ca.dst = ab.src AND bc.item = ca.item
WHERE ab.src <> bc.src AND bc.src <> ca.src AND ab.start_ts < bc.start_ts AND bc.start_ts < ca.start_ts"""


@register("g6_timed_cycles", G6_SQL)
def g6_timed_cycles(spark, sf):
    return G.timed_cycles(td.trade_graph(spark, sf), item="item", start="start_date", end="end_date")


@register("j3_range_join", G6_SQL)
def j3_range_join(spark, sf):
    """The same cycles by joins over buckets of time (``ordered_join``)."""
    return G.ordered_cycles(td.trade_graph(spark, sf), item="item", start="start_date", end="end_date")


@register(
    "j3_soon_after",
    with_(TRADE_EDGES)
    + """SELECT a.order_key, a.line, b.order_key AS next_order, b.line AS next_line, (epoch(b.start_ts) - epoch(a.start_ts))::BIGINT AS gap_s
FROM trade_edges a JOIN trade_edges b ON a.dst = b.src AND a.item = b.item
WHERE a.start_ts < b.start_ts AND epoch(b.start_ts) <= epoch(a.start_ts) + 30 * 86400""",
)
def j3_soon_after(spark, sf):
    """Trips of an item that go on from where another ended, starting at most 30 days after it."""
    edges = td.trade_graph(spark, sf).edges.withColumn("at", epoch_seconds(parse_timestamp(F.col("start_date"), td.DATE_FMT)))
    left = edges.select(F.col("dst").alias("place"), "item", "order_key", "line", "at")
    right = edges.select(F.col("src").alias("place"), "item", F.col("order_key").alias("next_order"),
                         F.col("line").alias("next_line"), F.col("at").alias("next_at"))
    pairs = ordered_join(left, right, ["place", "item"], "at", "next_at", within=30 * 86400)
    return pairs.select("order_key", "line", "next_order", "next_line", (F.col("next_at") - F.col("at")).alias("gap_s"))


def _pagerank_sql(iters: int = 10, reset: float = 0.15) -> str:
    ctes = [
        TRADE_EDGES,
        "v AS (SELECT DISTINCT n_name AS id FROM nation)",
        "pairs AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM trade_edges GROUP BY 1, 2)",
        "wt AS (SELECT p.src, p.dst, p.w / o.outw AS wt FROM pairs p "
        "JOIN (SELECT src, sum(w) AS outw FROM pairs GROUP BY src) o ON p.src = o.src)",
        "r0 AS (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM v)",
    ]
    for i in range(1, iters + 1):
        ctes.append(
            f"r{i} AS (SELECT v.id, {reset} + {1.0 - reset!r} * coalesce(c.s, 0.0) AS rank FROM v LEFT JOIN "
            f"(SELECT wt.dst, sum(r.rank * wt.wt) AS s FROM wt JOIN r{i - 1} r ON r.id = wt.src GROUP BY wt.dst) c "
            f"ON c.dst = v.id)"
        )
    return with_(*ctes) + (
        f"SELECT id, round(rank * (SELECT count(*) FROM v) / (SELECT sum(rank) FROM r{iters}), 4) + 0.0 AS pagerank "
        f"FROM r{iters}"
    )


@register("g7_pagerank", _pagerank_sql())
def g7_pagerank(spark, sf):
    ranks = G.pagerank(td.trade_graph(spark, sf), reset=0.15, max_iter=10)
    return ranks.select("id", _r4(F.col("pagerank")).alias("pagerank"))


@register(
    "g8_in_degrees",
    with_(TRADE_EDGES) + "SELECT dst AS id, count(*)::BIGINT AS inDegree FROM trade_edges GROUP BY dst",
)
def g8_in_degrees(spark, sf):
    return G.in_degrees(td.trade_graph(spark, sf))


@register(
    "g9_out_degrees",
    with_(TRADE_EDGES) + "SELECT src AS id, count(*)::BIGINT AS outDegree FROM trade_edges GROUP BY src",
)
def g9_out_degrees(spark, sf):
    return G.out_degrees(td.trade_graph(spark, sf))


@register(
    "g10_degree_ratio",
    with_(TRADE_EDGES)
    + """, i AS (SELECT dst AS id, count(*) AS n FROM trade_edges GROUP BY dst),
  o AS (SELECT src AS id, count(*) AS n FROM trade_edges GROUP BY src)
SELECT i.id, round(CAST(i.n AS DOUBLE) / CAST(o.n AS DOUBLE), 4) + 0.0 AS degreeRatio FROM i JOIN o ON i.id = o.id""",
)
def g10_degree_ratio(spark, sf):
    r = G.degree_ratio(td.trade_graph(spark, sf))
    return r.select("id", _r4(F.col("degreeRatio")).alias("degreeRatio"))


# BFS over the part-chain graph: from one part to the parts of another name.
BFS_FROM = "id = 0"
BFS_TO = "p_name = 'hot ring' AND p_size >= 40"
BFS_MAX = 3


def _bfs_sql() -> str:
    walks = []
    for k in range(1, BFS_MAX + 1):
        if k == 1:
            walks.append("w1 AS (SELECT s.id AS v0, e.order_key AS k0, e.line AS l0, e.dst AS v1 FROM src_v s JOIN e ON e.src = s.id)")
        else:
            walks.append(
                f"w{k} AS (SELECT w.*, e.order_key AS k{k - 1}, e.line AS l{k - 1}, e.dst AS v{k} "
                f"FROM w{k - 1} w JOIN e ON e.src = w.v{k - 1})"
            )
    unions = []
    for k in range(1, BFS_MAX + 1):
        pieces = ["CAST(v0 AS VARCHAR)"]
        for j in range(k):
            pieces.append(f"concat('>', k{j}, '/', l{j}, '>')")
            pieces.append(f"CAST(v{j + 1} AS VARCHAR)")
        unions.append(
            f"SELECT {k} AS hops, concat_ws(' ', {', '.join(pieces)}) AS path FROM w{k} "
            f"WHERE v{k} IN (SELECT id FROM dst_v)"
        )
    return with_(
        PART_CHAIN_EDGES,
        "pv AS (SELECT p_partkey AS id, p_name, p_size FROM part)",
        f"src_v AS (SELECT id FROM pv WHERE {BFS_FROM})",
        f"dst_v AS (SELECT id FROM pv WHERE {BFS_TO})",
        "e AS (SELECT * FROM part_chain_edges WHERE src IN (SELECT id FROM pv) AND dst IN (SELECT id FROM pv))",
        *walks,
        "paths AS (" + " UNION ALL ".join(unions) + ")",
    ) + "SELECT hops, path FROM paths WHERE hops = (SELECT min(hops) FROM paths)"


@register("g11_bfs", _bfs_sql())
def g11_bfs(spark, sf):
    paths = G.bfs(td.part_chain_graph(spark, sf), BFS_FROM, BFS_TO, max_len=BFS_MAX)
    return bfs_path_strings(paths)


def bfs_path_strings(paths: DataFrame) -> DataFrame:
    """Flatten BFS output to ``(hops, path)`` text: ``v0 >order/line> v1 ...``."""
    cols = paths.columns
    hops = (len(cols) - 1) // 2
    pieces = []
    for c in cols:
        if c.startswith("e"):
            pieces.append(
                F.concat(
                    F.lit(">"), F.col(f"{c}.order_key").cast("string"), F.lit("/"),
                    F.col(f"{c}.line").cast("string"), F.lit(">"),
                )
            )
        else:
            pieces.append(F.col(f"{c}.id").cast("string"))
    return paths.select(F.lit(hops).alias("hops"), F.concat_ws(" ", *pieces).alias("path"))


@register(
    "j1_inner_join",
    """SELECT o.o_orderkey, o.o_custkey AS custkey, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def j1_inner_join(spark, sf):
    orders = td.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    cust = td.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return orders.join(cust, on="custkey").select("o_orderkey", "custkey", "c_name", "c_mktsegment")
