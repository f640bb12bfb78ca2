"""Property-graph queries on plain DataFrames (inventory G1-G11, J2-J3).

A graph is two DataFrames: vertices with an ``id`` column and edges with
``src`` and ``dst``.  Edges are directed; parallel edges and self-loops are
kept.  Every query is a composition of joins, aggregations and semi/anti
joins, so Catalyst plans it and AQE re-plans it at run time.  Iterative
queries (PageRank, BFS) cut their lineage with reliable checkpoints written to
the session's checkpoint folder, so a lost executor only recomputes from the
last checkpoint.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import epoch_seconds, parse_timestamp, ratio
from quarry.operators.ordered_join import ordered_join
from quarry.session import scratch_dir, stage_path


@dataclass(frozen=True)
class Graph:
    """Directed multigraph: ``vertices(id, ...)`` and ``edges(src, dst, ...)``."""

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self) -> None:
        if "id" not in self.vertices.columns:
            raise ValueError("vertices need an 'id' column")
        missing = {"src", "dst"} - set(self.edges.columns)
        if missing:
            raise ValueError(f"edges need columns {sorted(missing)}")

    def persist(self) -> "Graph":
        self.vertices.persist()
        self.edges.persist()
        return self

    def unpersist(self) -> "Graph":
        self.vertices.unpersist()
        self.edges.unpersist()
        return self


def graph_counts(g: Graph) -> DataFrame:
    """One row per part of the graph: ``kind`` ('vertices' | 'edges'), ``n``."""
    v = g.vertices.agg(F.count(F.lit(1)).alias("n")).select(F.lit("vertices").alias("kind"), "n")
    e = g.edges.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edges").alias("kind"), "n")
    return v.unionByName(e)


def dangling_edges(g: Graph) -> DataFrame:
    """Edges whose ``src`` or ``dst`` is not a vertex (two anti joins)."""
    ids = g.vertices.select("id")
    bad_src = g.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti")
    bad_dst = g.edges.join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return bad_src.unionByName(bad_dst).distinct()


def edge_report(g: Graph) -> DataFrame:
    """One row: ``n_edges`` and ``n_dangling`` (edges with an unknown endpoint)."""
    ids = g.vertices.select("id")
    marked = g.edges.select("src", "dst").join(
        ids.select(F.col("id").alias("src"), F.lit(1).alias("__s")), "src", "left"
    ).join(ids.select(F.col("id").alias("dst"), F.lit(1).alias("__d")), "dst", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.count_if(F.col("__s").isNull() | F.col("__d").isNull()).alias("n_dangling"),
    )


def edge_counts(g: Graph) -> DataFrame:
    """Edges per ``(src, dst)``."""
    return g.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("count"))


def ranked_edge_counts(g: Graph) -> DataFrame:
    """Edges per ``(src, dst)``, most frequent first."""
    return edge_counts(g).orderBy(F.desc("count"), "src", "dst")


def subgraph(
    g: Graph,
    edge_pred: str | Column,
    vertex_pred: str | Column | None = None,
    drop_isolated: bool = False,
) -> Graph:
    """Keep edges meeting ``edge_pred``; vertices are kept whole unless a
    vertex predicate is given (then edges must join kept vertices on both
    ends) or ``drop_isolated`` asks to keep only vertices touching an edge."""
    edges = g.edges.where(edge_pred)
    vertices = g.vertices
    if vertex_pred is not None:
        vertices = vertices.where(vertex_pred)
        ids = vertices.select("id")
        edges = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
            ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
        )
    if drop_isolated:
        touched = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
        vertices = vertices.join(touched, "id", "left_semi")
    return Graph(vertices, edges.select(*g.edges.columns))


def in_degrees(g: Graph) -> DataFrame:
    """Edges arriving at each vertex; vertices with none are absent."""
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))


def out_degrees(g: Graph) -> DataFrame:
    """Edges leaving each vertex; vertices with none are absent."""
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))


def degree_ratio(g: Graph) -> DataFrame:
    """``inDegree / outDegree`` as double; one-sided vertices drop out (inner join)."""
    return in_degrees(g).join(out_degrees(g), "id").select("id", ratio("inDegree", "outDegree").alias("degreeRatio"))


# --------------------------------------------------------------------------- motifs

_TERM = re.compile(r"^\s*(!?)\s*\((\w*)\)\s*-\s*\[(\w*)\]\s*->\s*\((\w*)\)\s*$")


@dataclass(frozen=True)
class Term:
    """One motif term ``(src)-[edge]->(dst)``; empty names are anonymous."""

    src: str
    edge: str
    dst: str
    negated: bool = False


def parse_motif(pattern: str | Sequence[Term]) -> list[Term]:
    """Terms from ``"(a)-[ab]->(b); (b)-[bc]->(c)"`` (one regex per term) or a term list."""
    if not isinstance(pattern, str):
        return list(pattern)
    terms = []
    for text in filter(None, (t.strip() for t in pattern.split(";"))):
        m = _TERM.match(text)
        if not m:
            raise ValueError(f"cannot read motif term {text!r}")
        terms.append(Term(m.group(2), m.group(3), m.group(4), bool(m.group(1))))
    return terms


def find_motif(
    g: Graph,
    pattern: str | Sequence[Term],
    on: Sequence[tuple[str, str, str]] = (),
    materialize: bool = False,
) -> DataFrame:
    """Rows matching a motif; one struct column per named vertex and edge.

    Vertices with the same name are the same vertex; different names may bind
    the same vertex.  ``on`` adds equality keys between edges,
    ``(edge1, edge2, column)`` meaning ``edge1.column = edge2.column``; they
    become hash-join keys instead of filters over a larger join.  Negated
    terms (``!(a)-[]->(b)``) become anti joins.  Disconnected patterns are
    refused rather than planned as a cartesian product.

    ``materialize`` checkpoints the edge table once before the self-joins;
    use it when the edges are derived (joins, aggregates) and several terms
    read them, so the derivation is not recomputed per term.
    """
    terms = parse_motif(pattern)
    if materialize:
        scratch_dir(g.edges.sparkSession)
        g = Graph(g.vertices, g.edges.checkpoint())
    keys_for: dict[str, set[str]] = {}
    for e1, e2, c in on:
        keys_for.setdefault(e1, set()).add(c)
        keys_for.setdefault(e2, set()).add(c)
    edge_cols = g.edges.columns
    acc: DataFrame | None = None
    bound: set[str] = set()
    edge_index: dict[str, int] = {}
    order: list[str] = []
    anon = 0
    negated = []
    for i, t in enumerate(terms):
        if t.negated:
            negated.append(t)
            continue
        src, dst = t.src, t.dst
        if not src:
            src, anon = f"__anon{anon}", anon + 1
        if not dst:
            dst, anon = f"__anon{anon}", anon + 1
        cols = [F.col("src").alias(f"__s{i}"), F.col("dst").alias(f"__d{i}")]
        if t.edge:
            cols.append(F.struct(*[F.col(c) for c in edge_cols]).alias(t.edge))
            edge_index[t.edge] = i
            for c in keys_for.get(t.edge, ()):
                cols.append(F.col(c).alias(f"__k{i}_{c}"))
        e = g.edges.select(*cols)
        if src == dst:
            e = e.where(F.col(f"__s{i}") == F.col(f"__d{i}"))
        cond = []
        if acc is not None:
            if src in bound:
                cond.append(F.col(f"__v_{src}") == F.col(f"__s{i}"))
            if dst in bound:
                cond.append(F.col(f"__v_{dst}") == F.col(f"__d{i}"))
            for e1, e2, c in on:
                if e2 == t.edge and e1 in edge_index and edge_index[e1] != i:
                    cond.append(F.col(f"__k{edge_index[e1]}_{c}") == F.col(f"__k{i}_{c}"))
                elif e1 == t.edge and e2 in edge_index and edge_index[e2] != i:
                    cond.append(F.col(f"__k{edge_index[e2]}_{c}") == F.col(f"__k{i}_{c}"))
            if not cond:
                raise ValueError(f"motif term {t} shares no vertex with earlier terms")
            joined = acc.join(e, on=_and(cond), how="inner")
        else:
            joined = e
        for name, col in ((src, f"__s{i}"), (dst, f"__d{i}")):
            if name not in bound:
                joined = joined.withColumn(f"__v_{name}", F.col(col))
                bound.add(name)
                order.append(name)
        if t.edge:
            order.append(t.edge)
        acc = joined.drop(f"__s{i}", f"__d{i}")
    if acc is None:
        raise ValueError("motif needs at least one positive term")
    for t in negated:
        if t.src not in bound or t.dst not in bound:
            raise ValueError("negated terms must use vertices named in positive terms")
        pairs = g.edges.select(F.col("src").alias("__ns"), F.col("dst").alias("__nd")).distinct()
        acc = acc.join(
            pairs,
            (F.col(f"__v_{t.src}") == F.col("__ns")) & (F.col(f"__v_{t.dst}") == F.col("__nd")),
            "left_anti",
        )
    vcols = g.vertices.columns
    for name in [n for n in order if n in bound]:
        ids = g.vertices.select(F.col("id").alias(f"__id_{name}"), F.struct(*[F.col(c) for c in vcols]).alias(name))
        if name.startswith("__anon"):
            acc = acc.join(ids.select(f"__id_{name}"), F.col(f"__v_{name}") == F.col(f"__id_{name}"), "left_semi")
        else:
            acc = acc.join(ids, F.col(f"__v_{name}") == F.col(f"__id_{name}")).drop(f"__id_{name}")
    out = [n for n in order if not n.startswith("__anon")]
    return acc.select(*out)


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def timed_cycles(
    g: Graph,
    item: str = "item",
    start: str = "start_date",
    end: str = "end_date",
    fmt: str = "M/d/yyyy H:mm",
    materialize: bool = True,
) -> DataFrame:
    """3-cycles a->b->c->a ridden by one item with strictly increasing start times.

    Requires ``a != b`` and ``b != c`` (``a != c`` is not required), the same
    ``item`` on all three edges and ``start(ab) < start(bc) < start(ca)``;
    shortest elapsed time first.  The item is a join key of both edge joins,
    so the plan never forms the item-free 3-cycle product.  The projected
    edge table (five columns and the parsed start time) is checkpointed once
    for the three self-joins unless ``materialize`` is False.
    """
    edges = g.edges.select(
        "src", "dst", item, start, end, parse_timestamp(F.col(start), fmt).alias("__start_ts")
    ).where(F.col("__start_ts").isNotNull())
    motif = find_motif(
        Graph(g.vertices.select("id"), edges),
        "(a)-[ab]->(b); (b)-[bc]->(c); (c)-[ca]->(a)",
        on=[("ab", "bc", item), ("bc", "ca", item)],
        materialize=materialize,
    )
    elapsed = epoch_seconds(F.col("ca.__start_ts")) - epoch_seconds(F.col("ab.__start_ts"))
    return (
        motif.where(
            (F.col("a.id") != F.col("b.id"))
            & (F.col("b.id") != F.col("c.id"))
            & (F.col("ab.__start_ts") < F.col("bc.__start_ts"))
            & (F.col("bc.__start_ts") < F.col("ca.__start_ts"))
        )
        .select(
            F.col("a.id").alias("a_id"),
            F.col("b.id").alias("b_id"),
            F.col("c.id").alias("c_id"),
            F.col(f"ab.{item}").alias("item"),
            F.col(f"ab.{start}").alias("ab_start"),
            F.col(f"ca.{end}").alias("ca_end"),
            elapsed.alias("elapsed_s"),
        )
        .orderBy("elapsed_s", "a_id", "b_id", "c_id")
    )


def ordered_cycles(
    g: Graph, item: str = "item", start: str = "start_date", end: str = "end_date", fmt: str = "M/d/yyyy H:mm",
    within: float | None = None,
) -> DataFrame:
    """The rows of ``timed_cycles``, by joins that know the order of the times: the trips of a busy (vertex, item) are
    cut into buckets of time, and trips out of order never meet.  ``within`` bounds the seconds between two starts."""
    scratch_dir(g.edges.sparkSession)
    trips = g.edges.select(
        "src", "dst", item, start, end, epoch_seconds(parse_timestamp(F.col(start), fmt)).alias("at")
    ).where(F.col("at").isNotNull() & F.col("src").isNotNull() & F.col("dst").isNotNull()).checkpoint()
    ids = g.vertices.select("id").distinct()
    trips = trips.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    away = trips.where(F.col("src") != F.col("dst"))
    first = away.select(F.col("src").alias("a_id"), F.col("dst").alias("b_id"), F.col(item).alias("item"),
                        F.col(start).alias("ab_start"), F.col("at").alias("ab_at"))
    second = away.select(F.col("src").alias("b_id"), F.col("dst").alias("c_id"), F.col(item).alias("item"), F.col("at").alias("bc_at"))
    third = trips.select(F.col("src").alias("c_id"), F.col("dst").alias("a_id"), F.col(item).alias("item"),
                         F.col(end).alias("ca_end"), F.col("at").alias("ca_at"))
    pairs = ordered_join(first, second, ["b_id", "item"], "ab_at", "bc_at", within)
    cycles = ordered_join(pairs, third, ["c_id", "a_id", "item"], "bc_at", "ca_at", within)
    cycles = cycles.select("a_id", "b_id", "c_id", "item", "ab_start", "ca_end", (F.col("ca_at") - F.col("ab_at")).alias("elapsed_s"))
    return cycles.checkpoint().orderBy("elapsed_s", "a_id", "b_id", "c_id")  # a sort by ranges reads its input twice


# --------------------------------------------------------------------------- PageRank


#: A source with more targets than this is a hub; there are at most ``HUBS`` of them.
HUB_TARGETS, HUBS = 100_000, 100_000


def _rank_weights(g: Graph, parts: int, hub_targets: int) -> tuple[str, DataFrame | None]:
    """Edge weights ``(src, dst, wt)``, parallel edges collapsed: the name of a table with ``parts`` buckets of ``src``,
    and the rows of hubs apart, which no bucket could hold (None without hubs)."""
    spark = g.edges.sparkSession
    pairs = g.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w")).checkpoint()
    out = pairs.groupBy("src").agg(F.sum("w").alias("__out"), F.count(F.lit(1)).alias("__targets"))
    most = out.agg(F.sum("__targets").alias("n"), F.max("__targets").alias("most")).first()
    limit = max(hub_targets, (most["n"] or 0) // HUBS)  # so at most HUBS sources are above it
    weight = F.col("w") / F.col("__out")
    plain = pairs.join(out.where(F.col("__targets") <= limit), "src").select("src", "dst", weight.alias("wt"))
    name = f"quarry_rank_weights_{uuid.uuid4().hex}"
    laid = plain.repartition(parts, "src").write.format("parquet").bucketBy(parts, "src").sortBy("src")
    laid.option("path", stage_path(spark, name)).saveAsTable(name)
    if (most["most"] or 0) <= limit:
        return name, None
    hubs = F.broadcast(out.where(F.col("__targets") > limit))
    return name, pairs.join(hubs, "src").select("src", "dst", weight.alias("wt")).checkpoint()


def _rank_round(ids: DataFrame, weights: DataFrame, hubs: DataFrame | None, ranks: DataFrame, reset: float) -> DataFrame:
    """One round.  Ranks lie by the hash of ``id``, as the weights do by ``src``: only what the vertices hand on, summed
    per target in every task first, is exchanged."""
    given = ranks.withColumnRenamed("id", "src")
    handed = weights.join(given, "src")
    if hubs is not None:  # at most HUBS ranks
        handed = handed.unionByName(hubs.join(F.broadcast(given.join(hubs.select("src").distinct(), "src", "left_semi")), "src"))
    contrib = handed.groupBy("dst").agg(F.sum(F.col("rank") * F.col("wt")).alias("__in"))
    return ids.join(contrib.withColumnRenamed("dst", "id"), "id", "left").select(
        "id", (F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("__in"), F.lit(0.0))).alias("rank")
    )


def pagerank(
    g: Graph,
    reset: float = 0.15,
    max_iter: int = 10,
    checkpoint_every: int = 3,
    hub_targets: int = HUB_TARGETS,
) -> DataFrame:
    """Static PageRank: ranks start at 1, ``r = reset + (1-reset) * sum(r_src * w/outdeg_src)``.

    Parallel edges each count (they are collapsed once into a weight), ranks
    sum to ``|V|`` (rescaled at the end, which only matters with sinks).
    Returns the vertex table with a ``pagerank`` column.

    The weights are written once as a table bucketed by source and never
    exchanged again; sources with more than ``hub_targets`` targets are kept
    apart and get their ranks by broadcast.
    """
    spark = g.vertices.sparkSession
    scratch_dir(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = g.vertices.select("id").distinct().repartition(parts, "id").checkpoint()
    n = ids.count()
    name, hubs = _rank_weights(g, parts, hub_targets)
    weights = spark.table(name)
    ranks = ids.withColumn("rank", F.lit(1.0))
    for it in range(max_iter):
        ranks = _rank_round(ids, weights, hubs, ranks, reset)
        if (it + 1) % checkpoint_every == 0 and it + 1 < max_iter:
            ranks = ranks.checkpoint()
    ranks = ranks.checkpoint()
    spark.sql(f"DROP TABLE {name}")
    total = ranks.agg(F.sum("rank")).first()[0] or 1.0
    scaled = ranks.select("id", (F.col("rank") * F.lit(n / total)).alias("pagerank"))
    return g.vertices.join(scaled, "id")


# --------------------------------------------------------------------------- BFS


def _meeting_levels(
    hop: DataFrame, known: DataFrame, sources: DataFrame, targets: DataFrame, max_len: int
) -> tuple[list[DataFrame], list[DataFrame], DataFrame | None]:
    """Levels of vertex ids by their distance from the sources and to the targets, and the vertices where the two
    searches first meet, which are on all shortest paths' middle level; None where no path of ``max_len`` exists."""
    levels = [sources.checkpoint()], [targets.checkpoint()]
    seen = [levels[0][0], levels[1][0]]
    rows = [levels[0][0].count(), levels[1][0].count()]
    ends = ("src", "dst"), ("dst", "src")
    while min(rows) > 0 and len(levels[0]) + len(levels[1]) - 2 < max_len:
        side = 0 if rows[0] <= rows[1] else 1
        here, there = ends[side]
        other = levels[1 - side][-1].select("id", F.lit(True).alias("__met"))
        found = (
            hop.join(levels[side][-1].withColumnRenamed("id", here), here, "left_semi")
            .select(F.col(there).alias("id"))
            .distinct()
            .join(seen[side], "id", "left_anti")
            .join(known, "id", "left_semi")
            .join(other, "id", "left")
            .checkpoint()
        )
        # one job answers both questions: how large is the level, does it meet the other side
        stats = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__met").isNotNull()).alias("met")).first()
        rows[side] = stats["n"]
        levels[side].append(found.select("id"))
        if stats["met"] > 0:
            return levels[0], levels[1], found.where(F.col("__met").isNotNull()).select("id")
        seen[side] = seen[side].unionByName(levels[side][-1])  # a union of checkpointed levels: nothing is rewritten
    return levels[0], levels[1], None


def bfs(
    g: Graph,
    from_expr: str | Column,
    to_expr: str | Column,
    max_len: int = 10,
    edge_filter: str | Column | None = None,
) -> DataFrame:
    """All shortest paths from vertices meeting ``from_expr`` to vertices meeting ``to_expr``.

    Columns ``from, e0, v1, e1, ..., to`` (vertex and edge structs).  A vertex
    meeting both predicates gives a length-0 path (``from`` and ``to``).  No
    path within ``max_len`` gives an empty result.

    The search runs from both ends and meets in the middle: each round takes
    one more hop on the side whose frontier is smaller.  A level holds distinct
    vertex ids, visited ones removed with an anti join, so each round touches
    the edge table once; only edges that lie on a shortest path are kept before
    the paths are assembled.
    """
    spark = g.vertices.sparkSession
    scratch_dir(spark)
    edges = g.edges if edge_filter is None else g.edges.where(edge_filter)
    vcols = g.vertices.columns
    vstruct = F.struct(*[F.col(c) for c in vcols])
    sources = g.vertices.where(from_expr).select("id").distinct()
    targets = g.vertices.where(to_expr).select("id").distinct()
    both = sources.join(targets, "id", "left_semi")
    if not both.isEmpty():
        hit = g.vertices.join(both, "id", "left_semi")
        return hit.select(vstruct.alias("from"), vstruct.alias("to"))

    hop = edges.select("src", "dst").distinct().checkpoint()
    ahead, back, meet = _meeting_levels(hop, g.vertices.select("id"), sources, targets, max_len)
    if meet is None:
        return g.vertices.select(vstruct.alias("from"), vstruct.alias("to")).where(F.lit(False))

    # the vertices a shortest path may have at each place: forward levels up to the meeting, backward levels after it
    at, length = len(ahead) - 1, len(ahead) + len(back) - 2
    level = [*ahead[:at], meet, *back[-2::-1]]
    estruct = F.struct(*[F.col(c) for c in edges.columns])
    steps: list[DataFrame] = [None] * length  # type: ignore[list-item]

    def between(k: int, here: DataFrame, there: DataFrame) -> DataFrame:
        step = edges.join(here.withColumnRenamed("id", "src"), "src", "left_semi").join(
            there.withColumnRenamed("id", "dst"), "dst", "left_semi"
        )
        return step.select(F.col("src").alias(f"__p{k}"), F.col("dst").alias(f"__p{k + 1}"), estruct.alias(f"e{k}")).checkpoint()

    on_path = meet
    for k in range(at - 1, -1, -1):
        steps[k] = between(k, level[k], on_path)
        on_path = steps[k].select(F.col(f"__p{k}").alias("id")).distinct()
    on_path = meet
    for k in range(at, length):
        steps[k] = between(k, on_path, level[k + 1])
        on_path = steps[k].select(F.col(f"__p{k + 1}").alias("id")).distinct()

    paths = steps[0]
    for k in range(1, length):
        paths = paths.join(steps[k], f"__p{k}")
    names = ["from"] + [f"v{k}" for k in range(1, length)] + ["to"]
    for k, name in enumerate(names):
        vt = g.vertices.select(F.col("id").alias(f"__p{k}"), vstruct.alias(name))
        paths = paths.join(vt, f"__p{k}")
    out = []
    for k, name in enumerate(names):
        out.append(name)
        if k < length:
            out.append(f"e{k}")
    return paths.select(*out)
