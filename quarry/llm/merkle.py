"""Merkle manifest of a dataset: a tree per source, and a tree of the sources.

``build`` hashes every row to a leaf, numbers the leaves of each source by
doc_id, and folds runs of ``FAN`` nodes level by level to the source's subroot;
subroots, by source, fold to the root in the same way.  Every level is written
as node rows linked to their parent, with the digests that stand before and
after the node in its run.  ``climb`` is a recursive query over these rows: it
ascends from the runs of leaves to the root, appends the siblings it passes and
folds the digests of (perhaps changed) leaves into the root they lead to.  The
leaves of a run share all siblings above it, so they climb in one row.

Leaves are numbered by range partitions in sort order, so no source is in one
task.  Upper nodes that all leaves pass are repeated for every ``SHARE`` runs
below them, so that no join key meets more than that.

Defined cases: null fields hash as ``-``; a null source is a source, the first;
null ids come first and are never changed by ``tampered``; rows with one source
and id go by their leaf, and equal rows each have a place; an empty table gives
an empty manifest; other columns are not part of the leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved, shuffle_partitions, small

#: Nodes in a run; runs of leaves that share one copy of the nodes above them.
FAN, SHARE = 16, 1024
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(text: Column | None = None) -> Column:
    """Digest of a row: its fields, each as byte count, colon and value, or ``-`` where null."""
    def field(name: str) -> Column:
        value = (text if text is not None and name == "text" else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(name) for name in FIELDS]), 256)


def tampered(every: int = 5) -> Column:
    """The text, A-Z lower-cased in the rows whose crc32(doc_id) ``every`` divides."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(chosen, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``at``, its place in the total order ``order``.  Rows are range-partitioned, sorted and written with
    their partition and place in it; the partitions' first places (one row each) are added."""
    ranged = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    ranged = saved(ranged.withColumn("seq", F.monotonically_increasing_id()), name)
    part = F.shiftright("seq", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = ranged.withColumn("part", part).join(F.broadcast(starts), "part")
    return rows.withColumn("at", F.col("start") + F.col("seq").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "seq", "start")


@dataclass
class Manifest:
    """``runs``: leaves by run, with what they fold to; ``nodes``: all other nodes but the root, linked to their parent;
    ``subroots``: per source; ``root``: id and digest (None for an empty table)."""

    runs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: tuple[str, str] | None


def _id(tree: Column | str, level: Column, idx: Column) -> Column:
    return F.concat_ws("/", F.col(tree) if isinstance(tree, str) else tree, level, idx)


def _levels(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Folds the trees of ``nodes`` (tree, level, idx, n nodes in the level, id, digest, lo, hi) to one node each: the
    runs of every level, and the nodes that are alone in a level."""
    runs, alone = [], []
    while most > 1:
        alone.append(nodes.where("n = 1"))
        kid = F.struct("idx", "id", "digest", "lo", "hi")
        run = nodes.where("n > 1").groupBy("tree", "level", "n", F.expr(f"idx div {FAN}").alias("up"))
        run = saved(run.agg(F.sort_array(F.collect_list(kid)).alias("kids")), name)
        runs.append(run)
        digests = F.transform("kids", lambda k: k["digest"])
        nodes = run.select(
            "tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
            _id("tree", F.col("level") + 1, F.col("up")).alias("id"), F.sha2(F.array_join(digests, ""), 256).alias("digest"),
            F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"))
        most = -(-most // FAN)
    return runs, [*alone, nodes.where("n = 1")]


def _beside(digests: Column, k: Column) -> tuple[Column, Column]:
    """The digests before and after place ``k`` (from 0), as one string each."""
    return F.array_join(F.slice(digests, F.lit(1), k), ""), F.array_join(F.slice(digests, k + 2, F.lit(FAN)), "")


def _linked(runs: DataFrame) -> DataFrame:
    """Node rows of a level's runs: id, parent, digest, and the digests before and after it (as bytes, half their size)."""
    rows = runs.select(
        _id("tree", F.col("level") + 1, F.col("up")).alias("parent"),
        F.transform("kids", lambda k: k["digest"]).alias("all"), F.posexplode("kids").alias("k", "kid"))
    before, after = _beside(F.col("all"), F.col("k"))
    return rows.select("kid.id", "parent", "kid.digest", F.unhex(before).alias("before"), F.unhex(after).alias("after"), "kid.lo", "kid.hi")


def build(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The manifest of ``docs``.  ``changed`` is a text to fold in place of the row's own: what the rows are now."""
    now = leaf(changed) if changed is not None else leaf()
    leaves = docs.select("doc_id", "source", leaf().alias("leaf"), now.alias("now"), F.monotonically_increasing_id().alias("tie"))
    leaves = _numbered(saved(leaves, "merkle-leaves"), ["source", "doc_id", "leaf", "tie"], "merkle-ranged")
    leaves = saved(leaves.drop("tie"), "merkle-numbered")
    sources = leaves.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    sources = _numbered(saved(sources, "merkle-counts"), ["first"], "merkle-sources").withColumnRenamed("at", "tree")
    sources = small(sources.withColumnRenamed("source", "name"), "merkle-trees")
    found = sources.agg(F.max("n").alias("most"), F.count("*").alias("sources")).first()
    rows = leaves.join(sources, F.col("source").eqNullSafe(F.col("name"))).withColumn("idx", F.col("at") - F.col("first"))

    kid = F.struct("idx", "doc_id", "leaf", "now", "at")
    runs = rows.groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("run")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    runs = saved(runs, "merkle-runs")
    digest = F.when(F.col("n") == 1, F.col("kids")[0]["leaf"]).otherwise(
        F.sha2(F.array_join(F.transform("kids", lambda k: k["leaf"]), ""), 256))
    level, share = F.when(F.col("n") == 1, F.lit(0)).otherwise(F.lit(1)), F.expr(f"kids[0].at div {FAN}")
    nodes = runs.select(
        "tree", level.alias("level"), F.col("run").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        _id("tree", level, F.col("run")).alias("id"), digest.alias("digest"), share.alias("lo"), share.alias("hi"))
    if not found["sources"]:
        empty = _linked(saved(_levels(nodes, 2, "merkle-level")[0][0], "merkle-none"))
        return Manifest(runs, empty, nodes.select("tree", "digest"), None)
    inner, alone = _levels(nodes, -(-found["most"] // FAN), "merkle-level")
    tops = alone[0]
    for more in alone[1:]:
        tops = tops.unionByName(more)
    tops = saved(tops, "merkle-subroots")
    up = tops.select(F.lit(-1).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
                     F.lit(found["sources"]).cast("long").alias("n"), "id", "digest", "lo", "hi")
    outer, last = _levels(up, found["sources"], "merkle-top")
    root = last[-1].select("id", "digest").first()
    linked = [_linked(level) for level in [*inner, *outer]]
    nodes = linked[0] if linked else _linked(saved(_levels(up, 2, "merkle-top")[0][0], "merkle-none"))
    for more in linked[1:]:
        nodes = nodes.unionByName(more)
    return Manifest(runs, saved(nodes, "merkle-nodes"), tops.select("tree", "digest"), (root["id"], root["digest"]))


CLIMB = """WITH RECURSIVE climb(tree, run, share, at, folded, passed) AS (
  SELECT tree, run, share, at, folded, X'' FROM {starts}
  UNION ALL
  SELECT c.tree, c.run, c.share, n.parent,
         transform(c.folded, f -> unhex(sha2(lower(hex(concat(n.before, f, n.after))), 256))), concat(c.passed, n.before, n.after)
  FROM climb c JOIN {steps} n ON n.id = c.at AND n.share = c.share)
SELECT tree, run, folded, passed FROM climb WHERE at = {root}"""

#: Setting that bounds the rows of a recursive query; here they are known to be the runs times the levels.
ROWS = "spark.sql.cteRecursionRowLimit"


def climb(made: Manifest) -> DataFrame:
    """Per run of leaves: the digests that its leaves fold to at the root (``folded``), and the siblings above the run
    (``passed``); digests as bytes."""
    spark = made.runs.sparkSession
    leaves, k = F.transform("kids", lambda x: x["leaf"]), F.col("n") > 1
    folded = F.transform("kids", lambda x, i: F.unhex(F.when(k, F.sha2(F.concat(
        _beside(leaves, i)[0], x["now"], _beside(leaves, i)[1]), 256)).otherwise(x["now"])))
    share = F.floor(F.expr(f"kids[0].at div {FAN}") / SHARE).cast("long")
    at = _id("tree", F.when(k, F.lit(1)).otherwise(F.lit(0)), F.col("run"))
    starts = saved(made.runs.select("tree", "run", share.alias("share"), at.alias("at"), folded.alias("folded")), "merkle-starts")
    copies = F.explode(F.sequence(F.expr(f"lo div {SHARE}"), F.expr(f"hi div {SHARE}")))
    steps = made.nodes.select("id", "parent", "before", "after", copies.alias("share"))
    limit = spark.conf.get(ROWS)
    try:
        spark.conf.set(ROWS, "-1")
        root = made.root[0] if made.root else ""
        return saved(spark.sql(CLIMB, starts=starts, steps=steps, root=root), "merkle-climbed")
    finally:
        spark.conf.set(ROWS, limit)


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``."""
    made = build(docs, changed)
    rows = made.runs.select("tree", "run", F.col("n"), "kids").join(climb(made), ["tree", "run"])
    rows = rows.join(small(made.subroots.withColumnRenamed("digest", "subroot"), "merkle-subroots"), "tree")
    leaves = F.transform("kids", lambda x: x["leaf"])
    rows = rows.select("subroot", "folded", "passed", leaves.alias("leaves"), F.posexplode("kids").alias("k", "kid"))
    before, after = _beside(F.col("leaves"), F.col("k"))
    root = F.lit(made.root[1] if made.root else None).cast("string")
    folded, passed = (F.lower(F.hex(c)) for c in (F.get("folded", F.col("k")), F.col("passed")))
    return rows.select(
        "kid.doc_id", "kid.leaf", "subroot", root.alias("root"), F.sha2(F.concat(before, after, passed), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"))
