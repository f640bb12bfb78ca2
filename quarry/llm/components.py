"""Connected components of a table of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a, b (long).  Returns node, component: the smallest
    node that links reach, for every node of a link.

    Each round every node moves to the neighbour (or itself) of least hashed
    id, and once more from there; links are drawn again between the places
    reached, until none is left.  Hashed ids keep the chains short, so a few
    rounds do.  Moving along links never parts a component.  Every round is
    written to the shared folder; hubs only meet in aggregates, which combine
    before the shuffle, and in joins, which Spark splits where they are skewed.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links, moves = saved(links, "links"), []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b")).alias("to"))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("b"))
        step = saved(near.select("node", F.least("to", own)["b"].alias("to")), "step")
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("then"))
        move = saved(step.join(onward, "to").select("node", F.col("then").alias("to")), "move")
        moves.append(move)
        for end in ("a", "b"):
            place = move.select(F.col("node").alias(end), F.col("to").alias("place"))
            links = links.join(place, end).drop(end).withColumnRenamed("place", end)
        links = links.where(F.col("a") != F.col("b"))
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = saved(links, "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    at = moves[0]
    for move in moves[1:]:
        onward = move.select(F.col("node").alias("to"), F.col("to").alias("then"))
        at = at.join(onward, "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    at = saved(at, "places")
    least = at.groupBy("to").agg(F.min("node").alias("component"))
    return at.join(least, "to").select("node", "component")
