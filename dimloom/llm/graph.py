"""Connected components of an edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.llm.common import stored


def _towards_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Point the neighbours of every node at the least of them and the node itself.

    ``larger``: only the neighbours above the node; otherwise those below it, and the node.
    The least is aggregated and joined, not windowed, so a hub's edges may be split.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "least")
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), "least")
        moved = moved.unionByName(least)
    return moved.where("a <> least").select("a", F.col("least").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node) of every node that has an edge (a, b), a <> b.

    Every edge is kept from its larger to its smaller node. Rounds go on until none changes; a
    round at least halves the paths, so their number grows with the logarithm of the size.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.where("a <> b").distinct(), "edges")
    known = None
    while True:
        edges = stored(_towards_least(_towards_least(edges, larger=True), larger=False), "stars")
        state = edges.agg(
            F.count("*").alias("edges"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum"),
        ).first()
        if state == known:
            break
        known = state
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
