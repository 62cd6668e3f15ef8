"""Connected components of a link table, by alternating star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import removed, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, and the node, is linked with the node's least neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked with the node's least neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: bigint); a component is named by its least node.

    Each step aggregates with map-side combination and joins on the node, so a node with very many links is split by
    adaptive execution; states are written tables. Ends when a pair of steps changes nothing.
    """
    state = written(_small_star(links.select("a", "b").distinct()), "components")
    mark = None
    while True:
        # a fixed point consists of stars around the least nodes; a sum of hashes tells whether the step changed anything
        now = state.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark is not None and now == mark:
            break
        mark = now
        following = written(_small_star(_large_star(state)), "components")
        removed(state)
        state = following
    members = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())
