"""Connected components of a graph of any size, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _least(edges: DataFrame) -> DataFrame:
    """Each node with its least neighbour, itself included."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of its surroundings."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = down.join(_least(down), "u")
    return (tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(tied.select("u", F.col("m").alias("v"))).where("u != v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); the root is the least node.

    Alternates both stars until the edges stay the same.  Each round stores
    its edges, so a lost executor costs one round; the number of rounds grows
    with the logarithm of the longest path.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = store(edges.where("u != v").select("u", "v").distinct(), "links")
    now = state(edges)
    while now[0]:
        edges = store(small_star(large_star(edges)), "links")
        before, now = now, state(edges)
        if now == before:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
