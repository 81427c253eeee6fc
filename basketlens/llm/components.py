"""Connected components of a graph in rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    tied = around.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b")
    return tied.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b")
    return tied.unionByName(least.select(F.col("least").alias("a"), F.col("a").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of all nodes of ``edges`` (a, b); the component is its smallest id.

    Neighbours are never gathered: each round is aggregates and joins over the edges, and
    the number of rounds grows with the logarithm of the longest path.
    """
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before, after = None, _state(edges)
    while before != after:
        edges = materialise(_small_star(_large_star(edges)))
        before, after = after, _state(edges)
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
