"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of these neighbours."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b``: every node but the smallest of its component, and that smallest node.

    ``edges`` has the node columns ``a`` and ``b``, in any order; nulls and loops are left out.
    Stars shrink towards the smallest node, so a long chain halves in each round, and a hot
    node's edges are joined to one row that holds its minimum.
    """
    edges = edges.filter("a is not null and b is not null and a != b")
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now == mark or not now.n:
            return edges
        mark = now
        edges = stored(small_star(large_star(edges).distinct()).distinct(), "edges")
