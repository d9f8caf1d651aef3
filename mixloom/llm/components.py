"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``id`` and ``component`` (its smallest member) of every vertex of ``edges`` (columns a, b: longs).

    Each round hangs the larger neighbours of a vertex on its smallest neighbour, then the smaller
    ones; the number of rounds grows with the logarithm of the longest path. A vertex with many
    neighbours only meets them in an aggregate and in a join to one row. The aggregates are written,
    so that the joins stand alone and adaptive execution can split them.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    table = scratch.keep(pairs.distinct())
    while True:
        both = table.union(table.select("b", "a"))
        # Large star: neighbours above the vertex point to the smallest vertex around.
        least = scratch.keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.keep(large)
        # Small star: the vertex and its smaller neighbours point to the smallest of them.
        low = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        fresh = scratch.keep(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        # Stable once every vertex has one edge and no root has a parent.
        open_ends = fresh.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        chained = fresh.join(fresh.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        done = open_ends.select("a").union(chained.select("a")).isEmpty()
        scratch.drop(table, least, large, low)
        table = fresh
        if done:
            break
    members = table.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = table.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return members.union(roots)
