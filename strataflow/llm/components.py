"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b")).where("a > b")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every a is under one b, and no b is under another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("under"), F.lit(0).alias("over"))
    ends = ends.union(edges.select(F.col("b").alias("node"), F.lit(0).alias("under"), F.lit(1).alias("over")))
    return ends.groupBy("node").agg(F.sum("under").alias("under"), F.max("over").alias("over")).where("under > 1 or (under = 1 and over = 1)").count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge: root is its component's smallest node.

    edges: columns a and b of an orderable type; direction and repeats don't matter. Every round replaces the
    edges by at most as many, until they are stars, which no round changes (of the order of log^2 of the longest chain
    rounds); minima are partial aggregates, so that a hub's edges never meet in one task.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    while True:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
        if _are_stars(now):
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
