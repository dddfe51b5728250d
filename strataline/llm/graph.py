"""Connected components by alternating large-star and small-star rounds on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored

ROUNDS = 60  # rounds double what a label reaches; a limit against endless loops, not on the work


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Of undirected edges ``(a, b)`` (longs): one row ``(node, component)`` per node that has an edge,
    with the smallest node it reaches. No edges give no rows; self loops and repeats are ignored.

    Every round is two equi-joins with a table of one row per node; a node with very many edges is a skewed join
    side, which Spark splits. Only a count and a checksum of the edges reach the driver.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(ROUNDS):
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if seen == mark or not seen[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = seen
        current = stored(_small_star(_large_star(current).distinct()).distinct(), "edges")
    raise RuntimeError("components did not settle")
