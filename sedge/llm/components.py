"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import removed, written


def components(edges: DataFrame, folder: str, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest reachable node.

    ``edges`` has two long columns a and b.  A round links every larger neighbour of a node to the
    smallest (large star), then every smaller one (small star); after a number of rounds that is
    logarithmic in the length of the longest path only stars are left.  Minima are aggregated before
    the shuffle and each table is written before it is joined, so that a hub's rows can be split.
    """
    now = written(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/0")
    before = None
    for k in range(1, most_rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{folder}/{k}-large")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, f"{folder}/{k}-linked")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{folder}/{k}-small")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{folder}/{k}")
        removed(*(f"{folder}/{x}" for x in (k - 1, f"{k}-large", f"{k}-linked", f"{k}-small")))
        # a star forest is reached when no node is both a leaf and a centre, and no leaf has two centres
        state = now.agg(F.count("*"), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components have not settled")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
