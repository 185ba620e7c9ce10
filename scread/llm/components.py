"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges(a, b)``; loops and repeats do no harm.

    Each round links every larger neighbour of a node to its smallest one, then every smaller one (large and
    small star). Rounds grow with the logarithm of the longest path; each is written to the shared folder. The
    caller may ``discard`` the result when nothing will read it again.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    e = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = held = stage(e, name)
    before = None
    while True:
        n = both(e)
        low = n.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = n.join(low, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        e = large.join(small, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")).filter("a != b").distinct()
        e = stage(e, name)
        discard(held)
        held = e
        # a star forest maps to itself, and so do these figures
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.count_distinct("b")).first()
        if now == before and now[0] == now[2]:
            break
        before = now
    nodes = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    nodes = nodes.union(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    nodes._staged = e._staged
    return nodes
