"""Connected components of a graph of any size by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that can be reached, for every node of the edges (a, b).

    Each round hangs the larger neighbours of every node, then the smaller ones,
    under the smallest of them; nothing but smallest neighbours is aggregated, so
    a node with very many links is combined before the shuffle. Rounds are
    written to the shared checkpoint folder.
    """
    now = materialize(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        around = _both_ways(now)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = around.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(lowest, "a")
        small = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(hung.select("a", F.col("low").alias("b")))
        after = materialize(small.filter(F.col("a") != F.col("b")).distinct())
        # a star forest is the end: no node is both above and below another
        if after.select("a").intersect(after.select("b")).isEmpty() and _degree(after) <= 1:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        now = after


def _degree(edges: DataFrame) -> int:
    return edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
