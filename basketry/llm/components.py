"""Connected components of a distributed edge list (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component = smallest node.

    Each round points every node at the smallest of its neighbours, first
    for the larger neighbours, then for the smaller ones, until nothing
    changes; the rounds grow with the logarithm of a component's size.  Minima
    are aggregated before the shuffle, so a hub's edges never meet in one task.
    """
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        linked = both.join(least, "a")
        if large:   # larger neighbours go to the minimum
            return linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        to_least = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return to_least.unionAll(least.filter("a <> m").select("a", F.col("m").alias("b"))).distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(now)
    while before[0]:
        now = checkpointed(star(star(now, True), False))
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
