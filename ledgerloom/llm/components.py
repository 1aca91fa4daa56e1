"""Connected components of a link table by large-star and small-star steps, each one a Spark aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import cut, release_shuffles


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One step: every node hands its least neighbour (or itself) to its larger, or to its smaller, neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hit = both.join(least, "a")
    if larger:
        out = hit.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hit.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame, most_steps: int = 60) -> DataFrame:
    """(a, b) links of one orderable type -> (node, root): root is the least node that node reaches. Nulls link nothing.

    Links stay in Spark; each round of two steps is checkpointed, and the driver sees two numbers of it. Rounds grow
    with the logarithm of the longest chain.
    """
    now = cut(links.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    before = None
    for _ in range(most_steps):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = cut(_stars(_stars(now, True), False))
        release_shuffles(links.sparkSession)
    raise RuntimeError(f"components did not settle in {most_steps} rounds")
