"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.lineage import cut


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One step: every neighbour that is larger (or, in the small step, not larger) is tied to the node's minimum."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if larger else edges.select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    tied = both.join(least, "src")
    if larger:
        return tied.filter("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
    return (
        tied.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .unionByName(least.select("src", F.col("low").alias("dst")))
        .filter("src <> dst")
        .distinct()
    )


def connected(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) of every node in an edge table (src, dst); component is the smallest node reached.

    Null ends and self loops link nothing.  A hub costs one row per neighbour in each round, never a pair of
    neighbours.  Rounds grow with the logarithm of the longest path.
    """
    now = edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst").distinct()
    now = cut(now)
    before = None
    for _ in range(most_rounds):
        now = cut(_stars(_stars(now, True), False))
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
        if before == mark:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                now.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
            ).distinct()
        before = mark
    raise RuntimeError("components did not settle")
