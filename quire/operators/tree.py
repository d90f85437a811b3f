"""Walking a tree kept as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.plans.lineage import cut


def walked(nodes: DataFrame, node: str, parent: str, most_depth: int = 10) -> DataFrame:
    """Nodes reached from the roots (null or empty parent) with level (0 for a root) and root, down to `most_depth`.

    Rows repeated in full or under one node id count once.  Nodes under an unknown parent and those of a cycle are
    not reached.  Each round doubles the step that a node knows towards its root, so four joins walk ten levels.
    """
    n = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent")).filter("node is not null").groupBy("node").agg(F.min("parent").alias("parent"))
    is_root = F.coalesce("parent", F.lit("")) == ""
    # up: the node `level` steps above; done once that is a root
    now = cut(n.select("node", F.when(is_root, F.col("node")).otherwise(F.col("parent")).alias("up"), F.when(is_root, 0).otherwise(1).alias("level"), is_root.alias("done")))
    steps = 1
    while steps < most_depth + 1:
        far = now.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("level").alias("_level"), F.col("done").alias("_done"))
        open_ones = now.filter(~F.col("done")).join(far, "up").select("node", F.col("_up").alias("up"), (F.col("level") + F.col("_level")).alias("level"), F.col("_done").alias("done"))
        now = cut(now.filter("done").unionByName(open_ones.filter(F.col("done") | (F.col("level") <= most_depth))))
        steps *= 2
    return now.filter(F.col("done") & (F.col("level") <= most_depth)).select("node", "level", F.col("up").alias("root"))
