"""Order-dependent columns within keys of any size.

Rows are range-partitioned by key and order, so a hot key lies in many partitions; each works on its own part, and what
crosses a border comes from one small row per key and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.lineage import cut


def _placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    # kept in the shared folder: a range partitioning that is computed anew need not cut at the same rows
    return cut(rows.repartitionByRange(F.col(key), *[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()))


def _joined(placed: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    p = parts.withColumnRenamed(key, "_key").withColumnRenamed("_part", "_p")
    return placed.join(p, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p"))).drop("_key", "_p", "_part")


def numbered(rows: DataFrame, key: str, order: list[str], out: str = "number") -> DataFrame:
    """rows with their number from 1 within the key; ties in `order` are numbered in any order."""
    placed = _placed(rows, key, order)
    size = placed.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    size = size.select(key, "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    mine = placed.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)))
    return _joined(mine, size, key).withColumn(out, F.col("_before") + F.col("_i")).drop("_before", "_i")


def beside(rows: DataFrame, key: str, order: list[str], value: Column, before: str = "before", after: str = "after") -> DataFrame:
    """rows with the value of the row before and of the row after within the key; null at the ends."""
    placed = _placed(rows.withColumn("_v", value), key, order)
    w = Window.partitionBy(key, "_part").orderBy(*order)
    mine = placed.withColumn("_b", F.lag("_v").over(w)).withColumn("_a", F.lead("_v").over(w))
    mine = mine.withColumn("_first", F.lag(F.lit(1)).over(w).isNull()).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    at = F.struct(*order)
    edge = placed.groupBy(key, "_part").agg(F.min_by("_v", at).alias("_head"), F.max_by("_v", at).alias("_tail"))
    e = Window.partitionBy(key).orderBy("_part")
    edge = edge.select(key, "_part", F.lag("_tail").over(e).alias("_eb"), F.lead("_head").over(e).alias("_ea"))
    j = _joined(mine, edge, key)
    j = j.withColumn(before, F.when(F.col("_first"), F.col("_eb")).otherwise(F.col("_b")))
    return j.withColumn(after, F.when(F.col("_last"), F.col("_ea")).otherwise(F.col("_a"))).drop("_v", "_b", "_a", "_first", "_last", "_eb", "_ea")


def in_blocks(rows: DataFrame, key: str, order: list[str], most: int, out: str = "block") -> DataFrame:
    """rows with the number, from 0, of their block of `most` consecutive rows within the key.  Rows of keys that have no
    more are in block 0 and move nowhere; only the rows of larger keys are ordered."""
    many = cut(rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(F.col(key).alias("_key"), F.lit(True).alias("_many")))
    same = F.col(key).eqNullSafe(F.col("_key"))
    few = rows.join(many, same, "left_anti").withColumn(out, F.lit(0).cast("long"))
    large = rows.join(many, same, "left_semi")
    block = F.floor((F.col("_no") - 1) / most).cast("long")
    return few.unionByName(numbered(large, key, order, "_no").withColumn(out, block).drop("_no"))
