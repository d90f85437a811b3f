"""Using all cores on inputs that come in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame) -> DataFrame:
    """rows over at least as many partitions as there are cores, for stages that compute much per row.

    A file of one row group is read by one task however many splits it has.  An input of enough pieces stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
