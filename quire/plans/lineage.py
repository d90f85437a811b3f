"""Cutting lineage through storage that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; the one the session names, or a temporary one where it names none (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quire-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read back from the shared folder, so that a lost executor costs no recomputation.

    The files go when nothing refers to them any more, in sessions started with
    spark.cleaner.referenceTracking.cleanCheckpoints; else with the folder.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
