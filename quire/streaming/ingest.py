"""Documents as a stream: new files are chunked and stored as they come, event streams are summed by window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import chunks


def documents(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def chunk_stream(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The same chunks as for a batch; stateless, so any output mode will do."""
    return chunks.chunked(docs, key, text)


def store_stream(stream: DataFrame, path: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame] | None = None, once: bool = True) -> StreamingQuery:
    """Append each micro-batch, after `stage`, under its batch number; a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        rows = stage(batch) if stage else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 hours")).start()


def latest_by_key(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """A stream without repeats of (key, time) within the allowed lateness."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key, time])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per tumbling window and group; what comes later than `late` is not counted."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
