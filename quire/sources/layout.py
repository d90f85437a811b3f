"""The folder layout that readers of one file per chunk expect, and JSON lines."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions import text as T


def or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table of any file system, or an empty one of this schema where there is none yet or it is no table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; lines that cannot be read are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def chunk_files(spark: SparkSession, root: str) -> DataFrame:
    """(doc_name, chunk_index, content) of root/<doc>/chunks/chunk_NNNN.txt; blank files are left out."""
    f = spark.read.text(f"{root}/*/chunks/chunk_*.txt", wholetext=True).select("value", F.col("_metadata.file_path").alias("p"))
    at = F.regexp_extract("p", r"/([^/]+)/chunks/chunk_(\d+)\.txt$", 1)
    no = F.regexp_extract("p", r"chunk_(\d+)\.txt$", 1).cast("int")
    return f.select(F.url_decode(at).alias("doc_name"), no.alias("chunk_index"), F.col("value").alias("content")).filter(~T.blank("content"))


def write_chunk_files(chunks: DataFrame, root: str) -> None:
    """A folder per document, written from the executors into a folder that they all share: a text, a metadata and, where
    there is a vector, an embedding file per chunk, the index of the chunks and what is known of the document.

    A name is made safe for a file first, so none leads out of the root.  Columns beyond doc_name, chunk_index, chunk_id,
    char_count and content go into the files if they are there.
    """
    c = chunks.withColumn("_folder", T.safe_filename("doc_name", F.lit("untitled")))
    more = [x for x in ("doc_format", "doc_timestamp", "has_images", "image_count", "images_json") if x in chunks.columns]
    meta = F.to_json(F.struct(F.col("doc_name").alias("source"), "chunk_id", F.col("chunk_index").alias("index"), "char_count", *more))
    vector = F.to_json(F.struct("chunk_index", "embedding")) if "embedding" in chunks.columns else F.lit(None).cast("string")

    def write(rows) -> None:  # noqa: ANN001
        for r in rows:
            at = Path(root) / r.folder / "chunks"
            at.mkdir(parents=True, exist_ok=True)
            (at / f"chunk_{r.chunk_index:04d}.txt").write_text(r.content, encoding="utf-8", newline="")
            atomic_json(at / f"chunk_{r.chunk_index:04d}.json", json.loads(r.meta))
            if r.vector and "embedding" in (v := json.loads(r.vector)):
                atomic_json(at.parent / "embeddings" / f"chunk_{r.chunk_index:04d}.json", v)

    def index(rows) -> None:  # noqa: ANN001
        for r in rows:
            listed = [json.loads(x) for x in r.listed]
            atomic_json(Path(root) / r.folder / "chunks_index.json", {"total_chunks": r.n, "chunks": listed})
            atomic_json(Path(root) / r.folder / "doc_info.json", {"filename": r.name, "format": r.form, "total_chunks": r.n, "total_images": r.images})

    c.select(F.col("_folder").alias("folder"), "chunk_index", "content", meta.alias("meta"), vector.alias("vector")).foreachPartition(write)
    images = F.sum("image_count") if "image_count" in chunks.columns else F.lit(0)
    form = F.max("doc_format") if "doc_format" in chunks.columns else F.lit("Unknown")
    per = c.withColumn("_m", F.struct("chunk_index", meta.alias("m"))).groupBy("_folder").agg(F.max("doc_name").alias("name"), form.alias("form"), F.count("*").alias("n"), images.alias("images"), F.transform(F.array_sort(F.collect_list("_m")), lambda x: x["m"]).alias("listed"))
    per.withColumnRenamed("_folder", "folder").foreachPartition(index)


def atomic_json(path: str | os.PathLike, value: object, replace: Callable[[str, str], None] = os.replace) -> None:
    """A JSON file that is there in full or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{os.getpid()}")
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    for pause in (0.05, 0.2, 1.0, None):  # a reader may hold the file for a moment
        try:
            return replace(str(temporary), str(path))
        except PermissionError:
            if pause is None:
                raise
            time.sleep(pause)
    return None
