"""Chunks of documents: cutting, identity, image references, metadata, entities and sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.core import splitting
from quire.functions import text as T


def chunked(docs: DataFrame, key: str, text: str, size: int = splitting.SIZE, overlap: int = splitting.OVERLAP) -> DataFrame:
    """(key, chunk_index, content, char_count, chunk_id) of each document by recursive splitting.

    A text below the limit is one stripped chunk and never leaves the JVM; null, empty and blank texts have none.
    """
    c = F.col(text)
    long = F.length(c) >= size
    cut = docs.filter(c.isNotNull()).select(key, c.alias("_t"), long.alias("_long"), T.split_udf(F.when(long, c), size, overlap).alias("_cut"))
    # a text of exactly the limit is cut by its separators, so it goes the long way; a shorter one is one chunk
    parts = cut.select(key, F.posexplode(F.when(F.col("_long"), F.col("_cut")).otherwise(F.when(~T.blank("_t"), F.array(T.strip("_t"))))).alias("chunk_index", "content"))
    return with_ids(parts)


def with_ids(parts: DataFrame) -> DataFrame:
    return parts.withColumn("char_count", F.length("content")).withColumn("chunk_id", T.chunk_id("content", "chunk_index"))


def with_images(chunks: DataFrame, images: DataFrame, doc: str = "doc_name") -> DataFrame:
    """chunks (doc, chunk_index, content ...) with has_images, image_count and the list of images in text order.

    images is (doc, filename, original_filename, context_before, context_after), one row per name (see last_named).
    A reference without a row keeps its name and path alone; contexts are cut to 100 code points.
    """
    refs = chunks.select(doc, "chunk_index", F.posexplode(T.image_references("content")).alias("pos", "filename"))
    found = refs.join(images.withColumn("known", F.lit(True)), [doc, "filename"], "left")
    one = F.struct(
        "pos",
        "filename",
        F.when(F.col("known"), F.coalesce("original_filename", F.lit(""))).alias("original_filename"),
        F.concat(F.lit("./images/"), F.col("filename")).alias("path"),
        F.when(F.col("known"), F.left(F.coalesce("context_before", F.lit("")), F.lit(100))).alias("context_before"),
        F.when(F.col("known"), F.left(F.coalesce("context_after", F.lit("")), F.lit(100))).alias("context_after"),
    )
    lists = found.groupBy(doc, "chunk_index").agg(F.array_sort(F.collect_list(one)).alias("_i"))
    images_of = F.transform("_i", lambda s: s.dropFields("pos"))
    c = chunks.join(lists, [doc, "chunk_index"], "left")
    return c.withColumn("image_count", F.coalesce(F.size("_i"), F.lit(0))).withColumn("has_images", F.col("image_count") > 0).withColumn("images", images_of).drop("_i")


def metadata(chunks: DataFrame, doc_format: Column | None = None) -> DataFrame:
    """Chunk rows with their metadata struct and the key doc_name_timestamp_chunk_id.

    The real format goes in; with doc_format None it is 'Unknown', as older readers expect.
    """
    meta = F.struct(
        F.col("doc_name").alias("source"), "chunk_id", "chunk_index", "char_count",
        (doc_format if doc_format is not None else F.lit("Unknown")).alias("doc_format"),
        "doc_timestamp", "processed_at", "has_images", "image_count", "images",
    )
    return chunks.select(F.concat_ws("_", "doc_name", "doc_timestamp", "chunk_id").alias("id"), "doc_name", "doc_timestamp", "chunk_index", meta.alias("metadata"))


def last_named(images: DataFrame, doc: str, name: str, order: str) -> DataFrame:
    """One row per image name of a document, the last in order; blank names are dropped."""
    return images.filter(F.coalesce(F.col(name), F.lit("")) != "").groupBy(doc, name).agg(F.max_by(F.struct("*"), order).alias("_r")).select("_r.*")


def token_windows(tokens: Column, size: int = 1500, overlap: int = 200) -> Column:
    """array<array<..>> of windows over a token list, each beginning size - overlap after the one before; the last
    one ends with the list."""
    step = size - overlap
    count = F.greatest(F.ceil((F.size(tokens) - overlap) / step), F.lit(1)).cast("int")
    return F.when(F.size(tokens) > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(tokens, i * step + 1, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))
