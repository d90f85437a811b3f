"""The queries of a retrieval client: vectors, words, both, images, neighbours, quality."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions import vectors as V
from quire.plans.snapshots import Store


def nearest(rows: DataFrame, vector: list[float], k: int = 10, embedding: str = "embedding", order: str = "id", where: Column | None = None) -> DataFrame:
    """The k rows of highest cosine similarity to a query vector, ties by `order`.  An exact scan of one pass: each
    task keeps k rows.  Null, zero, non-finite and odd-length vectors take no part."""
    r = rows if where is None else rows.filter(where)
    scored = r.withColumn("similarity", V.cosine_to(F.col(embedding), [float(x) for x in vector]))
    return scored.filter("similarity is not null").orderBy(F.desc("similarity"), order).limit(k)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def ranked(rows: DataFrame, query: str, k: int = 10, text: str = "chunk_text", order: str = "id") -> DataFrame:
    """Rows that hold all words of a query, by the sum over words of 1 + ln(occurrences), divided by 1 + ln(words in
    the row); ties by `order`."""
    terms = sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})
    w = words(F.col(text))
    r = rows.withColumn("_w", w).filter(F.lit(bool(terms)))
    for t in terms:
        r = r.filter(F.array_contains("_w", t))
    times = lambda t: F.size(F.filter("_w", lambda x: x == t))
    score = sum((1 + F.ln(times(t)) for t in terms), F.lit(0.0)) / (1 + F.ln(F.size("_w")))
    return r.withColumn("rank", score).drop("_w").orderBy(F.desc("rank"), order).limit(k)


def hybrid(rows: DataFrame, word: str, vector: list[float], k: int = 10, text: str = "chunk_text", **more: str) -> DataFrame:
    """Rows that contain a word, by similarity to a vector."""
    return nearest(rows, vector, k, where=F.col(text).contains(word), **more)


def neighbours(relations: DataFrame, names: DataFrame) -> DataFrame:
    """(entity, neighbour, relation_type, weight) for the entities in names (entity); relations read both ways."""
    out = relations.select(F.col("source_entity").alias("entity"), F.col("target_entity").alias("neighbour"), "relation_type", "weight")
    back = relations.select(F.col("target_entity").alias("entity"), F.col("source_entity").alias("neighbour"), "relation_type", "weight")
    return out.unionByName(back.filter("entity <> neighbour")).join(names, "entity", "left_semi")


def quality(chunks: DataFrame, text: str = "chunk_text") -> DataFrame:
    """One row: chunks, how many end a sentence, spread and quartiles of their lengths (exact, from counts by length), and
    rows that lack metadata."""
    c = F.col(text)
    ends = F.coalesce(T.strip(c).rlike(r"[。！？.!?…।؟][\"”’」』）)]*$"), F.lit(False))
    return chunks.agg(
        F.count("*").alias("chunks"),
        F.count_if(ends).alias("ends_in_mark"),
        F.count_if(T.blank(c)).alias("blank"),
        F.min(F.length(c)).alias("least"),
        F.max(F.length(c)).alias("most"),
        F.sum(F.length(c)).alias("chars"),
        *[F.percentile(F.length(c), p).alias(n) for p, n in ((0.25, "quarter"), (0.5, "half"), (0.75, "three_quarters"), (0.95, "most_but_a_twentieth"))],
        F.count_if(F.coalesce(F.col("source_file"), F.lit("")) == "").alias("no_source"),
        F.count_if(F.coalesce(F.col("processed_at"), F.lit("")) == "").alias("no_time"),
        F.count_if(F.col("embedding").isNull()).alias("no_vector"),
    )


def images_of(chunks: DataFrame, doc_name: str) -> DataFrame:
    """(id, image_no, filename, path) of each image that the chunks of a document list; a list that cannot be read is
    empty."""
    listed = chunks.filter(F.col("has_images") & (F.col("doc_name") == doc_name))
    images = F.from_json("images_json", "array<struct<filename:string,path:string>>")
    return listed.select("id", F.posexplode(images).alias("image_no", "i")).select("id", "image_no", "i.filename", "i.path")


class Client:
    """Searches over the published chunks of a store; each call sees the snapshot of that moment."""

    def __init__(self, spark: SparkSession, store: Store, embed: Callable[[list[str]], Sequence[Sequence[float]]]) -> None:
        self.spark, self.store, self.embed = spark, store, embed

    def chunks(self) -> DataFrame:
        rows = self.store.read(self.spark, "doc_chunks")
        if rows is None:
            raise LookupError("nothing is published yet")
        return rows

    def search(self, text: str, k: int = 10, doc_name: str | None = None, space_id: str | None = None) -> DataFrame:
        """The k chunks nearest to a text, of one document or space if named."""
        where = F.lit(True)
        for column, value in (("doc_name", doc_name), ("space_id", space_id)):
            if value is not None:
                where = where & (F.col(column) == value)
        return nearest(self.chunks(), list(self.embed([text])[0]), k, order="chunk_id", where=where)
