"""What is new, changed, finished or left to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.plans.order import in_blocks


def change_state(known: Column, path_exists: Column, path: Column, old_time: Column, new_time: Column) -> Column:
    """new, missing (the recorded file is gone), changed or same.  Times compare as text, and only if both are set."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.when(~known, "new")
        .when(has(path) & ~path_exists, "missing")
        .when(has(old_time) & has(new_time) & (old_time != new_time), "changed")
        .otherwise("same")
    )


def changed(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """entries (token, obj_edit_time ...) with their state against the manifest (token, obj_edit_time, file_path,
    path_exists), one row per token in it."""
    m = manifest.select("token", F.col("obj_edit_time").alias("_t"), "file_path", "path_exists", F.lit(True).alias("_known"))
    e = entries.join(m, "token", "left")
    state = change_state(F.coalesce("_known", F.lit(False)), F.coalesce("path_exists", F.lit(False)), F.col("file_path"), F.col("_t"), F.col("obj_edit_time"))
    return e.withColumn("state", state).drop("_t", "_known", "file_path", "path_exists")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in `order`; a running maximum of structs, so no key is sorted in one task."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_r")).select("_r.*")


def without(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(other.select(*on).distinct(), on, "left_anti")


#: Chunks that are hashed as one text at most.
HASHED = 1000


def document_hashes(chunks: DataFrame, doc: str, order: list[str], content: str, most: int = HASHED) -> DataFrame:
    """SHA-256 over a document's chunk texts in order, without anything between.  A document of more than `most` chunks
    has the digest of its blocks' digests, so that a name which many documents share is gathered in no task."""
    c = in_blocks(chunks.select(doc, *order, content), doc, order, most)
    joined = lambda rows, x: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda s: s[x]), ""), 256)
    part = c.groupBy(doc, "block").agg(joined(F.struct(*order, content), content).alias("_d"))
    whole = part.groupBy(doc).agg(joined(F.struct("block", "_d"), "_d").alias("_all"), F.max("block").alias("_last"), F.min("_d").alias("_one"))
    return whole.select(doc, F.when(F.col("_last") == 0, F.col("_one")).otherwise(F.col("_all")).alias("hash"))


def set_hashes(rows: DataFrame, key: str, content: str) -> DataFrame:
    """(key, hash) of each key's contents in any order, copies counted: sums of the parts of their SHA-256 digests, which
    tasks add up before anything moves."""
    d = rows.select(key, F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("_d"))
    parts = [F.sum(F.conv(F.substring("_d", 1 + 16 * i, 15), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    return d.groupBy(key).agg(F.concat_ws("-", F.count("*").cast("string"), *[p.cast("string") for p in parts]).alias("hash"))


def to_build(hashes: DataFrame, manifest: DataFrame, doc: str, force: bool = False) -> DataFrame:
    """Documents whose hash is not the one in the manifest; all of them with `force`."""
    m = manifest.select(doc, F.col("hash").alias("_old"))
    h = hashes.join(m, doc, "left").withColumn("skipped", F.lit(False) if force else F.coalesce(F.col("_old") == F.col("hash"), F.lit(False)))
    return h.drop("_old")


def advanced(manifest: DataFrame, hashes: DataFrame, done: DataFrame, doc: str) -> DataFrame:
    """The next manifest: new hashes for documents that were built, old ones for the rest."""
    fresh = hashes.join(done.select(doc).distinct(), doc, "left_semi").select(doc, "hash")
    return fresh.unionByName(manifest.join(fresh, doc, "left_anti").select(doc, "hash"))


def first_open(submitted: DataFrame, finished: DataFrame, key: str, order: str) -> DataFrame:
    """The first submitted item that is not finished: where a run that broke off goes on."""
    return without(submitted, finished, [key]).orderBy(order, key).limit(1)


def work_list(downloaded: DataFrame, recorded: DataFrame, scanned: DataFrame, key: str) -> DataFrame:
    """Items from the freshest of three sources: what was just downloaded, else recorded, else found on disk."""
    parts = [d.select(key, "path", F.lit(rank).alias("_rank")) for rank, d in enumerate((downloaded, recorded, scanned))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    origin = F.element_at(F.array(F.lit("download"), F.lit("manifest"), F.lit("directory")), F.col("_rank") + 1)
    return latest(every, [key], [-F.col("_rank"), F.col("path")]).select(key, "path", origin.alias("origin"))


def replaced(stored: DataFrame, fresh: DataFrame, doc: str) -> DataFrame:
    """Stored rows with every document of `fresh` exchanged for its new rows; shorter ones leave nothing behind."""
    return without(stored, fresh, [doc]).unionByName(fresh, allowMissingColumns=True)


def upserted(stored: DataFrame, fresh: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Both, with one row per key: a fresh row wins over a stored one, the last in `order` among equals."""
    both = stored.withColumn("_fresh", F.lit(0)).unionByName(fresh.withColumn("_fresh", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, [F.col("_fresh"), *order]).drop("_fresh")


def with_columns(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Columns added where they lack, and nulls in them filled."""
    return rows.select("*", *[v.alias(c) for c, v in defaults.items() if c not in rows.columns]).withColumns(
        {c: F.coalesce(F.col(c), v) for c, v in defaults.items() if c in rows.columns}
    )


def appended(stored: DataFrame, fresh: DataFrame, batch: str) -> DataFrame:
    """Both; a batch of `fresh` that was stored before, by a run that is done again, is not doubled."""
    return replaced(stored, fresh, batch)
