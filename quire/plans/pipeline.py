"""From files or texts to published tables, as one lazy plan per stage."""

from __future__ import annotations

import logging
import shutil
import time
from collections.abc import Callable, Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import Options
from quire.functions import text as T
from quire.operators import changes, chunks, documents, embedding, exports, graph, search
from quire.plans.lineage import cut
from quire.plans.snapshots import Store, lock
from quire.sources import layout, word

STEPS = ("download", "process", "store", "graph")
DOCUMENT = "doc_name string, doc_format string, text string, space_id string, source_url string, error string"
log = logging.getLogger("quire")


def read_folder(spark: SparkSession, folder: str, options: Options = Options(), client: Callable | None = None, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (see DOCUMENT) of a folder and the index of their images.

    Word-processor files are parsed here; pages are the pages of PDF files (doc_name, page_num, text, images names,
    text_blocks) from a reader of one's own.  A file that cannot be read, or whose format nothing reads, is a document
    with an error.
    """
    elems, media = cut(word.read(spark, folder)), word.images(spark, folder)
    texts, index = documents.assembled(elems, media, client, options.image_name_length, options.look_back, options.look_ahead, options.context_length)
    none = F.lit(None).cast("string")
    failed = elems.groupBy("doc_name").agg(F.max("error").alias("error"))
    docs = failed.join(texts, "doc_name", "left").select("doc_name", F.lit("Word").alias("doc_format"), "text", none.alias("space_id"), none.alias("source_url"), "error")
    others = word.files(spark, folder, "*").filter(~F.col("suffix").isin(".docx", ".json")).select("doc_name", "suffix")
    if pages is not None:
        paged = pages.select("doc_name", "page_num", documents.page_text(F.col("text"), F.col("images")).alias("content"))
        text = documents.joined_in_order(paged, "doc_name", "page_num", "content", out="text")
        docs = docs.unionByName(text.select("doc_name", F.lit("PDF").alias("doc_format"), "text", none.alias("space_id"), none.alias("source_url"), none.alias("error")))
        others = others.join(text, "doc_name", "left_anti")
    unread = others.select("doc_name", F.upper(F.substring("suffix", 2, 9)).alias("doc_format"), none.alias("text"), none.alias("space_id"), none.alias("source_url"), F.concat(F.lit("no reader: "), T.reader_of("suffix")).alias("error"))
    return docs.unionByName(unread), index


def processed(docs: DataFrame, options: Options = Options(), load: Callable | None = None, images: DataFrame | None = None) -> DataFrame:
    """Chunk rows of documents (doc_name, doc_format, text, space_id, source_url) in the shape of the store's main
    table, with images and vectors.  A document without text gives no row."""
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")  # noqa: DTZ005
    keep = F.struct("doc_name", "doc_format", "space_id", "source_url").alias("k")
    c = chunks.chunked(docs.select(keep, "text"), "k", "text", options.chunk_size, options.chunk_overlap)
    c = c.select("k.*", "chunk_index", "content", "char_count", "chunk_id")
    index = images if images is not None else docs.sparkSession.createDataFrame([], "doc_name string, filename string, original_filename string, context_before string, context_after string")
    listed = chunks.last_named(index.withColumn("_at", F.col("original_filename")), "doc_name", "filename", "_at")
    c = chunks.with_images(c, listed.select("doc_name", "filename", "original_filename", "context_before", "context_after"))
    form = F.lit("Unknown") if options.legacy_doc_format else F.coalesce("doc_format", F.lit("Unknown"))
    rows = c.select(
        "doc_name", form.alias("doc_format"), F.lit(stamp).alias("doc_timestamp"), "chunk_id", "chunk_index", F.col("content").alias("chunk_text"), "char_count", F.lit(None).cast("int").alias("page_number"),
        "has_images", "image_count", T.images_json(F.col("images")).alias("images_json"),
        F.col("doc_name").alias("source_file"), F.coalesce("space_id", F.lit("")).alias("space_id"), F.coalesce("source_url", F.lit("")).alias("source_url"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("processed_at"),
    )
    dims = options.dims
    return embedding.embedded(rows, "chunk_text", load or (lambda: embedding.hashing_model(dims)), options.embedding_batch)


def results(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_name, status, chunks, images, error) of each name: failed if a file could not be read or a chunk got no
    vector, skipped if it has no chunk, else success."""
    per = rows.groupBy("doc_name").agg(F.count("*").alias("chunks"), F.sum("image_count").alias("images"), F.count_if(F.col("embedding").isNull() & ~T.blank("chunk_text")).alias("_open"))
    error = F.max("error").alias("error") if "error" in docs.columns else F.lit(None).cast("string").alias("error")
    r = docs.groupBy("doc_name").agg(error).join(per, "doc_name", "left")
    failed = F.col("error").isNotNull() | (F.coalesce("_open", F.lit(0)) > 0)
    status = F.when(failed, "failed").when(F.col("chunks").isNull(), "skipped").otherwise("success")
    error = F.when(F.col("error").isNull() & failed, "no vector").otherwise(F.col("error"))
    return r.select("doc_name", status.alias("status"), F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("images", F.lit(0)).alias("images"), error.alias("error"))


def report(result: DataFrame) -> DataFrame:
    """One row: documents in all, by status, and chunks."""
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    return result.agg(F.count("*").alias("total"), of("success"), of("skipped"), of("failed"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"))


#: A word with the white space behind it, or one ideograph: the tokens of the graph's windows, which join to the text.
TOKEN = r"(?U)[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]\s*|[^\s\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]+\s*|\s+"


def windows(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """(chunk_id, doc_name, content, chunk_order): token windows over the documents' joined chunks."""
    text = documents.volumes(rows.select("doc_name", "chunk_index", "chunk_id", "chunk_text"), "doc_name", ["chunk_index", "chunk_id"], "chunk_text")
    w = chunks.token_windows(F.regexp_extract_all("full_text", F.lit(TOKEN), F.lit(0)), size, overlap)
    each = text.select("doc_name", "volume", F.posexplode(w).alias("at", "w")).select("doc_name", (F.col("volume") * 100_000 + F.col("at")).cast("int").alias("chunk_order"), F.array_join("w", "").alias("content"))
    return each.select(F.concat(F.lit("chunk-"), F.md5(F.concat_ws("\n", "doc_name", F.col("chunk_order").cast("string"), "content"))).alias("chunk_id"), "doc_name", "content", "chunk_order")


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, options: Options = Options()) -> None:
        self.spark, self.store, self.options = spark, Store(root), options

    def run(
        self,
        docs: DataFrame | None = None,
        steps: Sequence[str] = STEPS[1:],
        load: Callable | None = None,
        extractor: Callable = graph.capital_words,
        images: DataFrame | None = None,
        entries: DataFrame | None = None,
        export: Callable | None = None,
        folder: str | None = None,
        reset: bool = False,
    ) -> dict[str, float]:
        """Run the named steps; seconds by step.

        download: the new and changed of `entries` are exported to `folder` by the client that `export` makes.
        process, store: documents of `docs`, else of `folder`; names whose documents all have the texts that are stored
        are left out, of any other name all documents are built again, so those that share a name must come together.
        Failed names keep their old rows and their old hash, so they are tried again; an emptied name loses its rows.
        graph: documents whose stored chunks have changed are extracted again, the others keep what was found in them.
        reset: forget what is published first.
        """
        unknown = set(steps) - set(STEPS)
        if unknown:
            raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
        stops = [x for x in doctor(str(self.store.root)) if x.startswith("fatal")]
        if stops:
            raise RuntimeError("; ".join(stops))
        batch = datetime.now().strftime("%Y%m%d_%H%M%S_%f")  # noqa: DTZ005
        took: dict[str, float] = {}
        with lock(self.store.root / ".run"):
            if reset:
                self.store.drop()
            for name, of in (("download", ("download",)), ("process+store", ("process", "store")), ("graph", ("graph",))):
                if not set(of) & set(steps):
                    continue
                began = time.monotonic()
                if name == "download":
                    self._download(entries, export, folder, batch)
                elif name == "graph":
                    self._graph(extractor, load, batch)
                else:
                    if docs is None:
                        if folder is None:
                            raise ValueError("documents or a folder are needed")
                        docs, images = read_folder(self.spark, folder, self.options)
                    self._process(docs, images, load, "store" in steps, batch)
                took[name] = time.monotonic() - began
                log.info("%s took %.1f s", name, took[name])
        return took

    def _download(self, entries: DataFrame | None, export: Callable | None, folder: str | None, batch: str) -> None:
        if entries is None or export is None or folder is None:
            raise ValueError("entries, an export client and a folder are needed")
        known = self.store.read(self.spark, "downloads")
        if known is not None and not self.options.force_rebuild:
            found = word.files(self.spark, folder, "*").select(F.url_decode(F.regexp_replace("path", "^file:(//)?", "")).alias("file_path"), F.lit(True).alias("path_exists"))
            old = known.join(found, "file_path", "left").withColumn("path_exists", F.coalesce("path_exists", F.lit(False)))
            entries = changes.changed(entries, old).filter("state <> 'same'").drop("state")
        done = cut(exports.exported(entries, export, folder))
        fresh = done.filter("status = 'downloaded'").select("token", "name", "file_path", "obj_edit_time", "space_id", "source_url", F.current_timestamp().alias("downloaded_at"))
        self.store.publish({"downloads": fresh if known is None else changes.upserted(known, fresh, ["token"], [F.col("downloaded_at")]), "export_results": done}, f"{batch}_download")
        log.info("exports: %s", {r.status: r.n for r in exports.summary(done).collect()})

    def _process(self, docs: DataFrame, images: DataFrame | None, load: Callable | None, keep: bool, batch: str) -> None:
        stored, manifest = self.store.read(self.spark, "doc_chunks"), self.store.read(self.spark, "manifest")
        hashes = changes.set_hashes(docs, "doc_name", "text")
        if manifest is not None and not self.options.force_rebuild:
            docs = changes.without(docs, changes.to_build(hashes, manifest, "doc_name").filter("skipped"), ["doc_name"])
        fresh = cut(processed(docs, self.options, load, images))  # the vectors looked at are the ones stored
        result = cut(results(docs, fresh))
        log.info("documents: %s", report(result).first().asDict())
        if keep:
            done = result.filter("status <> 'failed'").select("doc_name")
            good = fresh.join(done, "doc_name", "left_semi")
            rows = good if stored is None else changes.without(stored, done, ["doc_name"]).unionByName(good, allowMissingColumns=True)
            known = changes.advanced(hashes.limit(0) if manifest is None else manifest, hashes, done, "doc_name")
            self.store.publish({"doc_chunks": rows, "manifest": known, "results": result}, batch)

    def _graph(self, extractor: Callable, load: Callable | None, batch: str) -> None:
        rows = self.store.read(self.spark, "doc_chunks")
        if rows is None:
            return
        o, read = self.options, lambda n: self.store.read(self.spark, n)
        hashes = cut(changes.document_hashes(rows, "doc_name", ["chunk_index", "chunk_id"], "chunk_text"))
        manifest, found, cuts = read("graph_manifest"), read("graph_found"), read("graph_windows")
        todo = hashes if manifest is None else changes.to_build(hashes, manifest, "doc_name", o.force_rebuild).filter("not skipped")
        fresh_cuts = cut(windows(rows.join(todo, "doc_name", "left_semi"), o.graph_window, o.graph_overlap))
        fresh = cut(graph.extracted(fresh_cuts, extractor).join(fresh_cuts.select("chunk_id", "doc_name"), "chunk_id"))
        failed = graph.errors_of(fresh.drop("doc_name")).join(fresh_cuts.select("chunk_id", "doc_name"), "chunk_id").select("doc_name").distinct()
        gone = todo if manifest is None else todo.select("doc_name").union(changes.without(manifest, hashes, ["doc_name"]).select("doc_name"))
        every = fresh if found is None else changes.without(found, gone, ["doc_name"]).unionByName(fresh)
        all_cuts = fresh_cuts if cuts is None else changes.without(cuts, gone, ["doc_name"]).unionByName(fresh_cuts)
        every = cut(every)
        stamp = F.lit(batch).alias("batch_timestamp")
        e = graph.entities_of(every)
        merged = graph.merged_entities(e).join(graph.source_ids(e, ["entity_name"]), "entity_name", "left").withColumn("_text", T.entity_text(F.col("entity_name"), F.col("description")))
        dims = o.dims
        vectors = embedding.embedded(merged, "_text", load or (lambda: embedding.hashing_model(dims)), o.entity_batch, stop=True).drop("_text")
        entities = graph.export_entities(vectors.select("*", stamp), "embedding")
        r = graph.relations_of(every)
        edges = r.join(graph.source_ids(r, ["source_entity", "target_entity"]).withColumnRenamed("source_chunk_id", "source_doc"), ["source_entity", "target_entity"], "left")
        relations = graph.export_relations(edges.select("*", stamp))
        done = changes.without(todo, failed, ["doc_name"])
        keep = hashes.limit(0) if manifest is None else manifest.select("doc_name", "hash").join(hashes, "doc_name", "left_semi")
        tables = {
            "entities": entities, "relations": relations, "graph_chunks": graph.export_chunks(all_cuts.select("*", stamp)), "entity_descriptions": graph.descriptions(e),
            "graph_found": every, "graph_windows": all_cuts, "graph_manifest": changes.advanced(keep, hashes, done, "doc_name"),
        }
        self.store.publish(tables, batch + "_graph")
        log.info("graph: %d documents built of %d", todo.count(), hashes.count())

    def client(self, load: Callable | None = None) -> search.Client:
        dims = self.options.dims
        return search.Client(self.spark, self.store, (load or (lambda: embedding.hashing_model(dims)))())

    def write_files(self, root: str) -> None:
        """The published chunks as one folder per document, for readers of files."""
        rows = self.store.read(self.spark, "doc_chunks")
        if rows is not None:
            layout.write_chunk_files(rows.select("doc_name", "doc_format", "doc_timestamp", "chunk_index", "chunk_id", "char_count", "has_images", "image_count", "images_json", "embedding", F.col("chunk_text").alias("content")), root)


def doctor(root: str) -> list[str]:
    """What stands in the way of a run: 'fatal: ...' or 'warn: ...' lines; empty if nothing does."""
    at = next(p for p in (Path(root), *Path(root).absolute().parents) if p.exists())
    free = shutil.disk_usage(at).free / 2**30
    return ["fatal: less than 1 GB of disk is free"] if free < 1 else ["warn: less than 5 GB of disk is free"] if free < 5 else []
