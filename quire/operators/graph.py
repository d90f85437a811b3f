"""Entities and relations of documents: extraction plug-in, merging, export."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.plans.retry import retried


class Found(NamedTuple):
    """What an extractor finds in a text: entities (name, type, description), and relations (source, target, type,
    description, weight)."""

    entities: list[tuple[str, str, str]]
    relations: list[tuple[str, str, str, str, float | None]] = []  # noqa: RUF012


Extractor = Callable[[str], Found]


def capital_words(text: str) -> Found:
    """A stand-in without a model: capitalised words of five letters or more are entities of unknown type, and each is
    near the next."""
    names = list(dict.fromkeys(w for w in re.split(r"[^\w]+", text or "") if re.fullmatch("[A-Z][a-z]{4,}", w)))
    return Found([(w, "UNKNOWN", "") for w in names], [(a, b, "near", "", 1.0) for a, b in zip(names, names[1:])])


_EXTRACTED = "chunk_id string, kind string, name string, target string, type string, description string, weight double, error string"


def extracted(chunks: DataFrame, extractor: Extractor = capital_words, tries: int = 3) -> DataFrame:
    """Rows of kind entity, relation or error from chunks (chunk_id, content), one pass over the texts.  The extractor is
    asked again after errors of the connection; a chunk that fails gives one row with its error and ends no job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, t in zip(b["chunk_id"], b["content"]):
                try:
                    found = retried(lambda t=t: extractor(t), tries)
                    rows += [(c, "entity", n, None, k, d, None, None) for n, k, d in found.entities]
                    rows += [(c, "relation", x, y, k, d, w, None) for x, y, k, d, w in found.relations]
                except Exception as e:  # noqa: BLE001
                    rows.append((c, "error", None, None, None, None, None, repr(e)[:200]))
            yield pd.DataFrame(rows, columns=["chunk_id", "kind", "name", "target", "type", "description", "weight", "error"])

    return chunks.select("chunk_id", "content").mapInPandas(run, _EXTRACTED)


def entities_of(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'entity'").select("chunk_id", F.col("name").alias("entity_name"), F.col("type").alias("entity_type"), "description")


def relations_of(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'relation'").select("chunk_id", F.col("name").alias("source_entity"), F.col("target").alias("target_entity"), F.col("type").alias("relation_type"), "description", "weight")


def errors_of(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'error'").select("chunk_id", "error")


#: Descriptions and source chunks of an entity that are joined into its row.
JOINED = 100


def descriptions(entities: DataFrame) -> DataFrame:
    """(entity_name, description): every distinct description of a named entity, one row each."""
    return entities.filter("entity_name is not null").filter(~T.blank("description")).select("entity_name", "description").distinct()


def _first_joined(values: DataFrame, key: list[str], value: str, most: int = JOINED) -> DataFrame:
    """Of each key the first values in order, joined; tasks drop what is beyond before anything moves."""
    w = Window.partitionBy(*key).orderBy(value)
    first = values.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most)
    return first.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list(value)), "<SEP>").alias(value))


def merged_entities(entities: DataFrame) -> DataFrame:
    """One row per name: its most frequent type (the first by name among equals), its distinct descriptions in order, and
    the number of rows.  Types are counted before names are grouped.  The row holds the first JOINED descriptions, so a
    hub stays one row of bounded size; `descriptions` has all of them."""
    types = entities.filter("entity_name is not null").groupBy("entity_name", F.coalesce("entity_type", F.lit("UNKNOWN")).alias("t")).count()
    top = types.groupBy("entity_name").agg(F.min_by("t", F.struct(-F.col("count"), F.col("t"))).alias("entity_type"), F.sum("count").alias("mentions"))
    said = _first_joined(descriptions(entities), ["entity_name"], "description")
    return top.join(said, "entity_name", "left").withColumn("description", F.coalesce("description", F.lit("")))


def source_ids(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, source_chunk_id): the first JOINED chunks by id that each key comes from, joined as readers expect."""
    each = rows.select(*keys, F.col("chunk_id").alias("source_chunk_id")).filter("source_chunk_id is not null").distinct()
    return _first_joined(each, keys, "source_chunk_id")


def merged_relations(relations: DataFrame) -> DataFrame:
    """One row per undirected pair of different entities: rows and summed weight, missing weights counting 1."""
    a, b = F.least("source_entity", "target_entity"), F.greatest("source_entity", "target_entity")
    r = relations.filter("source_entity is not null and target_entity is not null and source_entity <> target_entity")
    return r.groupBy(a.alias("source_entity"), b.alias("target_entity")).agg(F.sum(T.weight_or_one("weight")).alias("weight"), F.count("*").alias("relations"))


def name_vectors(rows: DataFrame, order: str) -> DataFrame:
    """(entity_name, embedding): the last vector of each name in order."""
    return rows.groupBy("entity_name").agg(F.max_by("embedding", order).alias("embedding"))


def with_vectors(entities: DataFrame, vectors: DataFrame) -> DataFrame:
    """Entities with the vector of their name, null where there is none."""
    return entities.join(vectors, "entity_name", "left")


def export_entities(nodes: DataFrame, *more: str) -> DataFrame:
    """Entity rows for the store: the source document is the first part of the joined source ids."""
    return nodes.select("entity_name", "entity_type", "description", T.first_part("source_chunk_id").alias("source_doc"), "source_chunk_id", *more, "batch_timestamp")


def export_relations(edges: DataFrame) -> DataFrame:
    return edges.select("source_entity", "target_entity", "relation_type", "description", T.weight_or_one("weight").alias("weight"), "source_doc", "batch_timestamp")


def export_chunks(chunks: DataFrame) -> DataFrame:
    """Chunk rows of the graph (chunk_id, doc_name, content, chunk_order, batch_timestamp); as readers expect,
    token_count is the number of code points."""
    return chunks.select("chunk_id", "doc_name", "content", F.length("content").alias("token_count"), "chunk_order", F.col("doc_name").alias("full_doc_id"), "batch_timestamp")
