"""The pN_ queries over whole tables, and the SQL that can check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, mix, names, nearest, neardup, pieces, pii, residue, sentences
from quire.plans.spread import spread
from quire.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


ORACLES["p1_found"] = """
SELECT 'chunks' AS src, row_id AS item_id FROM chunks WHERE length(content) > 1000
UNION ALL SELECT 'doc_chunks', id FROM doc_chunks WHERE length(chunk_text) > 1000"""


# brute force over all pairs of each table
_COSINE = """SELECT * FROM (WITH v AS MATERIALIZED (SELECT id, CAST(CAST(embedding AS DOUBLE[]) AS DOUBLE[512]) AS e FROM {0} WHERE id IS NOT NULL AND len(embedding) = 512
AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.id AS a, b.id AS b, array_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.id < b.id WHERE array_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY round(s, 9) DESC, b) AS n FROM (SELECT a, b, s FROM p UNION ALL SELECT b, a, s FROM p))
SELECT DISTINCT '{0}' AS src, least(a, b) AS id_a, greatest(a, b) AS id_b FROM r WHERE n <= 5)"""
ORACLES["p2_found"] = " UNION ALL ".join(_COSINE.format(t) for t in ("doc_chunks", "lightrag_entities"))

# exact set similarity; two sets at 0.75 share one of the rarest quarter of either's members
ORACLES["p6_found"] = r"""WITH t AS (SELECT id, trim(regexp_replace(lower(chunk_text), '[\s\p{Z}\x0b\x1c-\x1f\x85]+', ' ', 'g')) AS t FROM doc_chunks WHERE length(chunk_text) >= 200),
c AS MATERIALIZED (SELECT t, min(id) AS rep FROM t GROUP BY t),
g AS MATERIALIZED (SELECT rep, unnest(list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5)))) AS g FROM c),
f AS (SELECT g, count(*) AS n FROM g GROUP BY 1), z AS MATERIALIZED (SELECT rep, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT g.rep, g.g, row_number() OVER (PARTITION BY g.rep ORDER BY f.n, g.g) AS k FROM g JOIN f USING (g)),
x AS MATERIALIZED (SELECT o.rep, o.g FROM o JOIN z USING (rep) WHERE o.k <= z.n - ceil(0.75 * z.n) + 1),
p AS MATERIALIZED (SELECT DISTINCT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep),
i AS (SELECT p.a, p.b, count(*) AS n FROM p JOIN g u ON u.rep = p.a JOIN g w ON w.rep = p.b AND w.g = u.g GROUP BY 1, 2),
s AS (SELECT a, b FROM i JOIN z y ON y.rep = a JOIN z q ON q.rep = b WHERE i.n >= 0.75 * (y.n + q.n - i.n) UNION ALL SELECT rep, rep FROM c),
m AS (SELECT t.id, c.rep FROM t JOIN c USING (t))
SELECT DISTINCT least(u.id, w.id) AS id_a, greatest(u.id, w.id) AS id_b FROM s JOIN m u ON u.rep = s.a JOIN m w ON w.rep = s.b WHERE u.id <> w.id"""


def chunk_texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "doc_chunks").select("id", F.col("chunk_text").alias("text")))


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select(*columns))


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    of = (("chunks", "row_id", "content"), ("doc_chunks", "id", "chunk_text"))
    parts = [
        pieces.split_oversized(spread(table(spark, folder, n).select(F.lit(n).alias("src"), F.col(i).alias("item_id"), F.col(t).alias("text"))), "item_id", "text", others=["src"])
        for n, i, t in of
    ]
    return parts[0].unionByName(parts[1])


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Items cut into more than one piece."""
    return _pieces(spark, folder).filter("piece_no = 1").select("src", "item_id")


@query
def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder)


VECTORS = ("doc_chunks", "lightrag_entities")


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    def of(name: str) -> DataFrame:
        best = nearest.most_similar(spread(table(spark, folder, name).select("id", "embedding")), k=5, cosine=0.90)
        pair = best.select(F.lit(name).alias("src"), F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b"))
        return pair.distinct()

    return of(VECTORS[0]).unionByName(of(VECTORS[1]))


@query
def p2_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five most similar rows of every row whose id is divisible by 20, against all rows."""

    def of(name: str) -> DataFrame:
        v = spread(table(spark, folder, name).select("id", "embedding"))
        asked = F.col("id") % 20 == 0
        best = nearest.most_similar(v, k=5, queries=asked, bucket_rows=8000, probes=12, least_tables=3, rerank=12)
        return best.select(F.lit(name).alias("src"), "id", "other", "similarity")

    return of(VECTORS[0]).unionByName(of(VECTORS[1]))


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentences(chunk_texts(spark, folder)).select("id", "start_pos", "end_pos")


@query
def p3_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentences(chunk_texts(spark, folder))


def _personal(spark: SparkSession, folder: str) -> DataFrame:
    of = (("doc_chunks", "chunk_text"), ("lightrag_entities", "description"))
    parts = [spread(table(spark, folder, n).select(F.lit(n).alias("src"), F.col("id").alias("row_id"), F.col(t).alias("text"))) for n, t in of]
    return parts[0].unionByName(parts[1])


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return pii.mentions(_personal(spark, folder))


@query
def p4_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redacted(_personal(spark, folder))


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.same_pairs(table(spark, folder, "lightrag_entities"))


@query
def p5_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Every spelling of a person or organisation with its cluster."""
    return names.linked(table(spark, folder, "lightrag_entities"))


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.similar_pairs(chunk_texts(spark, folder), 0.75, 200)


@query
def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with its class at the default similarity of 0.8; texts of any length."""
    return neardup.groups(chunk_texts(spark, folder), 0.8)


@query
def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_corpus(documents(spark, folder, "doc_id", "text"))


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chosen documents, targets and sizes of all documents."""
    targets = table(spark, folder, "mix_targets")
    sizes = mix.counted(documents(spark, folder, "doc_id", "text", "source"))
    return mix.chosen(sizes, targets), targets, sizes


@query
def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen documents with their repeat counts."""
    return _mixture(spark, folder)[0].select("doc_id", "source", "n_tokens", "repeats", "first_position")


@query
def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The actual shares, what each source has and leaves unused, and which one binds."""
    return mix.shares(*_mixture(spark, folder))


@query
def p8_order(spark: SparkSession, folder: str) -> DataFrame:
    """Every copy at its training position."""
    return mix.ordered(_mixture(spark, folder)[0])


@query
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(documents(spark, folder, "doc_id", "text", "source_url"))


@query
def p9_clean(spark: SparkSession, folder: str) -> DataFrame:
    return residue.without_residue(table(spark, folder, "documents"))
