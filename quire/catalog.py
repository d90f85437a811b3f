"""Queries over the project's tables by name, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.core import tidying
from quire.functions import text as T
from quire.functions import vectors as V
from quire.operators import changes, chunks, documents, graph, naming, search, tree
from quire.plans.order import numbered
from quire.sources import sheets, wiki
from quire.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "t4_chunk_stats"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- sources


@query("""SELECT obj_token AS token, obj_type AS doc_type, 'docx' AS ext, title AS name, 'wiki_node:' || node_token AS url, space_id, coalesce(obj_edit_time, '') AS obj_edit_time
FROM wiki_nodes WHERE obj_type IN ('doc', 'docx') AND regexp_matches(coalesce(title, ''), '[^\\s\\p{Z}]')""")
def s1_discover(spark, d):
    return wiki.discovered(table(spark, d, "wiki_nodes"))


@query("""SELECT CASE WHEN obj_type IN ('doc', 'docx') THEN 'untitled' ELSE obj_type END AS reason, count(*) AS skipped FROM wiki_nodes
WHERE coalesce(obj_type, '') NOT IN ('doc', 'docx') OR NOT regexp_matches(coalesce(title, ''), '[^\\s\\p{Z}]') GROUP BY 1""")
def a1_skips_by_type(spark, d):
    return wiki.skipped(table(spark, d, "wiki_nodes"))


@query("SELECT space_id, name, coalesce(description, '') AS description FROM wiki_spaces")
def s2_spaces(spark, d):
    return table(spark, d, "wiki_spaces").select("space_id", "name", F.coalesce("description", F.lit("")).alias("description"))


@query("""WITH RECURSIVE n AS (SELECT node_token AS node, min(parent_node_token) AS parent FROM wiki_nodes WHERE node_token IS NOT NULL GROUP BY 1),
w AS (SELECT node, 0 AS level, node AS root FROM n WHERE parent IS NULL OR parent = ''
UNION ALL SELECT n.node, w.level + 1, w.root FROM n JOIN w ON n.parent = w.node WHERE w.level < 10) SELECT node, level, root FROM w""")
def s3_tree(spark, d):
    return tree.walked(table(spark, d, "wiki_nodes"), "node_token", "parent_node_token")


@query("""SELECT r.id, n.obj_token, n.obj_type, n.title FROM (SELECT id, source_url, regexp_extract(source_url, '/([A-Za-z0-9_-]+)$', 1) AS node_token FROM doc_chunks) r
LEFT JOIN (SELECT DISTINCT node_token, obj_token, obj_type, title FROM wiki_nodes) n USING (node_token)""")
def s4_resolve(spark, d):
    asked = table(spark, d, "doc_chunks").select("id", F.regexp_extract("source_url", "/([A-Za-z0-9_-]+)$", 1).alias("node_token"))
    return wiki.resolved(asked, table(spark, d, "wiki_nodes")).select("id", "obj_token", "obj_type", "title")


_URL = "'https://files.example/' || CASE obj_type WHEN 'doc' THEN 'docs' WHEN 'sheet' THEN 'sheets' WHEN 'bitable' THEN 'base' ELSE obj_type END || '/' || obj_token"
_PARSED = """CASE WHEN u LIKE '%/wiki/%' THEN 'wiki' WHEN u LIKE '%/docx/%' THEN 'docx' WHEN u LIKE '%/docs/%' THEN 'doc' WHEN u LIKE '%/sheets/%' THEN 'sheet' WHEN u LIKE '%/base/%' THEN 'bitable' END"""


def _urls(spark, d):
    return table(spark, d, "wiki_nodes").select("obj_token", F.expr(_URL).alias("url"))


@query(f"""SELECT regexp_extract(u, '/([A-Za-z0-9_-]+)$', 1) AS token, k AS doc_type, CASE WHEN k IN ('sheet', 'bitable') THEN 'xlsx' ELSE 'docx' END AS ext, u AS url
FROM (SELECT u, {_PARSED} AS k FROM (SELECT {_URL} AS u FROM wiki_nodes)) WHERE k IS NOT NULL""")
def s6_entries(spark, d):
    return wiki.entries(_urls(spark, d), "url")


_LISTED = "concat_ws(' , ', concat('https://files.example/docx/', obj_token), '', concat('https://files.example/wiki/', node_token))"


@query(f"SELECT trim(x) AS url FROM (SELECT unnest(string_split({_LISTED}, ',')) AS x FROM wiki_nodes) WHERE trim(x) <> ''")
def s7_url_lists(spark, d):
    return wiki.url_list(table(spark, d, "wiki_nodes").select(F.expr(_LISTED).alias("urls")), "urls")


_LAST_TEXT = "SELECT doc_name, chunk_index, arg_max(id, (doc_timestamp, id)) AS id, arg_max(chunk_text, (doc_timestamp, id)) AS chunk_text FROM doc_chunks GROUP BY 1, 2"


@query(f"SELECT c.row_id, c.chunk_id, d.id, d.chunk_text FROM chunks c JOIN ({_LAST_TEXT}) d ON c.doc_name = d.doc_name AND c.chunk_index = d.chunk_index")
def s15_load_chunks(spark, d):
    """An index joined with the texts of its places, the last written of each place."""
    index = table(spark, d, "chunks").select("row_id", "doc_name", "chunk_index", "chunk_id")
    texts = changes.latest(table(spark, d, "doc_chunks").select("id", "doc_name", "chunk_index", "doc_timestamp", "chunk_text"), ["doc_name", "chunk_index"], [F.col("doc_timestamp"), F.col("id")])
    return index.join(texts.select("id", "doc_name", "chunk_index", "chunk_text"), ["doc_name", "chunk_index"]).select("row_id", "chunk_id", "id", "chunk_text")


@query("SELECT id, doc_name, chunk_index FROM doc_chunks WHERE regexp_matches(chunk_text, '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]')")
def s16_chunks_with_text(spark, d):
    return table(spark, d, "doc_chunks").filter(~T.blank("chunk_text")).select("id", "doc_name", "chunk_index")


def _image_rows(spark, d):
    refs = table(spark, d, "doc_chunks").select("doc_name", "id", F.posexplode(T.image_references("chunk_text")).alias("pos", "filename"))
    return refs.select("doc_name", "id", "pos", "filename", F.concat(F.lit("img_"), F.format_string("%03d", "pos"), F.lit("_"), "filename").alias("original_filename"))


_REFS = r"""SELECT doc_name, id, chunk_index, generate_subscripts(r, 1) - 1 AS pos, unnest(r) AS filename FROM (SELECT doc_name, id, chunk_index, regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{Z}]+)', 1) AS r FROM doc_chunks)"""


@query(f"SELECT doc_name, filename, max(id * 1000 + pos) // 1000 AS id FROM ({_REFS}) GROUP BY 1, 2")
def s17_images_last_wins(spark, d):
    rows = _image_rows(spark, d).withColumn("order", F.struct("id", "pos"))
    return chunks.last_named(rows, "doc_name", "filename", "order").select("doc_name", "filename", "id")


_STORED = "embedding IS NOT NULL AND processed_at <> '' AND regexp_matches(chunk_text, '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]')"


@query(f"SELECT id, doc_name, chunk_index, len(embedding) AS dims FROM doc_chunks WHERE {_STORED}")
def s18_store_rows(spark, d):
    c = table(spark, d, "doc_chunks")
    text = c.select("id", "doc_name", "chunk_index", "chunk_text").filter(~T.blank("chunk_text"))
    vectors = c.filter("embedding is not null").select("id", F.size("embedding").alias("dims"))
    meta = c.filter("processed_at <> ''").select("id")
    return text.join(vectors, "id").join(meta, "id").select("id", "doc_name", "chunk_index", "dims")


@query("SELECT DISTINCT doc_name FROM chunks WHERE doc_name NOT IN (SELECT doc_name FROM doc_chunks WHERE embedding IS NOT NULL AND doc_name IS NOT NULL)")
def s19_unstored_documents(spark, d):
    stored = table(spark, d, "doc_chunks").filter("embedding is not null")
    return changes.without(table(spark, d, "chunks").select("doc_name").distinct(), stored, ["doc_name"])


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.page') AS BIGINT) AS page FROM events WHERE json_valid(props)""")
def s20_json_lines(spark, d):
    e = table(spark, d, "events").select("event_id", F.from_json("props", "page bigint, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("j"))
    return e.filter("j._bad is null").select("event_id", "j.page")


@query("""SELECT c.row_id, c.doc_name, c.chunk_index, v.n AS vectors, m.processed_at FROM chunks c
LEFT JOIN (SELECT chunk_id, count(*) AS n FROM doc_chunks WHERE embedding IS NOT NULL GROUP BY 1) v ON c.chunk_id = v.chunk_id
LEFT JOIN (SELECT chunk_id, max(processed_at) AS processed_at FROM doc_chunks GROUP BY 1) m ON c.chunk_id = m.chunk_id
WHERE regexp_matches(coalesce(c.content, ''), '[^\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]')""")
def s21_consumer_scan(spark, d):
    stored = table(spark, d, "doc_chunks")
    v = stored.filter("embedding is not null").groupBy("chunk_id").agg(F.count("*").alias("vectors"))
    m = stored.groupBy("chunk_id").agg(F.max("processed_at").alias("processed_at"))
    c = table(spark, d, "chunks").filter(~T.blank("content")).select("row_id", "doc_name", "chunk_index", "chunk_id")
    return c.join(v, "chunk_id", "left").join(m, "chunk_id", "left").drop("chunk_id")


# ---- projections and assembly


@query("SELECT node_token, obj_type, 'docx' AS ext FROM wiki_nodes WHERE obj_type IN ('doc', 'docx')")
def proj1_exportable(spark, d):
    return wiki.exportable(table(spark, d, "wiki_nodes")).select("node_token", "obj_type", "ext")


@query("SELECT doc_name, lower(regexp_extract(f, '\\.[^.]+$')) AS suffix FROM (SELECT doc_name, doc_name || '.' || CASE doc_format WHEN 'Word' THEN 'docx' WHEN 'PDF' THEN 'PDF' ELSE 'txt' END AS f FROM doc_chunks) WHERE lower(regexp_extract(f, '\\.[^.]+$')) IN ('.docx', '.pdf')")
def proj3_valid_files(spark, d):
    kind = F.when(F.col("doc_format") == "Word", "docx").when(F.col("doc_format") == "PDF", "PDF").otherwise("txt")
    f = table(spark, d, "doc_chunks").select("doc_name", F.concat("doc_name", F.lit("."), kind).alias("f"))
    return f.select("doc_name", F.lower(F.regexp_extract("f", r"\.[^.]+$", 0)).alias("suffix")).filter(F.col("suffix").isin(".docx", ".pdf"))


@query("""SELECT coalesce(lower(trim(doc_format)), '') AS kind, CASE WHEN lower(trim(doc_format)) IN ('word', 'docx') THEN 'word' WHEN lower(trim(doc_format)) = 'pdf' THEN 'pdf' WHEN lower(trim(doc_format)) = 'doc' THEN 'skip: convert first' ELSE 'skip: unsupported' END AS reader, count(*) AS n FROM doc_chunks GROUP BY 1, 2""")
def proj4_dispatch(spark, d):
    kind = F.coalesce(F.lower(F.trim("doc_format")), F.lit(""))
    return table(spark, d, "doc_chunks").groupBy(kind.alias("kind"), T.reader_of(kind).alias("reader")).agg(F.count("*").alias("n"))


def _with_images(spark, d):
    c = table(spark, d, "doc_chunks").select("id", "doc_name", "doc_timestamp", "processed_at", F.col("id").alias("chunk_index"), "chunk_id", F.length("chunk_text").alias("char_count"), F.col("chunk_text").alias("content"))
    # every second image is in the index, so references without a row come out as well
    rows = _image_rows(spark, d).filter(F.pmod(F.length("filename"), F.lit(2)) == 0).withColumn("order", F.struct("id", "pos"))
    index = chunks.last_named(rows, "doc_name", "filename", "order").select("doc_name", "filename", "original_filename", F.concat(F.lit("b"), F.col("id").cast("string")).alias("context_before"), F.lit(None).cast("string").alias("context_after"))
    return chunks.with_images(c, index)


_IMAGES = f"""WITH r AS ({_REFS}), x AS (SELECT doc_name, filename, max(id * 1000 + pos) AS m FROM r WHERE length(filename) % 2 = 0 GROUP BY 1, 2)
SELECT r.id, r.pos, r.filename, CASE WHEN m IS NOT NULL THEN 'img_' || lpad(CAST(m % 1000 AS VARCHAR), 3, '0') || '_' || r.filename END AS original_filename, './images/' || r.filename AS path, CASE WHEN m IS NOT NULL THEN 'b' || (m // 1000) END AS context_before
FROM r LEFT JOIN x ON r.doc_name IS NOT DISTINCT FROM x.doc_name AND r.filename = x.filename"""


@query(_IMAGES)
def j1_image_join(spark, d):
    each = _with_images(spark, d).select("id", F.posexplode("images").alias("pos", "i"))
    return each.select("id", F.col("pos").cast("long").alias("pos"), "i.filename", "i.original_filename", "i.path", "i.context_before")


@query(r"""SELECT doc_name || '_' || doc_timestamp || '_' || chunk_id AS id, id AS chunk_index, length(chunk_text) AS char_count, len(regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{Z}]+)', 1)) AS image_count FROM doc_chunks""")
def proj6_metadata(spark, d):
    m = chunks.metadata(_with_images(spark, d))
    return m.select("id", "metadata.chunk_index", "metadata.char_count", F.col("metadata.image_count").cast("long").alias("image_count"))


_BLOCKS = "SELECT *, (row_number() OVER (PARTITION BY doc_name ORDER BY chunk_index, id) - 1) // 1000 AS block FROM doc_chunks"


@query(f"SELECT doc_name, CAST(block AS BIGINT) AS volume, coalesce(string_agg(chunk_text, chr(10) || chr(10) ORDER BY chunk_index, id), '') AS full_text FROM ({_BLOCKS}) GROUP BY 1, 2")
def proj11_document_dump(spark, d):
    c = table(spark, d, "doc_chunks").select("doc_name", "chunk_index", "id", "chunk_text")
    return documents.volumes(c, "doc_name", ["chunk_index", "id"], "chunk_text")


_ELEMENTS = "SELECT doc_id, generate_subscripts(p, 1) - 1 AS elem_idx, unnest(p) AS content FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS p FROM documents WHERE text IS NOT NULL)"


@query(f"SELECT doc_id, string_agg(content, chr(10) || chr(10) ORDER BY elem_idx) AS full_text FROM ({_ELEMENTS}) GROUP BY 1")
def proj7_full_text(spark, d):
    return documents.joined_in_order(documents.elements(table(spark, d, "documents")), "doc_id", "elem_idx", "content")


@query(f"SELECT doc_id, elem_idx, CAST(coalesce(sum(length(content) + 2) OVER (PARTITION BY doc_id ORDER BY elem_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position FROM ({_ELEMENTS})")
def proj10_positions(spark, d):
    e = documents.elements(table(spark, d, "documents"))
    return documents.positions(e, "doc_id", "elem_idx", "content").select("doc_id", F.col("elem_idx").cast("long").alias("elem_idx"), "position")


@query("""SELECT doc_id, CASE WHEN n % 2 = 0 THEN t ELSE array_to_string(p[:len(p) // 2] || ['[图片: images/a.png]', '[图片: images/b.png]'] || p[len(p) // 2 + 1:], chr(10) || chr(10)) END AS page
FROM (SELECT doc_id, text AS t, doc_id AS n, string_split(text, chr(10) || chr(10)) AS p FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)""")
def proj8_page_text(spark, d):
    images = F.when(F.col("doc_id") % 2 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.lit("a.png"), F.lit("b.png")))
    p = table(spark, d, "documents").filter("text is not null and doc_id is not null")
    return p.select("doc_id", documents.page_text(F.col("text"), images).alias("page"))


@query("""SELECT doc_id, replace(replace(coalesce(text, '') || '[图片: images/a.png] [图片: images/b.png]', '[图片: images/a.png]', '图片：./images/x_' || doc_id || '.png'), '[图片: images/b.png]', '图片：./images/y.png') AS text FROM documents""")
def proj9_placeholders(spark, d):
    t = F.concat(F.coalesce("text", F.lit("")), F.lit("[图片: images/a.png] [图片: images/b.png]"))
    new = F.array(F.concat(F.lit("x_"), F.col("doc_id").cast("string"), F.lit(".png")), F.lit("y.png"))
    return table(spark, d, "documents").select("doc_id", documents.renamed_placeholders(t, F.array(F.lit("a.png"), F.lit("b.png")), new).alias("text"))


@query("SELECT id, CASE WHEN coalesce(description, '') = '' THEN entity_name ELSE entity_name || ': ' || description END AS text FROM lightrag_entities")
def proj13_entity_text(spark, d):
    return table(spark, d, "lightrag_entities").select("id", T.entity_text(F.col("entity_name"), F.col("description")).alias("text"))


# ---- joins and change detection


@query("SELECT DISTINCT doc_name FROM documents WHERE doc_name IS NOT NULL AND doc_name NOT IN (SELECT doc_name FROM doc_chunks WHERE doc_name IS NOT NULL)")
def j2_pending_documents(spark, d):
    return changes.without(table(spark, d, "documents").select("doc_name").filter("doc_name is not null").distinct(), table(spark, d, "doc_chunks"), ["doc_name"])


@query("""SELECT e.id, len(v.vector) AS dims, round(CAST(v.vector[1] AS DOUBLE), 6) AS first_value FROM lightrag_entities e
LEFT JOIN (SELECT entity_name, arg_max(embedding, id) AS vector FROM lightrag_entities WHERE embedding IS NOT NULL GROUP BY 1) v USING (entity_name)""")
def j7_entity_embeddings(spark, d):
    """Every entity row with the last vector of its name."""
    e = table(spark, d, "lightrag_entities").select("id", "entity_name", "embedding")
    v = graph.name_vectors(e.filter("embedding is not null"), "id")
    return graph.with_vectors(e.select("id", "entity_name"), v).select("id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dims"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"))


@query("""SELECT doc_id FROM documents d WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE length(text) % 7 <> 0 AND doc_id IS NOT NULL) ORDER BY doc_id LIMIT 1""")
def j8_first_unfinished(spark, d):
    s = table(spark, d, "documents").filter("doc_id is not null")
    return changes.first_open(s.select("doc_id"), s.filter("length(text) % 7 <> 0"), "doc_id", "doc_id")


@query(f"""WITH i AS (SELECT doc_id, elem_idx, row_number() OVER (PARTITION BY doc_id ORDER BY elem_idx) AS place FROM ({_ELEMENTS}) WHERE contains(content, '图片：./images/')),
m AS (SELECT doc_id, k AS media FROM documents, range(1, 3) t(k) WHERE text IS NOT NULL), n AS (SELECT doc_id, media, row_number() OVER (PARTITION BY doc_id ORDER BY media) AS place FROM m)
SELECT i.doc_id, i.elem_idx, n.media FROM i JOIN n USING (doc_id, place)""")
def j9_positional(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    images = documents.elements(docs).filter("has_image").select("doc_id", F.col("elem_idx").cast("long").alias("elem_idx"))
    media = docs.select("doc_id", F.explode(F.expr("sequence(1L, 2L)")).alias("media"))
    return documents.paired_by_place(images, media, "doc_id", "elem_idx", "media").select("doc_id", "elem_idx", "media")


_NEAR = """SELECT entity, neighbour, relation_type, weight FROM (SELECT source_entity AS entity, target_entity AS neighbour, relation_type, weight FROM lightrag_relations UNION ALL
SELECT target_entity, source_entity, relation_type, weight FROM lightrag_relations WHERE source_entity <> target_entity) WHERE entity IN (SELECT entity_name FROM lightrag_entities WHERE lower(entity_type) = 'person')"""


@query(_NEAR)
def j10_neighbours(spark, d):
    people = table(spark, d, "lightrag_entities").filter("lower(entity_type) = 'person'").select(F.col("entity_name").alias("entity"))
    return search.neighbours(table(spark, d, "lightrag_relations"), people)


_MANIFEST = "SELECT obj_token AS token, max(CASE WHEN length(coalesce(title, '')) % 3 = 0 THEN '1' ELSE obj_edit_time END) AS t, max(title) AS file_path, max(length(obj_token || coalesce(title, ''))) % 5 <> 0 AS path_exists FROM wiki_nodes WHERE depth < 3 GROUP BY 1"


def _manifest(spark, d):
    return table(spark, d, "wiki_nodes").filter("depth < 3").groupBy(F.col("obj_token").alias("token")).agg(
        F.max(F.when(F.length(F.coalesce("title", F.lit(""))) % 3 == 0, "1").otherwise(F.col("obj_edit_time"))).alias("obj_edit_time"),
        F.max("title").alias("file_path"),
        (F.max(F.length(F.concat("obj_token", F.coalesce("title", F.lit(""))))) % 5 != 0).alias("path_exists"),
    )


@query(f"""SELECT n.node_token, n.obj_token AS token, CASE WHEN m.token IS NULL THEN 'new' WHEN coalesce(m.file_path, '') <> '' AND NOT m.path_exists THEN 'missing'
WHEN coalesce(m.t, '') <> '' AND coalesce(n.obj_edit_time, '') <> '' AND m.t <> n.obj_edit_time THEN 'changed' ELSE 'same' END AS state FROM wiki_nodes n LEFT JOIN ({_MANIFEST}) m ON n.obj_token = m.token""")
def c1_changed(spark, d):
    e = table(spark, d, "wiki_nodes").select("node_token", F.col("obj_token").alias("token"), "obj_edit_time")
    return changes.changed(e, _manifest(spark, d)).select("node_token", "token", "state")


_HASHES = f"""SELECT doc_name, CASE WHEN max(block) = 0 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY block)) END AS hash FROM
(SELECT doc_name, block, sha256(coalesce(string_agg(chunk_text, '' ORDER BY chunk_index, id), '')) AS h FROM ({_BLOCKS}) GROUP BY 1, 2) GROUP BY 1"""


def _hashes(spark, d):
    return changes.document_hashes(table(spark, d, "doc_chunks"), "doc_name", ["chunk_index", "id"], "chunk_text")


def _old(spark, d):
    h = _hashes(spark, d).filter("doc_name is not null")
    return h.filter("length(doc_name) % 3 <> 0").withColumn("hash", F.when(F.length("doc_name") % 5 == 0, "old").otherwise(F.col("hash")))


_OLD = f"SELECT doc_name, CASE WHEN length(doc_name) % 5 = 0 THEN 'old' ELSE hash END AS hash FROM ({_HASHES}) WHERE length(doc_name) % 3 <> 0"


@query(_HASHES)
def a8_document_hash(spark, d):
    return _hashes(spark, d)


@query(f"SELECT h.doc_name, h.hash, coalesce(o.hash = h.hash, false) AS skipped FROM ({_HASHES}) h LEFT JOIN ({_OLD}) o USING (doc_name)")
def c2_hash_skip(spark, d):
    return changes.to_build(_hashes(spark, d), _old(spark, d), "doc_name")


@query(f"""WITH h AS ({_HASHES}), o AS ({_OLD}), f AS (SELECT * FROM h WHERE length(doc_name) % 2 = 0) SELECT doc_name, hash FROM f UNION ALL SELECT doc_name, hash FROM o WHERE doc_name NOT IN (SELECT doc_name FROM f)""")
def c3_manifest_advance(spark, d):
    h = _hashes(spark, d).filter("doc_name is not null")
    return changes.advanced(_old(spark, d), h, h.filter("length(doc_name) % 2 = 0"), "doc_name")


@query("""WITH a AS (SELECT doc_name, 0 AS r, min(source_url) AS path FROM documents WHERE doc_name IS NOT NULL GROUP BY 1 UNION ALL SELECT doc_name, 1, min(source_file) FROM doc_chunks WHERE doc_name IS NOT NULL GROUP BY 1 UNION ALL SELECT doc_name, 2, doc_name FROM chunks WHERE doc_name IS NOT NULL GROUP BY 1)
SELECT doc_name, arg_min(coalesce(path, ''), r) AS path, CASE min(r) WHEN 0 THEN 'download' WHEN 1 THEN 'manifest' ELSE 'directory' END AS origin FROM a GROUP BY 1""")
def c6_work_list(spark, d):
    of = lambda n, p: table(spark, d, n).filter("doc_name is not null").groupBy("doc_name").agg(F.coalesce(F.min(p), F.lit("")).alias("path"))
    return changes.work_list(of("documents", "source_url"), of("doc_chunks", "source_file"), of("chunks", "doc_name"), "doc_name")


# ---- aggregates


@query("SELECT DISTINCT doc_name FROM doc_chunks")
def a2_distinct_documents(spark, d):
    return table(spark, d, "doc_chunks").select("doc_name").distinct()


@query(r"SELECT doc_name, count(*) AS chunks, count_if(n > 0) AS with_images, CAST(sum(n) AS BIGINT) AS images FROM (SELECT doc_name, coalesce(len(regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{Z}]+)', 1)), 0) AS n FROM doc_chunks) GROUP BY 1")
def a3_document_images(spark, d):
    n = F.coalesce(F.size(T.image_references("chunk_text")), F.lit(0))
    c = table(spark, d, "doc_chunks").select("doc_name", F.when(n < 0, 0).otherwise(n).alias("n"))
    return c.groupBy("doc_name").agg(F.count("*").alias("chunks"), F.count_if(F.col("n") > 0).alias("with_images"), F.sum("n").alias("images"))


@query("SELECT count(*) AS chunks, count_if(has_images) AS with_images, count(DISTINCT doc_name) AS documents FROM doc_chunks")
def a5_totals(spark, d):
    return table(spark, d, "doc_chunks").agg(F.count("*").alias("chunks"), F.count_if("has_images").alias("with_images"), F.count_distinct("doc_name").alias("documents"))


_SPANS = r"list_transform(string_split(coalesce(chunk_text, ''), chr(10)), lambda x: list_transform(string_split(x, ' '), lambda w: {'text': w, 'font_size': CASE WHEN length(w) % 5 = 0 THEN 0.0 ELSE 8.0 + length(w) END}))"


def _span_pages(spark, d):
    word = lambda w: F.struct(w.alias("text"), F.when(F.length(w) % 5 == 0, 0.0).otherwise(8.0 + F.length(w)).alias("font_size"))
    lines = F.transform(F.split(F.coalesce("chunk_text", F.lit("")), "\n"), lambda x: F.transform(F.split(x, " "), word))
    return table(spark, d, "doc_chunks").select("id", "doc_name", documents.line_blocks(lines).alias("text_blocks"))


@query(f"""SELECT doc_name, round(coalesce(avg(CASE WHEN z > 0 THEN z END), 12), 6) AS mean_size FROM
(SELECT doc_name, unnest(list_transform({_SPANS}, lambda l: list_max(list_transform(l, lambda s: CAST(s.font_size AS DOUBLE))))) AS z FROM doc_chunks) GROUP BY 1""")
def a6_mean_size(spark, d):
    """Mean font size of a document's lines, those of size 0 left out."""
    lines = _span_pages(spark, d).select("doc_name", F.explode("text_blocks.font_size").alias("z"))
    return lines.groupBy("doc_name").agg(F.round(F.coalesce(F.avg(F.when(F.col("z") > 0, F.col("z"))), F.lit(12.0)), 6).alias("mean_size"))


@query(f"""SELECT id, generate_subscripts(b, 1) - 1 AS line_no, unnest(list_transform(b, lambda l: list_max(list_transform(l, lambda s: CAST(s.font_size AS DOUBLE))))) AS font_size,
unnest(list_transform(b, lambda l: array_to_string(list_transform(l, lambda s: s.text), ''))) AS text FROM (SELECT id, {_SPANS} AS b FROM doc_chunks)""")
def a7_line_sizes(spark, d):
    """Lines of spans with their text and largest span size."""
    each = _span_pages(spark, d).select("id", F.posexplode("text_blocks").alias("line_no", "b"))
    return each.select("id", F.col("line_no").cast("long").alias("line_no"), "b.font_size", "b.text")


@query("""SELECT count(*) AS total, count_if(text IS NOT NULL AND text <> '') AS success, count_if(text = '') AS skipped, count_if(text IS NULL) AS failed FROM documents""")
def a9_batch_report(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("total"), F.count_if(F.col("text") != "").alias("success"), F.count_if(F.col("text") == "").alias("skipped"), F.count_if(F.col("text").isNull()).alias("failed"))


@query(f"SELECT count_if(NOT skipped) AS built, count_if(skipped) AS skipped, count(*) AS total FROM (SELECT h.doc_name, coalesce(o.hash = h.hash, false) AS skipped FROM ({_HASHES}) h LEFT JOIN ({_OLD}) o USING (doc_name))")
def a10_graph_report(spark, d):
    s = changes.to_build(_hashes(spark, d), _old(spark, d), "doc_name")
    return s.agg(F.count_if(~F.col("skipped")).alias("built"), F.count_if("skipped").alias("skipped"), F.count("*").alias("total"))


@query("""WITH f AS (SELECT doc_name, CAST(sum(length(chunk_text)) AS BIGINT) AS size FROM doc_chunks WHERE doc_name IS NOT NULL GROUP BY 1)
SELECT CAST(sum(size) AS BIGINT) AS total, CAST(sum(size) // count(*) AS BIGINT) AS mean, (SELECT doc_name FROM f ORDER BY size DESC, doc_name LIMIT 1) AS largest, (SELECT doc_name FROM f ORDER BY size, doc_name LIMIT 1) AS smallest, CAST(128000 // (sum(size) // count(*)) AS BIGINT) AS fit FROM f""")
def a11_size_stats(spark, d):
    f = table(spark, d, "doc_chunks").filter("doc_name is not null").groupBy("doc_name").agg(F.sum(F.length("chunk_text")).alias("size"))
    mean = F.expr("sum(size) div count(*)")
    return f.agg(
        F.sum("size").alias("total"), mean.alias("mean"),
        F.min_by("doc_name", F.struct(-F.col("size"), F.col("doc_name"))).alias("largest"),
        F.min_by("doc_name", F.struct("size", "doc_name")).alias("smallest"),
        F.expr("128000 div (sum(size) div count(*))").alias("fit"),
    )


@query("""SELECT space_id AS path, count(node_token) AS found, count_if(coalesce(title, '') <> '') AS extracted, bool_or(coalesce(title, '') <> '') AS success FROM wiki_nodes WHERE obj_type = 'sheet' GROUP BY 1""")
def a12_sheet_counts(spark, d):
    """Wiki sheets as if each space were a workbook and a titled node a sheet with fields."""
    s = table(spark, d, "wiki_nodes").filter("obj_type = 'sheet'")
    names = F.when(F.coalesce("title", F.lit("")) != "", F.array("title"))
    return sheets.per_file(s.select(F.col("space_id").alias("path"), F.col("node_token").alias("sheet"), names.alias("names"), F.lit(None).cast("string").alias("error"))).drop("error")


@query(f"SELECT state, count(*) AS n FROM ({ORACLES['c1_changed']}) GROUP BY 1")
def a13_export_summary(spark, d):
    return c1_changed(spark, d).groupBy("state").agg(F.count("*").alias("n"))


# ---- windows


# an image element's own text: what is left without references and the white space around
_OWN = r"regexp_replace(regexp_replace(content, '图片：\./images/[^\s\p{Z}\x0b\x1c-\x1f\x85]+', '', 'g'), '^[\s\p{Z}\x0b\x1c-\x1f\x85]+|[\s\p{Z}\x0b\x1c-\x1f\x85]+$', '', 'g')"
_LOOK = f"""WITH e AS ({_ELEMENTS}) SELECT doc_id, elem_idx, list(CASE WHEN content <> '' THEN content END) OVER b AS bs,
CASE WHEN {_OWN} <> '' THEN [{_OWN}] ELSE [] END || coalesce(list_filter(list(CASE WHEN content <> '' THEN content END) OVER a, lambda x: x IS NOT NULL), []) AS xs, contains(content, '图片：./images/') AS i FROM e
WINDOW b AS (PARTITION BY doc_id ORDER BY elem_idx ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY doc_id ORDER BY elem_idx ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"""
_CONTEXTS = f"SELECT doc_id, elem_idx, coalesce(right(array_to_string(bs, ' '), 600), '') AS context_before, coalesce(left(array_to_string(xs, ' '), 600), '') AS context_after FROM ({_LOOK}) WHERE i"


def _around(spark, d):
    return documents.surroundings(documents.elements(table(spark, d, "documents")), "doc_id").withColumn("elem_idx", F.col("elem_idx").cast("long"))


@query(_CONTEXTS)
def w3_image_contexts(spark, d):
    return _around(spark, d).select("doc_id", "elem_idx", "context_before", "context_after")


_COUNTED = f"""e AS ({_ELEMENTS}), n AS (SELECT doc_id, elem_idx, content, regexp_matches(content, '^#+ ') OR (regexp_full_match(content, '[^。！？.!?\\n]{{1,30}}') AND NOT contains(content, '图片：')) AS h,
sum(CASE WHEN content <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY elem_idx) AS k FROM e)"""
_HEAD = "h AS is_heading, CASE WHEN h THEN greatest(length(regexp_extract(text, '^(#+)', 1)), 1) ELSE 0 END AS heading_level"
_BEFORE = """SELECT i.doc_id, i.elem_idx, CAST(i.k - p.k - CASE WHEN i.content <> '' THEN 1 ELSE 0 END AS BIGINT) AS distance, p.content AS text, p.h FROM n i JOIN n p ON i.doc_id = p.doc_id AND p.elem_idx BETWEEN i.elem_idx - 8 AND i.elem_idx - 1 WHERE contains(i.content, '图片：./images/') AND p.content <> ''"""
_AFTER = f"""SELECT doc_id, elem_idx, 0 AS distance, {_OWN} AS text, h FROM n WHERE contains(content, '图片：./images/') AND {_OWN} <> ''
UNION ALL SELECT i.doc_id, i.elem_idx, CAST(p.k - i.k - 1 + CASE WHEN {_OWN.replace("content", "i.content")} <> '' THEN 1 ELSE 0 END AS BIGINT), p.content, p.h FROM n i JOIN n p ON i.doc_id = p.doc_id AND p.elem_idx BETWEEN i.elem_idx + 1 AND i.elem_idx + 5 WHERE contains(i.content, '图片：./images/') AND p.content <> ''"""


def _segments(spark, d, side):
    s = _around(spark, d).select("doc_id", "elem_idx", F.explode(side).alias("s"))
    return s.select("doc_id", "elem_idx", F.col("s.distance").cast("long").alias("distance"), "s.text", "s.is_heading", F.col("s.heading_level").cast("long").alias("heading_level"))


@query(f"WITH {_COUNTED} SELECT doc_id, elem_idx, distance, text, {_HEAD} FROM ({_BEFORE})")
def w1_look_back(spark, d):
    return _segments(spark, d, "segments_before")


@query(f"WITH {_COUNTED} SELECT doc_id, elem_idx, distance, text, {_HEAD} FROM ({_AFTER})")
def w2_look_ahead(spark, d):
    return _segments(spark, d, "segments_after")


_LINE = "CASE WHEN is_heading THEN '【标题' || heading_level || '级】' WHEN distance = 0 THEN '【紧邻】' WHEN distance <= 2 THEN '【距离' || distance || '段】' ELSE '【较远' || distance || '段】' END || ' ' || text"


@query(f"""WITH {_COUNTED}, b AS (SELECT doc_id, elem_idx, '【图片前的内容】' || chr(10) || string_agg({_LINE}, chr(10) ORDER BY distance) AS t FROM (SELECT *, {_HEAD} FROM ({_BEFORE})) GROUP BY 1, 2),
a AS (SELECT doc_id, elem_idx, '【图片后的内容】' || chr(10) || string_agg({_LINE}, chr(10) ORDER BY distance) AS t FROM (SELECT *, {_HEAD} FROM ({_AFTER})) GROUP BY 1, 2)
SELECT i.doc_id, i.elem_idx, concat_ws(chr(10) || chr(10), b.t, a.t) AS context FROM n i LEFT JOIN b USING (doc_id, elem_idx) LEFT JOIN a USING (doc_id, elem_idx) WHERE contains(i.content, '图片：./images/')""")
def t10_prompt_context(spark, d):
    return _around(spark, d).select("doc_id", "elem_idx", documents.prompt_context(F.col("segments_before"), F.col("segments_after")).alias("context"))


def _pages(spark, d):
    c = table(spark, d, "doc_chunks").filter("doc_name is not null and chunk_text is not null")
    size = F.when(F.length("chunk_text") % 4 == 0, 20.0).otherwise(10.0)
    blocks = F.transform(F.split("chunk_text", "\n\n"), lambda b, i: F.struct(b.alias("text"), (size + i * 1.0).alias("font_size")))
    return c.select("doc_name", F.col("id").alias("page_num"), F.col("chunk_text").alias("text"), T.image_references("chunk_text").alias("images"), blocks.alias("text_blocks"))


@query(r"""WITH p AS (SELECT doc_name, id AS page_num, chunk_text AS text, len(regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{Z}]+)', 1)) AS n, string_split(chunk_text, chr(10) || chr(10)) AS b, CASE WHEN length(chunk_text) % 4 = 0 THEN 20.0 ELSE 10.0 END AS s FROM doc_chunks WHERE doc_name IS NOT NULL AND chunk_text IS NOT NULL),
q AS (SELECT *, lag(text) OVER w AS pt, lead(text) OVER w AS nt, sum(len(b) * s + len(b) * (len(b) - 1) / 2.0) OVER (PARTITION BY doc_name) / sum(len(b)) OVER (PARTITION BY doc_name) AS m FROM p WINDOW w AS (PARTITION BY doc_name ORDER BY page_num))
SELECT doc_name, page_num, round(m, 6) AS mean_size, trim(right(CASE WHEN pt IS NULL THEN array_to_string(b[:len(b) // 2], ' ') ELSE right(pt, 400) || ' ' || array_to_string(b[:len(b) // 2], ' ') END, 600), ' ') AS context_before,
trim(left(CASE WHEN nt IS NULL THEN array_to_string(b[len(b) // 2 + 1:], ' ') ELSE array_to_string(b[len(b) // 2 + 1:], ' ') || ' ' || left(nt, 400) END, 600), ' ') AS context_after FROM q WHERE n > 0""")
def w5_page_contexts(spark, d):
    return documents.page_contexts(_pages(spark, d)).select("doc_name", "page_num", F.round("mean_size", 6).alias("mean_size"), "context_before", "context_after")


_SEGMENT = "{'distance': %s, 'text': x.t, 'is_heading': x.s > 1.2 * m, 'heading_level': CASE WHEN x.s > 1.5 * m THEN 1 WHEN x.s > 1.2 * m THEN 2 ELSE 0 END}"


@query(rf"""WITH p AS (SELECT doc_name, id AS page_num, len(regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{{Z}}]+)', 1)) AS n, CASE WHEN length(chunk_text) % 4 = 0 THEN 20.0 ELSE 10.0 END AS z, string_split(chunk_text, chr(10) || chr(10)) AS c FROM doc_chunks WHERE doc_name IS NOT NULL AND chunk_text IS NOT NULL),
b AS (SELECT doc_name, page_num, n, list_transform(c, lambda t, k: {{'t': t, 's': CAST(z + k - 1 AS DOUBLE)}}) AS b FROM p),
q AS (SELECT *, lag(b) OVER w AS pb, lead(b) OVER w AS nb, sum(list_sum(list_transform(b, lambda x: x.s))) OVER d / sum(len(b)) OVER d AS m FROM b WINDOW w AS (PARTITION BY doc_name ORDER BY page_num), d AS (PARTITION BY doc_name)),
f AS (SELECT doc_name, page_num, m, len(b) // 2 AS half, list_filter(b[:len(b) // 2], lambda x: x.t <> '') AS f, list_filter(b[len(b) // 2 + 1:], lambda x: x.t <> '') AS g, list_filter(coalesce(pb[-5:], []), lambda x: x.t <> '') AS pb, list_filter(coalesce(nb[:5], []), lambda x: x.t <> '') AS nb FROM q WHERE n > 0),
r AS (SELECT doc_name, page_num, 'before' AS side, list_transform(pb, lambda x: {_SEGMENT % '3'}) || list_transform(f, lambda x, i: {_SEGMENT % 'greatest(half - i, 0)'}) AS segs FROM f
UNION ALL SELECT doc_name, page_num, 'after', list_transform(g, lambda x, i: {_SEGMENT % '(i - 1)'}) || list_transform(nb, lambda x, i: {_SEGMENT % '(len(g) + 2 + i)'}) FROM f)
SELECT doc_name, page_num, side, place, CAST(s.distance AS BIGINT) AS distance, s.text AS text, s.is_heading AS is_heading, CAST(s.heading_level AS BIGINT) AS heading_level FROM (SELECT doc_name, page_num, side, generate_subscripts(segs, 1) - 1 AS place, unnest(segs) AS s FROM r)""")
def w4_page_segments(spark, d):
    p = documents.page_contexts(_pages(spark, d))
    sides = [p.select("doc_name", "page_num", F.lit(n).alias("side"), F.posexplode(f"segments_{n}").alias("place", "s")) for n in ("before", "after")]
    s = sides[0].unionByName(sides[1])
    return s.select("doc_name", "page_num", "side", F.col("place").cast("long").alias("place"), F.col("s.distance").cast("long").alias("distance"), "s.text", "s.is_heading", F.col("s.heading_level").cast("long").alias("heading_level"))


@query("SELECT id, row_number() OVER (PARTITION BY doc_name ORDER BY chunk_index, id) AS number FROM doc_chunks")
def w7_numbering(spark, d):
    return numbered(table(spark, d, "doc_chunks").select("id", "doc_name", "chunk_index"), "doc_name", ["chunk_index", "id"]).select("id", F.col("number").cast("long").alias("number"))


@query("SELECT doc_name, chunk_index, max(id) AS id FROM (SELECT *, rank() OVER (PARTITION BY doc_name, chunk_index ORDER BY doc_timestamp DESC) AS r FROM doc_chunks) WHERE r = 1 GROUP BY 1, 2")
def w9_latest_chunks(spark, d):
    c = table(spark, d, "doc_chunks").select("doc_name", "chunk_index", "doc_timestamp", "id")
    return changes.latest(c, ["doc_name", "chunk_index"], [F.col("doc_timestamp"), F.col("id")]).select("doc_name", "chunk_index", "id")


# ---- scalar functions

_WS = r"\s\p{Z}\x0b\x1c-\x1f\x85"

_SAFE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(CASE WHEN coalesce(title, '') = '' THEN node_token ELSE title END, '[\\/:*?"<>|\s\p{Z}#%&+()\[\]{}]', '_', 'g'), '[（）【】｛｝＃％＆＋　]', '_', 'g'), '_+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g')"""


@query(f"SELECT node_token, CASE WHEN s = '' THEN node_token ELSE s END AS name FROM (SELECT node_token, {_SAFE} AS s FROM wiki_nodes)")
def t1_safe_names(spark, d):
    return table(spark, d, "wiki_nodes").select("node_token", T.safe_filename("title", "node_token").alias("name"))


@query(f"SELECT u AS url, {_PARSED} AS doc_type, CASE WHEN {_PARSED} IS NOT NULL THEN regexp_extract(u, '/([A-Za-z0-9_-]+)$', 1) END AS token FROM (SELECT {_URL} AS u FROM wiki_nodes)")
def t2_url_parts(spark, d):
    p = _urls(spark, d).select("url", T.address_parts("url").alias("p"))
    return p.select("url", "p.doc_type", "p.token")


@query("""WITH t AS (SELECT id, chunk_text AS t, length(chunk_text) AS n FROM doc_chunks),
p AS (SELECT id, t, n, list_filter(list_filter(range(3, n // 2 + 1), lambda p: substr(t, p + 1, p) = left(t, p)), lambda p: starts_with(t, repeat(left(t, p), CAST(greatest(2, ceil(CAST(0.6 AS DOUBLE) * n / p)) AS BIGINT))))[1] AS p FROM t)
SELECT id, CASE WHEN n < 10 OR p IS NULL THEN t ELSE left(t, p) || substr(t, p * CAST(list_max(list_filter(range(2, n // p + 1), lambda k: starts_with(t, repeat(left(t, p), CAST(k AS BIGINT))))) AS BIGINT) + 1) END AS text FROM p""")
def t3_without_repeats(spark, d):
    return table(spark, d, "doc_chunks").select("id", T.without_repeats_udf("chunk_text").alias("text"))


@query()
def t4_chunks(spark, d):
    return chunks.chunked(table(spark, d, "documents"), "doc_id", "text")


@query("SELECT id, length(chunk_text) AS chars, left(chunk_text, 100) AS head, right(chunk_text, 100) AS tail, substr(chunk_text, 11, 20) AS inside FROM doc_chunks")
def t6_code_points(spark, d):
    """Lengths and slices count code points."""
    t = F.col("chunk_text")
    return table(spark, d, "doc_chunks").select("id", F.length(t).alias("chars"), F.left(t, F.lit(100)).alias("head"), F.right(t, F.lit(100)).alias("tail"), F.substring(t, 11, 20).alias("inside"))


@query()
def t4_chunk_stats(spark, d):
    """Chunks, characters and longest chunk per language of re-split documents."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce(F.lower("lang"), F.lit("")).alias("lang"), "text")
    c = chunks.chunked(docs.withColumn("k", F.struct("doc_id", "lang")), "k", "text")
    return c.groupBy("k.lang").agg(F.count("*").alias("chunks"), F.sum("char_count").alias("chars"), F.max("char_count").alias("longest"))


@query("SELECT id, substr(md5(left(chunk_text, 100) || CAST(chunk_index AS VARCHAR)), 1, 12) AS chunk_id FROM doc_chunks")
def t5_chunk_ids(spark, d):
    return table(spark, d, "doc_chunks").select("id", T.chunk_id("chunk_text", "chunk_index").alias("chunk_id"))


@query(f"SELECT id, pos, filename FROM ({_REFS})")
def t7_image_references(spark, d):
    return _image_rows(spark, d).select("id", F.col("pos").cast("long").alias("pos"), "filename")


_KEYWORDS = "['" + "', '".join(tidying.KEYWORDS) + "']"


@query(f"""WITH c AS ({_CONTEXTS}), w AS (SELECT *, regexp_replace(context_before || context_after, '[^一-龥a-zA-Z0-9]', '', 'g') AS w FROM c),
k AS (SELECT *, list_filter(list_transform({_KEYWORDS}, lambda x: CASE WHEN contains(w, x) THEN substr(w, greatest(strpos(w, x) - 3, 1), strpos(w, x) + 17 - greatest(strpos(w, x) - 3, 1) + 1) END), lambda y: y IS NOT NULL AND length(y) BETWEEN 1 AND 18)[1] AS k FROM w)
SELECT doc_id, elem_idx, CASE WHEN w = '' THEN '图片' ELSE coalesce(k, nullif(right(regexp_replace(context_before, '[{chr(92)}s{chr(92)}p{{Z}}{chr(92)}x0b{chr(92)}x1c-{chr(92)}x1f{chr(92)}x85]+', '', 'g'), 18), ''),
nullif(left(regexp_replace(context_after, '[{chr(92)}s{chr(92)}p{{Z}}{chr(92)}x0b{chr(92)}x1c-{chr(92)}x1f{chr(92)}x85]+', '', 'g'), 18), ''), '图片') END AS name FROM k""")
def t8_image_names(spark, d):
    return _around(spark, d).select("doc_id", "elem_idx", T.image_name(F.col("context_before"), F.col("context_after")).alias("name"))


@query(f"""WITH e AS (SELECT doc_id, elem_idx, regexp_replace(content, '^[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+|[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+$', '', 'g') AS t, regexp_matches(content, '^#+ ') OR (regexp_full_match(content, '[^。！？.!?\\n]{{1,30}}') AND NOT contains(content, '图片：')) AS h FROM ({_ELEMENTS}))
SELECT doc_id, coalesce(min_by(t, elem_idx) FILTER (h), min_by(t, elem_idx)) AS title FROM e WHERE t <> '' GROUP BY 1""")
def t14_titles(spark, d):
    return documents.titles(documents.elements(table(spark, d, "documents")), "doc_id")


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS norm FROM embeddings")
def t16_norms(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(V.norm(F.col("embedding")), 4).alias("norm"))


@query("""SELECT vec_id, list_transform(embedding, lambda x: round(CAST(CAST(CAST(x AS DOUBLE) / greatest(n, 1e-12) AS FLOAT) AS DOUBLE), 5)) AS embedding FROM (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS n FROM embeddings)""")
def t16_unit_vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.transform(V.unit(F.col("embedding")), lambda x: F.round(x.cast("double"), 5)).alias("embedding"))


@query(r"""SELECT id, CASE WHEN len(r) > 0 THEN CAST(to_json(list_transform(r, lambda x: {'filename': x, 'path': './images/' || x})) AS VARCHAR) ELSE '[]' END AS images_json
FROM (SELECT id, regexp_extract_all(chunk_text, '图片：\./images/([^\s\p{Z}]+)', 1) AS r FROM doc_chunks)""")
def t18_images_json(spark, d):
    images = F.transform(T.image_references("chunk_text"), lambda x: F.struct(x.alias("filename"), F.concat(F.lit("./images/"), x).alias("path")))
    return table(spark, d, "doc_chunks").select("id", T.images_json(images).alias("images_json"))


@query("""SELECT space_id, i AS field_index, n AS name, coalesce(d, '') AS description, CASE WHEN coalesce(t, '') = '' THEN 'string' ELSE t END AS data_type FROM (SELECT space_id, 0 AS i, name AS n, description AS d, NULL AS t FROM wiki_spaces UNION ALL SELECT space_id, 1, '', 'unnamed', 'int' FROM wiki_spaces UNION ALL SELECT space_id, 2, space_id, NULL, 'id' FROM wiki_spaces) WHERE n IS NOT NULL AND trim(n) <> ''""")
def t19_sheet_fields(spark, d):
    rows = table(spark, d, "wiki_spaces").select("space_id", F.array("name", F.lit(""), "space_id").alias("names"), F.array("description", F.lit("unnamed"), F.lit(None)).alias("descriptions"), F.array(F.lit(None), F.lit("int"), F.lit("id")).alias("types"))
    return sheets.fields(rows, "space_id", "names", "descriptions", "types")


@query("SELECT id, split_part(coalesce(source_chunk_id, ''), '<SEP>', 1) AS source_doc FROM lightrag_entities")
def t21_first_source(spark, d):
    return table(spark, d, "lightrag_entities").select("id", T.first_part("source_chunk_id").alias("source_doc"))


@query("SELECT id, 'page_' || lpad(CAST(page_number AS VARCHAR), 4, '0') || '_img_' || lpad(CAST(image_count AS VARCHAR), 3, '0') || '.png' AS name FROM doc_chunks WHERE page_number IS NOT NULL AND image_count IS NOT NULL")
def t22_padded_names(spark, d):
    c = table(spark, d, "doc_chunks").filter("page_number is not null and image_count is not null")
    return c.select("id", T.page_image_name(F.col("page_number"), F.col("image_count"), F.lit("png")).alias("name"))


@query("SELECT id, CASE WHEN weight IS NULL OR isnan(weight) OR weight = 0 THEN 1.0 ELSE weight END AS weight FROM lightrag_relations")
def t23_weights(spark, d):
    return table(spark, d, "lightrag_relations").select("id", T.weight_or_one("weight").alias("weight"))


@query(f"""WITH p AS ({ORACLES["t10_prompt_context"]}), r AS ({ORACLES["t8_image_names"]}), a AS (SELECT doc_id, elem_idx, left(regexp_replace(string_split(trim(list_last(string_split(context, '】 ')), ' ' || chr(10)), chr(10))[1], '[^{chr(92)}p{{L}}{chr(92)}p{{N}}]', '', 'g'), 18) AS a FROM p)
SELECT doc_id, elem_idx, CASE WHEN length(coalesce(a, '')) > 1 THEN a ELSE name END AS name FROM a JOIN r USING (doc_id, elem_idx)""")
def t9_image_names_by_client(spark, d):
    a = _around(spark, d)
    a = a.withColumn("context", documents.prompt_context(F.col("segments_before"), F.col("segments_after"))).select("doc_id", "elem_idx", "context", "context_before", "context_after")
    # a stand-in for a model: it answers with the start of the last segment
    return naming.named(a, lambda: lambda prompt: prompt.split("】 ")[-1]).select("doc_id", "elem_idx", "name")


@query(f"SELECT node_token, CASE WHEN t = '' THEN obj_token WHEN s = '' THEN obj_token ELSE s END AS name FROM (SELECT node_token, obj_token, coalesce(title, '') AS t, {_SAFE.replace('node_token', 'obj_token')} AS s FROM (SELECT node_token, obj_token, regexp_replace(title, '^[{_WS}]+|[{_WS}]+$', '', 'g') AS title FROM wiki_nodes))")
def t15_title_names(spark, d):
    return table(spark, d, "wiki_nodes").select("node_token", T.title_name("title", "obj_token").alias("name"))


@query("SELECT doc_id, coalesce(len(list_filter(string_split(text, ' '), lambda x: x <> '')), 0) AS words FROM documents")
def t20_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", T.size_udf("text", lambda: lambda t: sum(1 for w in t.split(" ") if w)).alias("words"))


# ---- replace, upsert, schema


@query("SELECT source_entity AS name FROM lightrag_relations UNION ALL SELECT target_entity FROM lightrag_relations UNION ALL SELECT entity_name FROM lightrag_entities")
def u1_union(spark, d):
    r, e = table(spark, d, "lightrag_relations"), table(spark, d, "lightrag_entities")
    return r.select(F.col("source_entity").alias("name")).unionByName(r.select(F.col("target_entity").alias("name"))).unionByName(e.select(F.col("entity_name").alias("name")))


@query("""SELECT id AS row_id, doc_name FROM doc_chunks WHERE doc_name IS NULL OR doc_name NOT IN (SELECT doc_name FROM chunks WHERE doc_name IS NOT NULL) UNION ALL SELECT row_id, doc_name FROM chunks""")
def u2_replace_documents(spark, d):
    return changes.replaced(table(spark, d, "doc_chunks").select(F.col("id").alias("row_id"), "doc_name"), table(spark, d, "chunks").select("row_id", "doc_name"), "doc_name")


@query("""SELECT entity_name, arg_max(id, (CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END, batch_timestamp, id)) AS id FROM lightrag_entities WHERE batch_timestamp IS NOT NULL GROUP BY 1""")
def u4_upsert_entities(spark, d):
    """Names come in several batches: a third of the rows, taken as fresh, win over the others, the last batch first."""
    e = table(spark, d, "lightrag_entities").filter("batch_timestamp is not null").select("entity_name", "batch_timestamp", "id")
    return changes.upserted(e.filter("id % 3 <> 0"), e.filter("id % 3 = 0"), ["entity_name"], [F.col("batch_timestamp"), F.col("id")]).select("entity_name", "id")


@query("""WITH f AS (SELECT * FROM lightrag_relations WHERE id % 5 = 0 AND batch_timestamp IN (SELECT batch_timestamp FROM lightrag_relations ORDER BY batch_timestamp DESC LIMIT 1))
SELECT id, batch_timestamp FROM f UNION ALL SELECT id, batch_timestamp FROM lightrag_relations WHERE batch_timestamp IS NULL OR batch_timestamp NOT IN (SELECT batch_timestamp FROM f)""")
def u5_append_by_batch(spark, d):
    """The last batch is run again and comes out shorter; the others stay."""
    r = table(spark, d, "lightrag_relations").select("id", "batch_timestamp")
    last = r.agg(F.max("batch_timestamp").alias("batch_timestamp"))
    return changes.appended(r, r.filter("id % 5 = 0").join(F.broadcast(last), "batch_timestamp", "left_semi"), "batch_timestamp")


@query("SELECT row_id, doc_name, '' AS space_id, '' AS source_url FROM chunks UNION ALL SELECT id, doc_name, coalesce(space_id, ''), coalesce(source_url, '') FROM doc_chunks")
def u6_schema_evolution(spark, d):
    fill = {"space_id": F.lit(""), "source_url": F.lit("")}
    old = changes.with_columns(table(spark, d, "chunks").select("row_id", "doc_name"), fill)
    new = changes.with_columns(table(spark, d, "doc_chunks").select(F.col("id").alias("row_id"), "doc_name", "space_id", "source_url"), fill)
    return old.unionByName(new)


# ---- retrieval

_VECTOR = [((i * 37) % 101 - 50) / 50 for i in range(512)]
_QUERY = "CAST([" + ",".join(map(str, _VECTOR)) + "] AS DOUBLE[])"
_FINITE = "len(embedding) = 512 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


def _topk(where: str, k: int, more: str = "") -> str:
    return f"SELECT id{more}, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), {_QUERY}), 6) AS similarity FROM (SELECT * FROM doc_chunks WHERE {_FINITE} AND {where}) ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), {_QUERY}) DESC, id LIMIT {k}"


def _scored(df: DataFrame) -> DataFrame:
    return df.select("id", F.round("similarity", 6).alias("similarity"))


@query(_topk("true", 10))
def q1_vector_topk(spark, d):
    return _scored(search.nearest(table(spark, d, "doc_chunks").select("id", "embedding"), _VECTOR, 10))


_TIMES = "len(list_filter(w, lambda x: x = '{}'))"


@query("""SELECT id, round((1 + ln(a) + 1 + ln(b)) / (1 + ln(n)), 6) AS rank FROM (SELECT id, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'glossary')) AS b FROM
(SELECT id, list_filter(string_split_regex(lower(chunk_text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: x <> '') AS w FROM doc_chunks)) WHERE a > 0 AND b > 0 ORDER BY (1 + ln(a) + 1 + ln(b)) / (1 + ln(n)) DESC, id LIMIT 10""")
def q2_fulltext(spark, d):
    return search.ranked(table(spark, d, "doc_chunks").select("id", "chunk_text"), "the glossary").select("id", F.round("rank", 6).alias("rank"))


@query(_topk("contains(chunk_text, '权限')", 10))
def q3_hybrid(spark, d):
    return _scored(search.hybrid(table(spark, d, "doc_chunks").select("id", "chunk_text", "embedding"), "权限", _VECTOR, 10))


@query(_topk("doc_name = '会议纪要'", 5))
def q4_within_document(spark, d):
    return _scored(search.nearest(table(spark, d, "doc_chunks").select("id", "doc_name", "embedding"), _VECTOR, 5, where=F.col("doc_name") == "会议纪要"))


@query("""SELECT id, k AS image_no, json_extract_string(images_json, '$[' || k || '].filename') AS filename, json_extract_string(images_json, '$[' || k || '].path') AS path
FROM (SELECT id, images_json, unnest(range(0, CAST(json_array_length(images_json) AS BIGINT))) AS k FROM doc_chunks WHERE has_images AND doc_name = '会议纪要' AND json_valid(images_json))""")
def q5_image_chunks(spark, d):
    return search.images_of(table(spark, d, "doc_chunks"), "会议纪要").withColumn("image_no", F.col("image_no").cast("long"))


@query("SELECT DISTINCT source_entity, target_entity, relation_type FROM lightrag_relations WHERE source_entity IS NOT NULL AND target_entity IS NOT NULL")
def q7_edges(spark, d):
    return table(spark, d, "lightrag_relations").filter("source_entity is not null and target_entity is not null").select("source_entity", "target_entity", "relation_type").distinct()


@query(rf"""SELECT count(*) AS chunks, count_if(coalesce(regexp_matches(regexp_replace(chunk_text, '[{_WS}]+$', ''), '[。！？.!?…।؟]["”’」』）)]*$'), false)) AS ends_in_mark, count_if(NOT coalesce(regexp_matches(chunk_text, '[^{_WS}]'), false)) AS blank,
min(length(chunk_text)) AS least, max(length(chunk_text)) AS most, CAST(sum(length(chunk_text)) AS BIGINT) AS chars, quantile_cont(length(chunk_text), 0.25) AS quarter, quantile_cont(length(chunk_text), 0.5) AS half, quantile_cont(length(chunk_text), 0.75) AS three_quarters, quantile_cont(length(chunk_text), 0.95) AS most_but_a_twentieth, count_if(coalesce(source_file, '') = '') AS no_source, count_if(coalesce(processed_at, '') = '') AS no_time, count_if(embedding IS NULL) AS no_vector FROM doc_chunks""")
def q9_quality(spark, d):
    return search.quality(table(spark, d, "doc_chunks"))


@query("SELECT doc_name, count(*) AS chunks FROM doc_chunks WHERE doc_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def o4_largest_document(spark, d):
    c = table(spark, d, "doc_chunks").filter("doc_name is not null").groupBy("doc_name").agg(F.count("*").alias("chunks"))
    return c.orderBy(F.desc("chunks"), "doc_name").limit(1)


@query("SELECT id, doc_name, chunk_index FROM doc_chunks ORDER BY doc_name, chunk_index, id")
def o1_sorted_scan(spark, d):
    return table(spark, d, "doc_chunks").select("id", "doc_name", "chunk_index").orderBy("doc_name", "chunk_index", "id")


# ---- graph


@query(r"""WITH w AS (SELECT CAST(id AS VARCHAR) AS chunk_id, list_filter(string_split_regex(coalesce(chunk_text, ''), '[^\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Z][a-z]{4,}')) AS w FROM doc_chunks),
u AS (SELECT chunk_id, list_filter(w, lambda x, i: list_position(w, x) = i) AS w FROM w)
SELECT chunk_id, 'entity' AS kind, unnest(w) AS name, NULL AS target, 'UNKNOWN' AS type FROM u UNION ALL SELECT chunk_id, 'relation', w[i], w[i + 1], 'near' FROM (SELECT chunk_id, w, unnest(range(1, len(w))) AS i FROM u)""")
def g1_extracted(spark, d):
    c = table(spark, d, "doc_chunks").select(F.col("id").cast("string").alias("chunk_id"), F.col("chunk_text").alias("content"))
    return graph.extracted(c).select("chunk_id", "kind", "name", "target", "type")


@query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 10) / 50.0), 1) AS BIGINT))) AS i FROM w WHERE len(w) > 0)
SELECT doc_id, i AS window_no, len(w[i * 50 + 1 : i * 50 + 60]) AS tokens, array_to_string(w[i * 50 + 1 : i * 50 + 60], ' ') AS content FROM k""")
def g3_token_windows(spark, d):
    t = table(spark, d, "documents").filter("text is not null")
    w = chunks.token_windows(search.words(F.col("text")), 60, 10)
    return t.select("doc_id", F.posexplode(w).alias("window_no", "w")).select("doc_id", "window_no", F.size("w").alias("tokens"), F.array_join("w", " ").alias("content"))


@query(rf"""WITH t AS (SELECT entity_name, coalesce(entity_type, 'UNKNOWN') AS t, count(*) AS n FROM lightrag_entities WHERE entity_name IS NOT NULL GROUP BY 1, 2),
s AS (SELECT entity_name, string_agg(description, '<SEP>' ORDER BY r) AS description FROM (SELECT entity_name, description, row_number() OVER (PARTITION BY entity_name ORDER BY description) AS r FROM (SELECT DISTINCT entity_name, description FROM lightrag_entities WHERE regexp_matches(description, '[^{_WS}]'))) WHERE r <= 100 GROUP BY 1)
SELECT entity_name, entity_type, mentions, coalesce(description, '') AS description FROM (SELECT entity_name, arg_min(t, r) AS entity_type, CAST(sum(n) AS BIGINT) AS mentions FROM (SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY n DESC, t) AS r FROM t) GROUP BY 1) LEFT JOIN s USING (entity_name)""")
def g4_entity_merge(spark, d):
    return graph.merged_entities(table(spark, d, "lightrag_entities")).select("entity_name", "entity_type", "mentions", "description")


@query(rf"SELECT DISTINCT entity_name, description FROM lightrag_entities WHERE entity_name IS NOT NULL AND regexp_matches(description, '[^{_WS}]')")
def g4_descriptions(spark, d):
    return graph.descriptions(table(spark, d, "lightrag_entities"))


@query("""SELECT least(source_entity, target_entity) AS source_entity, greatest(source_entity, target_entity) AS target_entity, round(sum(CASE WHEN weight IS NULL OR isnan(weight) OR weight = 0 THEN 1.0 ELSE weight END), 4) AS weight, count(*) AS relations FROM lightrag_relations WHERE source_entity <> target_entity GROUP BY 1, 2""")
def g4_relation_merge(spark, d):
    return graph.merged_relations(table(spark, d, "lightrag_relations")).withColumn("weight", F.round("weight", 4))


@query("SELECT entity_name, entity_type, description, split_part(coalesce(source_chunk_id, ''), '<SEP>', 1) AS source_doc, source_chunk_id, batch_timestamp FROM lightrag_entities")
def k6_export_entities(spark, d):
    return graph.export_entities(table(spark, d, "lightrag_entities"))


@query("SELECT source_entity, target_entity, relation_type, description, CASE WHEN weight IS NULL OR isnan(weight) OR weight = 0 THEN 1.0 ELSE weight END AS weight, source_doc, batch_timestamp FROM lightrag_relations")
def k6_export_relations(spark, d):
    return graph.export_relations(table(spark, d, "lightrag_relations"))


@query("SELECT chunk_id, doc_name, content, length(content) AS token_count, chunk_index AS chunk_order, doc_name AS full_doc_id, '20260101_000000' AS batch_timestamp FROM chunks")
def k6_export_chunks(spark, d):
    c = table(spark, d, "chunks").select("chunk_id", "doc_name", "content", F.col("chunk_index").alias("chunk_order"), F.lit("20260101_000000").alias("batch_timestamp"))
    return graph.export_chunks(c)
