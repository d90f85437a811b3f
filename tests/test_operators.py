from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import catalog
from quire.functions import text as T
from quire.functions import vectors as V
from quire.operators import changes, chunks, documents, embedding, graph, search, tree
from quire.operators.components import connected
from quire.plans import order


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in parent)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(None, 1), (5, 5)]
    df = spark.createDataFrame(edges, "src long, dst long")
    assert rows(connected(df), "node", "component") == sorted(plain_components(edges), key=repr)


def test_components_of_nothing_and_of_a_hub(spark):
    assert connected(spark.createDataFrame([], "src long, dst long")).count() == 0
    hub = spark.range(1, 500).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    assert connected(hub).filter("component = 0").count() == 500


def test_tree_depth_and_cycles(spark):
    chain = [(f"n{i}", f"n{i - 1}" if i else "") for i in range(13)] + [("a", "b"), ("b", "a"), ("x", "gone"), ("n3", "n2")]
    got = dict(rows(tree.walked(spark.createDataFrame(chain, "n string, p string"), "n", "p"), "node", "level"))
    assert got == {f"n{i}": i for i in range(11)}


def test_replace_leaves_nothing_behind(spark):
    old = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0)], "doc string, i int")
    new = spark.createDataFrame([("a", 7)], "doc string, i int")
    assert rows(changes.replaced(old, new, "doc"), "doc", "i") == [("a", 7), ("b", 0)]


def test_upsert_prefers_fresh_and_last(spark):
    old = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, t int, v string")
    assert rows(changes.upserted(old, new, ["k"], [F.col("t")]), "k", "v") == [("a", "y"), ("b", "old")]


def test_change_states(spark):
    e = spark.createDataFrame([("n", "1"), ("m", "1"), ("s", "1"), ("c", "2"), ("z", None)], "token string, obj_edit_time string")
    m = spark.createDataFrame([("m", "1", "/p", False), ("s", "1", "/p", True), ("c", "1", "/p", True), ("z", "1", None, False)], "token string, obj_edit_time string, file_path string, path_exists boolean")
    assert dict(rows(changes.changed(e, m), "token", "state")) == {"n": "new", "m": "missing", "s": "same", "c": "changed", "z": "same"}


def test_manifest_keeps_what_failed(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "1")], "doc string, hash string")
    h = spark.createDataFrame([("a", "2"), ("b", "2"), ("c", "2")], "doc string, hash string")
    done = spark.createDataFrame([("a",), ("c",)], "doc string")
    assert rows(changes.advanced(m, h, done, "doc"), "doc", "hash") == [("a", "2"), ("b", "1"), ("c", "2")]


def test_safe_names(spark):
    names = ["a b:c", "（全角）【x】", "　", "__a__b__", "...", "", None, "完成"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(T.safe_filename("n", F.lit("f")).alias("s"))
    assert [r.s for r in df.collect()] == ["a_b_c", "全角_x", "f", "a_b", "f", "f", "f", "完成"]


def test_addresses(spark):
    urls = ["https://h.example/wiki/AbC_1", "https://h.example/docs/x", "https://h.example/doc/x", "https://h.example/sheet/s", "https://h.example/bitable/b", "https://h.example/else/b", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(T.address_parts("u").alias("p"))
    assert [r.p and (r.p.token, r.p.doc_type, r.p.ext) for r in df.collect()] == [("AbC_1", "wiki", "docx"), ("x", "doc", "docx"), ("x", "doc", "docx"), ("s", "sheet", "xlsx"), ("b", "bitable", "xlsx"), None, None]


def test_look_around_counts_full_elements_only(spark):
    e = [("d", i, t, t == "图片：./images/i.png", False, 0) for i, t in enumerate(["1", "2", "3", "4", "5", "", "7", "8", "9", "图片：./images/i.png", "a", "", "b", "c", "d", "e"])]
    df = spark.createDataFrame(e, "doc string, elem_idx int, content string, has_image boolean, is_heading boolean, heading_level int")
    r = documents.surroundings(df, "doc").first()
    assert [(s.text, s.distance) for s in r.segments_before] == [("9", 0), ("8", 1), ("7", 2), ("5", 3), ("4", 4), ("3", 5), ("2", 6)]
    assert [(s.text, s.distance) for s in r.segments_after] == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    assert (r.context_before, r.context_after) == ("2 3 4 5 7 8 9", "a b c d")


def test_own_text_of_an_image_comes_first(spark):
    e = [("d", 0, "before"), ("d", 1, "See the plan 图片：./images/a.png"), ("d", 2, "next"), ("d", 3, "图片：./images/b.png"), ("d", 4, "last")]
    df = spark.createDataFrame([(*x, "图片：" in x[2], False, 0) for x in e], "doc string, elem_idx int, content string, has_image boolean, is_heading boolean, heading_level int")
    r = documents.surroundings(df, "doc").orderBy("elem_idx").collect()
    assert [(s.text, s.distance) for s in r[0].segments_after][:2] == [("See the plan", 0), ("next", 1)]
    assert [(s.text, s.distance) for s in r[1].segments_after] == [("last", 0)] and r[0].context_after.startswith("See the plan next")


def test_queries_of_prompts_have_the_own_text(spark, tmp_path):
    text = "before\n\nSee the plan 图片：./images/a.png\n\nnext"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert "See the plan\n" in catalog.QUERIES["t10_prompt_context"](spark, str(tmp_path)).first().context


def test_page_contexts(spark):
    page = lambda n, img, sizes: ("d", n, f"text{n}", img, [(f"p{n}b{i}", s) for i, s in enumerate(sizes)])
    df = spark.createDataFrame([page(1, [], [10.0] * 7), page(2, ["i"], [10.0, 13.0, 16.0, 10.0]), page(3, [], [10.0])], "doc_name string, page_num int, text string, images array<string>, text_blocks array<struct<text:string,font_size:double>>")
    r = documents.page_contexts(df).first()
    assert [(s.text, s.distance) for s in r.segments_before] == [(f"p1b{i}", 3) for i in range(2, 7)] + [("p2b0", 1), ("p2b1", 0)]
    assert [(s.text, s.distance, s.heading_level) for s in r.segments_after] == [("p2b2", 0, 2), ("p2b3", 1, 0), ("p3b0", 5, 0)]
    sizeless = df.withColumn("text_blocks", F.transform("text_blocks", lambda b: F.struct(b["text"].alias("text"), F.lit(0.0).alias("font_size"))))
    assert documents.page_contexts(sizeless).first().mean_size == 12.0


def test_chunks_without_python_are_the_same(spark):
    docs = spark.createDataFrame([(1, "　a b "), (2, ""), (3, None), (4, "x" * 1000), (5, "句子。" * 500), (6, " \n")], "id int, text string")
    got = chunks.chunked(docs, "id", "text")
    from quire.core.splitting import split

    want = sorted((i, n, c) for i, t in [(r.id, r.text) for r in docs.collect()] for n, c in enumerate(split(t)))
    assert sorted((r.id, r.chunk_index, r.content) for r in got.collect()) == want


def test_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [4.0, 3.0]), (6, [1.0]), (7, [4.0, 3.0])], "id int, embedding array<float>")
    assert [r.id for r in search.nearest(df, [4.0, 3.0], 3).collect()] == [5, 7, 1]
    assert [float(x) for x in df.filter("id = 2").select(V.unit(F.col("embedding")).alias("u")).first().u] == [0.0, 0.0]


def test_ranked_needs_every_word(spark):
    df = spark.createDataFrame([(1, "red fox"), (2, "red red fox"), (3, "red"), (4, None)], "id int, chunk_text string")
    assert [r.id for r in search.ranked(df, "fox RED").collect()] == [2, 1]
    assert search.ranked(df, " !").count() == 0


def test_embedding_survives_a_failing_batch(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, " "), (4, "bad")], "id int, t string")

    def load():
        def model(texts):
            if "bad" in texts:
                raise ValueError
            return np.ones((len(texts), 4))

        return model

    got = {r.id: r.embedding for r in embedding.embedded(df, "t", load, batch=1).collect()}
    assert got[1] == [0.5] * 4 and got[2] is got[3] is got[4] is None


def test_graph_merge(spark):
    e = spark.createDataFrame([("x", "a", "d1"), ("x", "b", "d2"), ("x", "b", "d1"), ("y", None, " "), (None, "a", "z")], "entity_name string, entity_type string, description string")
    assert rows(graph.merged_entities(e), "entity_name", "entity_type", "description") == [("x", "b", "d1<SEP>d2"), ("y", "UNKNOWN", "")]
    r = spark.createDataFrame([("a", "b", 0.0), ("b", "a", 2.5), ("a", "a", 1.0), (None, "a", 1.0), ("a", "b", float("nan"))], "source_entity string, target_entity string, weight double")
    assert rows(graph.merged_relations(r), "source_entity", "target_entity", "weight", "relations") == [("a", "b", 4.5, 3)]


def test_extraction_keeps_going(spark):
    def bad(text):
        raise RuntimeError("no")

    c = spark.createDataFrame([("1", "Alpha Vexing")], "chunk_id string, content string")
    assert graph.extracted(c, bad).first().error.startswith("RuntimeError")
    found = graph.extracted(c)
    assert rows(graph.entities_of(found), "entity_name") == [("Alpha",), ("Vexing",)]
    assert rows(graph.relations_of(found), "source_entity", "target_entity", "weight") == [("Alpha", "Vexing", 1.0)]
    calls = []

    def once(text):
        calls.append(text)
        if len(calls) == 1:
            raise ConnectionError
        return graph.capital_words(text)

    assert graph.extracted(c, once).filter("kind = 'entity'").count() == 2


def test_hubs_stay_rows_of_bounded_size(spark):
    e = spark.range(300).select(F.lit("hub").alias("entity_name"), F.lit("t").alias("entity_type"), F.format_string("d%03d", "id").alias("description"), F.col("id").cast("string").alias("chunk_id"))
    said = graph.merged_entities(e).first().description.split("<SEP>")
    assert said == [f"d{i:03d}" for i in range(graph.JOINED)] and graph.descriptions(e).count() == 300
    assert len(graph.source_ids(e, ["entity_name"]).first().source_chunk_id.split("<SEP>")) == graph.JOINED


def test_hashes_and_volumes_of_large_keys(spark):
    import hashlib

    made = [("hot", i, f"t{i}") for i in range(25)] + [("one", 0, "x"), (None, 0, "n"), ("none", 0, None)]
    df = spark.createDataFrame(made, "k string, i int, t string").repartition(5)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    parts = [sha("".join(f"t{i}" for i in range(s, min(s + 10, 25)))) for s in (0, 10, 20)]
    assert {r.k: r.hash for r in changes.document_hashes(df, "k", ["i"], "t", 10).collect()} == {"hot": sha("".join(parts)), "one": sha("x"), None: sha("n"), "none": sha("")}
    got = {(r.k, r.volume): r.full_text for r in documents.volumes(df, "k", ["i"], "t", 10, "-").collect()}
    assert got["hot", 1] == "-".join(f"t{i}" for i in range(10, 20)) and got["hot", 2].endswith("t24") and got["none", 0] == "" and len(got) == 6


def test_hashes_of_sets(spark):
    of = lambda rows: {r.k: r.hash for r in changes.set_hashes(spark.createDataFrame(rows, "k string, t string"), "k", "t").collect()}
    a = of([("a", "x"), ("a", "y"), ("b", None)])
    assert a == of([("b", ""), ("a", "y"), ("a", "x")]) and a["a"] != of([("a", "x"), ("a", "y"), ("a", "y")])["a"] != of([("a", "x"), ("a", "z"), ("a", "y")])["a"]


def test_batches_run_again_are_not_doubled(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, b string")
    assert rows(changes.appended(old, spark.createDataFrame([(4, "y"), (5, "z")], "id int, b string"), "b"), "id") == [(1,), (3,), (4,), (5,)]


def test_image_names(spark):
    said = [(None, None), ("系统架构", ""), ("", "，。!"), ("流程 图", ""), ("没有词" * 10, ""), ("", "a b c"), ("甲" * 10 + "图" + "乙" * 20, ""), ("abc图" + "d" * 30, "表")]
    df = spark.createDataFrame(said, "b string, a string").select(T.image_name(F.col("b"), F.col("a")).alias("n"))
    assert [r.n for r in df.collect()] == ["图片", "系统架构", "图片", "流程图", ("没有词" * 10)[-18:], "abc", "乙" * 18, "ddd表"]


def test_documents_are_assembled(spark):
    e = [("d", 0, "Title", False, True, 1), ("d", 1, "See it", True, False, 0), ("d", 2, "", True, False, 0), ("d", 3, "End", False, False, 0), ("d", 4, "no file", True, False, 0), ("x", None, None, None, None, None)]
    elems = spark.createDataFrame(e, "doc_name string, elem_idx int, content string, has_image boolean, is_heading boolean, heading_level int")
    media = spark.createDataFrame([("d", 0, "word/media/a.png", "img_001_a.png"), ("d", 1, "word/media/b.jpeg", "img_002_b.jpeg"), ("y", 0, "z.png", "z")], "doc_name string, image_no int, media string, original_filename string")
    texts, index = documents.assembled(elems, media, lambda: lambda context: "名字" if "See it" in context else "x")
    named = {r.image_no: r for r in index.collect()}
    assert [named[i].filename for i in (0, 1)] == ["名字_001.png", "名字_002.jpeg"] and named[0].context_before == "Title" and len(named) == 2
    assert texts.first().text == "Title\n\nSee it\n\n图片：./images/名字_001.png\n\n图片：./images/名字_002.jpeg\n\nEnd\n\nno file"


def test_lines_of_spans(spark):
    df = spark.createDataFrame([([[("a", 9.0), ("b", 12.0)], [("c", 8.0)]],)], "l array<array<struct<text:string,font_size:double>>>")
    assert [tuple(b) for b in df.select(documents.line_blocks(F.col("l")).alias("b")).first().b] == [("ab", 12.0), ("c", 8.0)]


def test_lists_of_images(spark):
    df = spark.createDataFrame([(1, "d", True, '[{"filename": "a"}, {"filename": "b", "path": "p"}]'), (2, "d", True, "broken"), (3, "d", False, "[]"), (4, "e", True, '[{"filename": "a"}]')], "id int, doc_name string, has_images boolean, images_json string")
    assert rows(search.images_of(df, "d"), "id", "image_no", "filename", "path") == [(1, 0, "a", None), (1, 1, "b", "p")]


def test_stop_after_a_failure(spark):
    df = spark.createDataFrame([(i, "bad" if i == 1 else "good") for i in range(4)], "id int, t string").coalesce(1)

    def load():
        def model(texts):
            if "bad" in texts:
                raise ValueError
            return np.ones((len(texts), 2))

        return model

    assert [r.embedding is None for r in embedding.embedded(df, "t", load, 1, stop=True).orderBy("id").collect()] == [False, True, True, True]


def test_token_windows(spark):
    df = spark.createDataFrame([([str(i) for i in range(n)],) for n in (0, 5, 10, 11)], "t array<string>")
    got = [[len(w) for w in r.w] for r in df.select(chunks.token_windows(F.col("t"), 5, 1).alias("w")).collect()]
    assert got == [[], [5], [5, 5, 2], [5, 5, 3]]


def test_order_within_a_hot_key(spark):
    made = [("hot", i) for i in range(300)] + [(None, 1), (None, 2), ("one", 7)]
    random.Random(0).shuffle(made)
    df = spark.createDataFrame(made, "k string, i int").repartition(8)
    got = {(r.k, r.i): (r.number) for r in order.numbered(df, "k", ["i"]).collect()}
    assert got == {("hot", i): i + 1 for i in range(300)} | {(None, 1): 1, (None, 2): 2, ("one", 7): 1}
    near = {(r.k, r.i): (r.before, r.after) for r in order.beside(df, "k", ["i"], F.col("i")).collect()}
    assert near[None, 1] == (None, 2) and near["one", 7] == (None, None)
    assert all(near["hot", i] == (i - 1 if i else None, i + 1 if i < 299 else None) for i in range(300))
