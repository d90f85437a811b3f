from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.config import Options
from quire.operators import naming, search
from quire.operators.embedding import hashing_model
from quire.plans.pipeline import Pipeline, doctor, report, results
from quire.plans.retry import retried
from quire.plans.snapshots import Store, lock
from quire.sources import layout, sheets, wiki, word
from quire.streaming import ingest

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx() -> bytes:
    body = (
        "<w:p><w:pPr><w:pStyle w:val='h1'/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p>"
        "<w:p><w:r><w:t>Some</w:t></w:r><w:r><w:t> text</w:t></w:r></w:p><w:p/>"
        "<w:p><w:r><w:drawing><a:blip xmlns:a='x'/></w:drawing></w:r></w:p>"
        "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc/></w:tr></w:tbl>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document xmlns:w='{W}'><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f"<w:styles xmlns:w='{W}'><w:style w:styleId='h1'><w:name w:val='heading 2'/></w:style></w:styles>")
        z.writestr("word/media/image1.png", b"x")
    return out.getvalue()


def xlsx() -> bytes:
    m = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    r = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    row = lambda n, cells: f"<row r='{n}'>" + "".join(f"<c r='{c}{n}' t='inlineStr'><is><t>{t}</t></is></c>" for c, t in cells) + "</row>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='{m}'><sheets><sheet name='S' xmlns:r='{r}' r:id='r1'/><sheet name='T' xmlns:r='{r}' r:id='r2'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships><Relationship Id='r1' Target='worksheets/s.xml'/><Relationship Id='r2' Target='/xl/worksheets/t.xml'/></Relationships>")
        z.writestr("xl/worksheets/s.xml", f"<worksheet xmlns='{m}'><sheetData>{row(1, [('A', 'id'), ('C', 'name')])}{row(2, [('A', 'key')])}{row(3, [('C', 'text')])}{row(4, [('A', 'no')])}</sheetData></worksheet>")
        z.writestr("xl/worksheets/t.xml", f"<worksheet xmlns='{m}'><sheetData>{row(1, [('A', 'x')])}</sheetData></worksheet>")
    return out.getvalue()


def test_word_files(spark, tmp_path):
    (tmp_path / "a b.docx").write_bytes(docx())
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    got = word.read(spark, str(tmp_path)).orderBy("doc_name", "elem_idx").collect()
    assert [(r.elem_type, r.content, r.has_image, r.heading_level) for r in got if r.doc_name == "a_b"] == [("paragraph", "Title", False, 2), ("paragraph", "Some text", False, 0), ("paragraph", "", True, 0), ("table", "a | b", False, 0)]
    assert [bool(r.error) for r in got if r.doc_name == "bad"] == [True]
    assert [r.original_filename for r in word.images(spark, str(tmp_path)).collect()] == ["img_001_image1.png"]
    names = spark.createDataFrame([("a_b", 0, "x.png"), ("a_b", 7, "y.png")], "doc_name string, image_no int, smart_filename string")
    assert [(r.smart_filename, r.bytes) for r in word.write_images(spark, str(tmp_path), names, str(tmp_path / "out")).collect()] == [("x.png", 1)]
    assert (tmp_path / "out/a_b/images/x.png").read_bytes() == b"x"


def test_sheets(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(xlsx())
    s = sheets.read(spark, str(tmp_path))
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    per = {r.path.rsplit("/", 1)[1]: r for r in sheets.per_file(sheets.read(spark, str(tmp_path))).collect()}
    assert (per["w.xlsx"].found, per["w.xlsx"].extracted, per["w.xlsx"].success) == (2, 1, True) and not per["bad.xlsx"].success and per["bad.xlsx"].error
    assert sheets.read(spark, str(tmp_path), "w.xlsx", 3, 1, 2).filter("names is not null").first().names == ["no"]
    got = sheets.fields(s.filter("names is not null"), "sheet", "names", "descriptions", "types").orderBy("field_index").collect()
    assert [(r.field_index, r.name, r.description, r.data_type) for r in got] == [(0, "id", "key", "string"), (2, "name", "", "text")]


def test_paged_source(spark):
    pages = {("s1", None): ([("n1", "", "o1", "docx", "t", "s1", "1")], "c"), ("s1", "c"): ([("n2", "n1", "o2", "doc", "", "s1", None)], None), ("s2", None): ([], None)}
    spark.dataSource.register(wiki.paged(lambda space, cursor: pages[space, cursor]))
    nodes = spark.read.format("wiki_pages").option("spaces", "s1,s2").load()
    assert nodes.count() == 2
    listed = {None: (["s1"], "more"), "more": (["s2"], None)}
    spark.dataSource.register(wiki.paged(lambda space, cursor: pages[space, cursor], "all_pages", lambda cursor: listed[cursor]))
    assert spark.read.format("all_pages").load().count() == 2
    titles = spark.createDataFrame([("n2", "found")], "node_token string, title string")
    assert sorted(r.name for r in wiki.discovered(nodes, titles).collect()) == ["found", "t"]


def test_list_of_documents(spark):
    got = wiki.from_list(spark, [{"url": "https://h.example/sheets/a"}, {"url": "nothing"}, {"url": "https://h.example/docx/b", "ext": "pdf", "name": "n"}]).collect()
    assert [(r.token, r.ext, r.name) for r in got] == [("a", "xlsx", None), ("b", "pdf", "n")]


def test_chunk_files_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("doc one", 0, "i0", 3, "a\nb", [1.0]), ("doc one", 1, "i1", 1, " ", None), ("../out", 0, "i2", 1, "x", None)], "doc_name string, chunk_index int, chunk_id string, char_count int, content string, embedding array<float>")
    layout.write_chunk_files(c, str(tmp_path / "r"))
    assert sorted((r.doc_name, r.chunk_index, r.content) for r in layout.chunk_files(spark, str(tmp_path / "r")).collect()) == [("doc_one", 0, "a\nb"), ("out", 0, "x")]
    index = json.loads((tmp_path / "r/doc_one/chunks_index.json").read_text())
    assert index["total_chunks"] == 2 and [x["chunk_id"] for x in index["chunks"]] == ["i0", "i1"]
    assert json.loads((tmp_path / "r/doc_one/embeddings/chunk_0000.json").read_text()) == {"chunk_index": 0, "embedding": [1.0]} and not (tmp_path / "r/doc_one/embeddings/chunk_0001.json").exists()
    assert json.loads((tmp_path / "r/out/doc_info.json").read_text())["filename"] == "../out" and sorted(p.name for p in tmp_path.iterdir()) == ["r"]


def test_bad_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in layout.json_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()) == [1, 2]


def test_schemas(spark):
    assert len(schemas.ENTITIES) == 22 and all(schemas.schema(e).fields for e in schemas.ENTITIES)
    assert layout.or_empty(spark, "/nowhere", schemas.schema("chunk")).count() == 0


def test_options(tmp_path):
    (tmp_path / "o.yml").write_text("chunk_size: 5\n")
    assert Options.load(tmp_path / "o.yml", dims=3) == Options(chunk_size=5, dims=3)
    with pytest.raises(ValueError, match="unknown"):
        Options.load(nothing=1)


def test_store_publishes_all_or_nothing(spark, tmp_path):
    store = Store(str(tmp_path / "s"))
    a, b = spark.range(2), spark.range(3)
    store.publish({"a": a, "b": b}, "1")
    assert store.ready() and store.read(spark, "a").count() == 2
    broken = spark.range(1).select(F.raise_error(F.lit("x")).alias("y"))
    with pytest.raises(Exception, match="x"):
        store.publish({"a": spark.range(9), "b": broken}, "2")
    assert store.read(spark, "a").count() == 2 and not store.ready()
    assert json.loads((tmp_path / "s/.ready").read_text())["status"] == "error"
    store.publish({"a": spark.range(5)}, "3")
    assert store.read(spark, "a").count() == 5 and store.read(spark, "b").count() == 3 and store.wait(0)
    assert store.sweep() > 0 and not store.stale() and store.read(spark, "b").count() == 3
    store.drop()
    assert store.read(spark, "a") is None


def test_lock(tmp_path):
    with lock(tmp_path / "l"), pytest.raises(RuntimeError, match="held"), lock(tmp_path / "l"):
        pass


def docs(spark, rows):
    return spark.createDataFrame([(n, "Word", t, None, None) for n, t in rows], "doc_name string, doc_format string, text string, space_id string, source_url string")


def test_pipeline_is_incremental(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "s"), Options(chunk_size=20, chunk_overlap=0))
    p.run(docs(spark, [("a", "Alpha beta. " * 5), ("b", "Gamma")]))
    first = p.store.read(spark, "doc_chunks").cache()
    assert first.filter("doc_name = 'a'").count() > 1 and first.filter("embedding is null").count() == 0
    p.run(docs(spark, [("a", "short"), ("b", "Gamma"), ("c", None)]))
    now = p.store.read(spark, "doc_chunks")
    assert sorted((r.doc_name, r.chunk_text) for r in now.collect()) == [("a", "short"), ("b", "Gamma")]
    assert p.store.read(spark, "entities") is not None
    assert report(results(docs(spark, [("a", ""), ("c", "")]), now)).first().asDict() == {"total": 2, "success": 1, "skipped": 1, "failed": 0, "chunks": 1}
    assert now.filter("has_images or image_count > 0 or images_json <> '[]'").count() == 0
    client = search.Client(spark, p.store, lambda texts: hashing_model()(texts))
    assert client.search("short", 1).first().doc_name == "a"
    assert client.search("short", 5, doc_name="b").count() == 1
    with pytest.raises(LookupError):
        search.Client(spark, Store(str(tmp_path / "none")), hashing_model()).search("x")
    with pytest.raises(ValueError, match="unknown"):
        p.run(docs(spark, []), steps=["nothing"])
    assert all(x.startswith(("warn", "fatal")) for x in doctor(str(tmp_path)))


def test_documents_that_share_a_name(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "s"), Options(chunk_size=20, chunk_overlap=0))
    held = lambda: sorted((r.doc_name, r.chunk_text) for r in p.store.read(spark, "doc_chunks").collect())
    known = lambda: sorted(r.doc_name for r in p.store.read(spark, "manifest").collect())
    p.run(docs(spark, [("m", "one"), ("m", "two"), ("x", "other")]), steps=["process", "store"])
    p.run(docs(spark, [("m", "one"), ("m", "new"), ("m", "third"), ("x", "other")]), steps=["process", "store"])
    assert held() == [("m", "new"), ("m", "one"), ("m", "third"), ("x", "other")] and known() == ["m", "x"]
    p.run(docs(spark, [("m", "third"), ("m", "new"), ("x", "other")]), steps=["process", "store"])
    assert held() == [("m", "new"), ("m", "third"), ("x", "other")]


def test_failed_vectors_are_made_up_for(spark, tmp_path):
    def failing():
        def embed(texts):
            if any("bad" in t for t in texts):
                raise ValueError("bad")
            return hashing_model()(texts)

        return embed

    p = Pipeline(spark, str(tmp_path / "s"), Options(embedding_batch=1))
    both = docs(spark, [("a", "good text"), ("b", "bad text"), ("c", None)])
    p.run(docs(spark, [("b", "fine")]), steps=["process", "store"])
    p.run(both, steps=["process", "store"], load=failing)
    held = lambda: sorted((r.doc_name, r.chunk_text, r.embedding is None) for r in p.store.read(spark, "doc_chunks").collect())
    old = {r.doc_name: r.hash for r in p.store.read(spark, "manifest").collect()}
    assert held() == [("a", "good text", False), ("b", "fine", False)]  # what failed keeps its old rows and hash
    assert {r.doc_name: r.status for r in p.store.read(spark, "results").collect()} == {"a": "success", "b": "failed", "c": "skipped"}
    p.run(both, steps=["process", "store"])
    assert held() == [("a", "good text", False), ("b", "bad text", False)]
    assert {r.doc_name: r.hash for r in p.store.read(spark, "manifest").collect()}["b"] != old["b"]
    assert sorted(r.doc_name for r in p.store.read(spark, "manifest").collect()) == ["a", "b", "c"]


def test_stream_equals_batch(spark, data, tmp_path):
    schema = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").schema.simpleString()[7:-1].replace(":", " ")
    (tmp_path / "in").mkdir()
    import shutil

    shutil.copy(f"{data}/documents.parquet", tmp_path / "in/1.parquet")
    s = ingest.chunk_stream(ingest.documents(spark, str(tmp_path / "in"), schema), "doc_id", "text")
    ingest.store_stream(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    from quire.operators.chunks import chunked

    want = chunked(spark.read.parquet(f"{data}/documents.parquet"), "doc_id", "text").count()
    assert spark.read.parquet(str(tmp_path / "out")).count() == want


def test_windowed_stream(spark, data, tmp_path):
    e = spark.read.parquet(f"{data}/events.parquet")
    (tmp_path / "in").mkdir()
    e.write.mode("overwrite").parquet(str(tmp_path / "in/e"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in/*"))
    q = ingest.windowed_counts(stream, "ts", "event_type").writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert 0 < spark.table("w").agg(F.sum("n")).first()[0] <= e.count()


def test_image_names_fall_back(spark):
    df = spark.createDataFrame([("good", "系统架构", ""), ("bad", "系统架构", ""), ("short", "系统架构", "")], "context string, context_before string, context_after string")

    def load():
        def client(prompt):
            if prompt == "bad":
                raise TimeoutError
            return "“登录 界面！”\nbecause" if prompt == "good" else "x"

        return client

    assert {r.context: r.name for r in naming.named(df, load).collect()} == {"good": "登录界面", "bad": "系统架构", "short": "系统架构"}
    assert {r.name for r in naming.named(df).collect()} == {"系统架构"}


def test_retries():
    calls, pauses = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return 7

    assert retried(call, sleep=pauses.append) == 7 and pauses == [2.0, 4.0]
    with pytest.raises(KeyError):
        retried(lambda: {}["x"], sleep=pauses.append)
    with pytest.raises(ConnectionError):
        retried(lambda: (_ for _ in ()).throw(ConnectionError()), tries=2, sleep=pauses.append)


class Exports:
    """A service whose answers are told by the token."""

    def __init__(self):
        self.asked = {}

    def create(self, token, doc_type, ext):
        if token == "gone":
            raise KeyError(token)
        return token

    def ask(self, task):
        n = self.asked[task] = self.asked.get(task, 0) + 1
        if task == "flaky" and n == 1:
            raise ConnectionError
        return {"slow": "pending", "refused": "failed"}.get(task, "done" if n > 2 else "pending")

    def fetch(self, task):
        return docx()


def test_exports(spark, tmp_path):
    from quire.operators import exports

    e = spark.createDataFrame([(t, "docx", "docx", t.title(), "u", "s", "1") for t in ("fine", "flaky", "gone", "refused", "slow")], "token string, doc_type string, ext string, name string, url string, space_id string, obj_edit_time string")
    quick = lambda *a, **k: None
    got = {r.token: r.status for r in exports.exported(e, Exports, str(tmp_path / "in"), sleep=quick).collect()}
    assert got == {"fine": "downloaded", "flaky": "downloaded", "gone": "failed", "refused": "failed", "slow": "timed out"}
    assert sorted(p.name for p in (tmp_path / "in").iterdir()) == ["Fine.docx", "Flaky.docx"]


def test_files_to_tables(spark, tmp_path, monkeypatch):
    """Entries are exported, parsed, chunked with their images, stored and put into the graph; a second run does nothing."""
    from quire.operators import exports

    monkeypatch.setattr(exports, "FIRST", 0.0)
    real = exports.exported
    monkeypatch.setattr(exports, "exported", lambda e, load, folder: real(e, load, folder, first=0.0, pause=0.0, sleep=lambda s: None))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "old.doc").write_bytes(b"x")
    (folder / "broken.docx").write_bytes(b"x")
    e = spark.createDataFrame([(t, "docx", "docx", t, "u", "s", "1") for t in ("fine", "gone")], "token string, doc_type string, ext string, name string, url string, space_id string, obj_edit_time string")
    p = Pipeline(spark, str(tmp_path / "s"))
    p.run(steps=["download", "process", "store", "graph"], entries=e, export=Exports, folder=str(folder))
    rows = {r.doc_name: r for r in p.store.read(spark, "doc_chunks").collect()}
    assert set(rows) == {"fine"} and rows["fine"].has_images and rows["fine"].image_count == 1
    assert json.loads(rows["fine"].images_json)[0]["original_filename"] == "img_001_image1.png"
    assert {r.doc_name: r.status for r in p.store.read(spark, "results").collect()} == {"fine": "success", "old": "failed", "broken": "failed"}
    assert [r.token for r in p.store.read(spark, "downloads").collect()] == ["fine"]
    assert {"entities", "relations", "graph_chunks", "graph_manifest"} <= set(p.store.current())
    before = p.store.read(spark, "doc_chunks").first().doc_timestamp
    calls = []

    def extractor(text):
        calls.append(text)
        raise RuntimeError("not to be asked")

    p.run(steps=["download", "process", "store", "graph"], entries=e.filter("token = 'fine'"), export=Exports, folder=str(folder), extractor=extractor)
    assert p.store.read(spark, "doc_chunks").first().doc_timestamp == before
    assert p.store.read(spark, "graph_found").filter("kind = 'error'").count() == 0
    p.write_files(str(tmp_path / "files"))
    assert (tmp_path / "files/fine/chunks_index.json").exists()
    p.run(docs(spark, [("new", "Words")]), steps=["process", "store"], reset=True)
    assert [r.doc_name for r in p.store.read(spark, "doc_chunks").collect()] == ["new"]


def test_graph_of_changed_documents_only(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "s"), Options(graph_window=5, graph_overlap=1))
    p.run(docs(spark, [("a", "Alpha meets Bravo in Delta today again"), ("b", "Charlie alone"), ("c", "Golfer gone")]))
    names = lambda: {r.entity_name for r in p.store.read(spark, "entities").collect()}
    pairs = lambda: {(r.source_entity, r.target_entity) for r in p.store.read(spark, "relations").collect()}
    assert names() == {"Alpha", "Bravo", "Delta", "Charlie", "Golfer"} and ("Alpha", "Bravo") in pairs()
    assert p.store.read(spark, "graph_chunks").filter("doc_name = 'a'").count() == 2
    assert p.store.read(spark, "entities").filter("embedding is null or source_doc = ''").count() == 0

    def failing(text):
        from quire.operators import graph

        if "Echoes" in text:
            raise RuntimeError("no")
        return graph.capital_words(text)

    p.run(docs(spark, [("a", "Foxtrot meets Bravo"), ("b", "Echoes here"), ("c", None)]), extractor=failing)
    assert names() == {"Foxtrot", "Bravo"} and pairs() == {("Foxtrot", "Bravo")}
    assert sorted(r.doc_name for r in p.store.read(spark, "graph_manifest").collect()) == ["a", "b"]
    first = {r.doc_name: r.hash for r in p.store.read(spark, "graph_manifest").collect()}
    p.run(steps=["graph"])
    assert names() == {"Foxtrot", "Bravo", "Echoes"}
    assert {r.doc_name: r.hash for r in p.store.read(spark, "graph_manifest").collect()}["b"] != first["b"]


def test_command_line(spark, tmp_path, capsys):
    from quire.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.docx").write_bytes(docx())
    (tmp_path / "o.yml").write_text("chunk_size: 50\nchunk_overlap: 0\n")
    assert main(["daemon", "--root", str(tmp_path / "s"), "--folder", str(tmp_path / "in"), "--config", str(tmp_path / "o.yml"), "--every", "0", "--times", "2", "--tries", "1"]) == 0
    assert Store(str(tmp_path / "s")).read(spark, "doc_chunks").count() == 2  # by the size of the file
    assert main(["run", "--root", str(tmp_path / "s"), "--folder", str(tmp_path / "none"), "--tries", "1"]) == 2
    assert main(["doctor", "--root", str(tmp_path / "s")]) == 0 and main(["sweep", "--root", str(tmp_path / "s")]) == 0
    assert main(["list", "--urls", "https://h.example/docx/abc, nothing"]) == 0 and "abc" in capsys.readouterr().out


def test_schemas_of_published_tables(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path / "s"))
    p.run(docs(spark, [("a", "Alpha Bravo")]))
    for name, entity, later in (("doc_chunks", "doc_chunks", {"id", "created_at", "updated_at"}), ("entities", "entity", {"created_at"}), ("relations", "relation", {"created_at"}), ("graph_chunks", "graph_chunk", {"created_at"})):
        have = {f.name: f.dataType for f in p.store.read(spark, name).schema}
        want = {f.name: f.dataType for f in schemas.schema(entity) if f.name not in later}
        assert have == want, name
    assert p.store.table(spark, "nothing", schemas.schema("entity")).count() == 0
