"""Pieces, sentences, tokens, personal information, residue."""

from __future__ import annotations

import base64
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import bpe, pieces, pii, residue, sentences

ODD = [None, "", " \n　", "a", "🚀" * 30, "x" * 20_000, "词。" * 3_000, "a" * 999 + " b", "ก ข" * 600, "x. Y."]


def texts(spark, values, **more):
    """Rows with clashing extra columns, one of them twice."""
    rows = [(i, v, "e", 1) for i, v in enumerate(values)] + [(0, values[0], "e", 1), (None, values[-1], "e", 1)]
    return spark.createDataFrame(rows, "id long, text string, piece string, start_pos int")


# ---- pieces


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 。\n,.中́🚀", max_size=300), st.integers(8, 40), st.integers(0, 7))
def test_pieces_hold_the_whole_text(text, limit, overlap):
    cut = pieces.cut_text(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e in cut) == text
    assert all(0 < e - s <= limit and 0 <= c - s <= overlap for s, c, e in cut)
    assert (len(cut) > 1) == (len(text) > limit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["ก็", "ที่", "क्षि", "मी", "بِّ", "e" + "́" * 15, "🚀", "a", " ", "。", "👩‍🚀"]), max_size=160), st.integers(20, 60), st.integers(0, 19))
def test_pieces_of_marked_scripts(parts, limit, overlap):
    text = "".join(parts)
    cut = pieces.cut_text(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e in cut) == text
    assert all(0 < e - s <= limit and 0 <= c - s <= overlap for s, c, e in cut)


def test_stacked_marks_keep_the_limit():
    text = ("e" + "́" * 15) * 200
    assert all(e - s <= 1000 and c - s <= 200 and text[s] == "e" for s, c, e in pieces.cut_text(text))


def test_cuts_fall_on_the_strongest_boundary():
    text = "One two three. Four five six.\n\nSeven eight nine. Ten."
    assert [text[c:e].strip() for _, c, e in pieces.cut_text(text, 32, 0)] == ["One two three. Four five six.", "Seven eight nine. Ten."]
    assert [e - c for _, c, e in pieces.cut_text("abcdefghij", 4, 0)] == [4, 4, 2]


def test_overlap_starts_at_a_boundary():
    text = "Alpha beta. Gamma delta. Epsilon zeta. Eta theta. Iota kappa."
    for s, c, e in pieces.cut_text(text, 30, 15)[1:]:
        assert s < c and text[s - 1].isspace() and e - s <= 30


def test_pieces_of_odd_rows(spark):
    df = texts(spark, ODD)
    got = pieces.split_oversized(df, "id", "text").collect()
    for i, t in enumerate(ODD):
        own = sorted((r for r in got if r.id == i), key=lambda r: r.piece_no)
        if i:
            assert "".join(r.piece[r.core_start - r.start_pos :] for r in own) == (t or "")
        assert all(len(r.piece) <= 1000 and r.piece == t[r.start_pos : r.end_pos] for r in own)
    assert pieces.split_oversized(df.limit(0), "id", "text").count() == 0
    with pytest.raises(ValueError, match="overlap"):
        pieces.split_oversized(df, "id", "text", 10, 10)


# ---- sentences

MARKED = [
    "Dr. A. B. Smith paid 3.50 to Acme Inc. in v1.2.3.| See Fig. 4 and No. 7, e.g. a.txt at https://x.example/a.b?c=d!e ok.| The end.",
    "It closes at 6 p.m.| Afterwards we left.| It opens at 9 a.m. and stays.| He brought pens, etc.| Then more.",
    '"Wait?", he said.| "It broke." |That is all.| "Ready?" and he went.| Wait... and then.| Done… |Next!?| ok.',
    "Am 21. Oktober kam z. B. Herr Dr. Vogt, d. h. ca. 3 Leute.| „Gut?“ und weiter.| Ende.",
    "Según la Sra. Ruiz, art. 5 y pág. 7.| ¿Sí?| «¡No!», dijo.| p. ej. esto.",
    "他问：“能按期吗？”，没有回答。|“好了！”|随后离开……|然后见附录A.2和.pdf文件。|结束.|Next项目。",
    "下降6.7%.|跟进Temceze.|Marcedak项目.|INC-40837号.|norhin_1.v0.pdf已归档到.pdf和.DOCX、a.b.txt里.|结束",
    "「もう安定？」と尋ねた。|至急！|止めた｡|終わり",
    "रुकिए! |डॉ. मीरा आईं।| ठीक है।",
    "انتبه! |ذكر د. سامي ذلك؟| نعم.",
    "ฝ่ายคุณภาพ |ทำงาน 3 ครั้ง |เวลา 10.30 น. ที่นี่",
    "la versión\n1.14.20.| Una. |El\n7. punto.|\n\n1.2. Next",
    "# 1. Title|\n \n3. Heading one|\n\nline one\nline two. |Three|\r\n\r\nfour",
]


@pytest.mark.parametrize("marked", MARKED)
def test_marked_sentences(spark, marked):
    text = marked.replace("|", "")
    got = sentences.sentences(spark.createDataFrame([(1, text)], "id int, text string")).orderBy("sentence_no").collect()
    assert [r.sentence for r in got] == [s.strip() for s in marked.split("|")]
    assert all(text[r.start_pos : r.end_pos] == r.sentence for r in got)


def test_sentences_of_odd_rows(spark):
    df = texts(spark, ODD)
    got = sentences.sentences(df).collect()
    for i, t in enumerate(ODD):
        own = sorted((r for r in got if r.id == i), key=lambda r: (r.sentence_no, r.start_pos))
        assert all(t[r.start_pos : r.end_pos] == r.sentence == r.sentence.strip() for r in own)
        kept = "".join("".join(r.sentence.split()) for r in (own if i else own[: len(own) // 2]))
        assert kept == "".join((t or "").split())
    assert sum(r.id == 6 for r in got) == 3000
    assert sentences.sentences(df.limit(0)).count() == 0


# ---- tokens


@pytest.fixture(scope="module")
def other():
    import tiktoken

    with open(bpe.vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash():
    keys = [bytes([i % 256, i // 256]) * (1 + i % 3) + str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot_of.tolist()) == list(range(5000))
    assert table.lookup(keys).tolist() == list(range(5000))
    assert set(table.lookup([b"no", b"", b"x" * 99]).tolist()) == {-1}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_another_library(other, text):
    offsets, ids = bpe.encoder(bpe.vocabulary()).encode_batch([text, None, "", text])
    want = other.encode_ordinary(text)
    assert ids.tolist() == want * 2
    assert offsets.tolist() == [0, len(want), len(want), len(want), 2 * len(want)]


def test_ids_of_real_texts(spark, data, other):
    got = bpe.encode_corpus(spark.read.parquet(f"{data}/documents.parquet")).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    assert len(got) == len(text)
    assert all(r.ids == other.encode_ordinary(text[r.doc_id] or "") for r in got)
    assert all(b"".join(other.decode_single_token_bytes(i) for i in r.ids).decode() == (text[r.doc_id] or "") for r in got)


def test_ids_of_odd_rows(spark, other):
    df = texts(spark, [*ODD, "<|endoftext|>"])
    got = bpe.encode_corpus(df.withColumn("ids", F.lit(1)), "id").collect()
    assert sorted(len(r.ids) for r in got if r.id == 0) == [0, 0]
    assert [r.ids for r in got if r.id == 10] == [other.encode_ordinary("<|endoftext|>")]
    assert df.select(bpe.count("text").alias("n")).agg(F.sum("n")).first()[0] == sum(len(r.ids) for r in got)
    assert bpe.encode_corpus(df.limit(0), "id").count() == 0


@pytest.mark.skipif(not os.path.exists(bpe.vocabulary("byte_bpe_multi_50k")), reason="no second vocabulary")
def test_another_vocabulary(spark):
    got = bpe.encoder(bpe.vocabulary("byte_bpe_multi_50k")).encode_batch(["数据 data"])
    assert len(got[1]) > 0


# ---- personal information

SAID = [
    ("审批人：奚安辰（kasper-tevefo@nordvale.test）。", {"NAME": ["奚安辰"], "EMAIL": ["kasper-tevefo@nordvale.test"]}),
    ("发票寄江岚市石湾区槐荫路71号11栋1101室即可。", {"ADDRESS": ["江岚市石湾区槐荫路71号11栋1101室"]}),
    ("如有疑问请联系褚宇华，电话１８８００００５８０６。", {"NAME": ["褚宇华"], "PHONE": ["１８８００００５８０６"]}),
    ("身份证999539 19511124 7886已核验，订单号885891595496保持不变。", {"ID_NUMBER": ["999539 19511124 7886"]}),
    ("Mr. Lydia R. Hujepol asked to replace passport X07819685 in the file.", {"NAME": ["Lydia R. Hujepol"], "ID_NUMBER": ["X07819685"]}),
    ("Questions go to sales+ven[at]quillbox[dot]example until Monday.", {"EMAIL": ["sales+ven[at]quillbox[dot]example"]}),
    ("Please call Dario-Konrad Gozuze on +1 555 016 0124 about it.", {"NAME": ["Dario-Konrad Gozuze"], "PHONE": ["+1 555 016 0124"]}),
    ("New address since May: Flat 6, 332 Lantern\nSt., Port Averin ZZ14 5QX.", {"ADDRESS": ["Flat 6, 332 Lantern\nSt., Port Averin ZZ14 5QX"]}),
    ("Ausweis 0147 5945 4553 gehört zu Adele Bothipol, Auftrag 880836586382658804.", {"ID_NUMBER": ["0147 5945 4553"], "NAME": ["Adele Bothipol"]}),
    ("Die Lieferung geht an Lindenhofweg 6, 00152 Steinach.", {"ADDRESS": ["Lindenhofweg 6, 00152 Steinach"]}),
    ("El documento 08.918.280-L pertenece a D. Hobixa.", {"ID_NUMBER": ["08.918.280-L"], "NAME": ["D. Hobixa"]}),
    ("桐野千尋様の登録番号はX72574083です。送付先は浅瀬市鈴原11丁目22-11です。", {"NAME": ["桐野千尋"], "ID_NUMBER": ["X72574083"], "ADDRESS": ["浅瀬市鈴原11丁目22-11"]}),
    ("ذكر د. سامي الفيلمور أن الرقم على +966 00 8389 284.", {"NAME": ["سامي الفيلمور"], "PHONE": ["+966 00 8389 284"]}),
    ("Use the @retry34 decorator on job 881467776608. Release 10.20.40.22, 2024-05-17, SN-882320842840.", {}),
    ("公式A@B表示第719行，批次INC-65331，文件a_1.v2.docx，值班同事随后联系管理员。", {}),
]


def test_mentions_of_marked_texts(spark):
    # the corpus around gives the labelers something to agree on
    rows = [(i, t) for i, (t, _) in enumerate(SAID)]
    df = spark.createDataFrame([("s", i + 100 * k, t) for k in range(20) for i, t in rows], "src string, row_id long, text string")
    got = pii.mentions(df).filter("row_id < 100").collect()
    for i, (t, want) in enumerate(SAID):
        found = {}
        for r in sorted((r for r in got if r.row_id == i), key=lambda r: r.start_pos):
            found.setdefault(r.pii_type, []).append(t[r.start_pos : r.end_pos])
        assert found == want, t


def test_redaction_keeps_the_rest(spark):
    df = spark.createDataFrame([("s", i, t) for i, (t, _) in enumerate(SAID)] + [("s", 900, None), ("s", 901, "")], "src string, row_id long, text string")
    got = {r.row_id: r.text for r in pii.redacted(df).collect()}
    assert got[0] == "审批人：<NAME>（<EMAIL>）。" and got[900] is None and got[901] == ""
    assert got[len(SAID) - 1] == SAID[-1][0]


# written after the cues were chosen, without a look at any table
FREE = [
    ("Nobody expected Lindiwe Mahlangu to resign.", {"Lindiwe Mahlangu"}), ("The award was presented by Sergio Castellanos.", {"Sergio Castellanos"}), ("Ewa Nowicka joined the board in spring.", {"Ewa Nowicka"}), ("Please contact Hans Grubermann for a key.", {"Hans Grubermann"}),
    ("Mrs. Eleanor Whitcombe paid the deposit.", {"Eleanor Whitcombe"}), ("A reply from Nikhil Bhattacharya is due.", {"Nikhil Bhattacharya"}), ("Charlotte Ferris and her team moved out.", {"Charlotte Ferris"}), ("I told Robert Vance about the delay.", {"Robert Vance"}),
    ("Der Vertrag wurde von Jutta Hoffmeister geprüft.", {"Jutta Hoffmeister"}), ("刘建军表示同意。", {"刘建军"}), ("请联系何雨桐，她在二楼。", {"何雨桐"}), ("赵立新提交了申请。", {"赵立新"}), ("鈴木一郎は欠席です。", {"鈴木一郎"}), ("山本美咲様へ送ります。", {"山本美咲"}),
    ("The Grand Canal runs past the Old Market Hall.", set()), ("Quality Assurance checks every Release Candidate.", set()), ("常用的命令见附录。", set()), ("平台已经恢复。", set()), ("Our Privacy Policy was updated.", set()),
]


def test_names_in_free_sentences(spark, data):
    known = spark.read.parquet(f"{data}/doc_chunks.parquet").select(F.lit("t").alias("src"), F.col("id").alias("row_id"), F.col("chunk_text").alias("text"))
    free = spark.createDataFrame([("free", i, t) for i, (t, _) in enumerate(FREE)], "src string, row_id long, text string")
    found = {}
    for r in pii.mentions(known.unionByName(free)).filter("src = 'free' and pii_type = 'NAME'").collect():
        found.setdefault(r.row_id, set()).add(FREE[r.row_id][0][r.start_pos : r.end_pos])
    want = [(i, n) for i, (_, names) in enumerate(FREE) for n in names]
    got = [(i, n) for i, names in found.items() for n in names]
    right = len(set(want) & set(got))
    print(f"free sentences: {right} of {len(want)} names, {len(got)} found", sorted(set(want) ^ set(got)))
    assert right >= 0.6 * len(want) and right >= 0.7 * len(got)


def test_mentions_of_odd_rows(spark):
    df = texts(spark, ODD).select(F.lit("s").alias("src"), F.col("id").alias("row_id"), "text", F.lit(1).alias("votes"))
    assert pii.mentions(df).count() == 0
    assert pii.mentions(df.limit(0)).count() == 0


def test_gates_are_as_wide_as_their_patterns():
    kinds = lambda t: [(t[a:b], k) for a, b, k, _, _ in pii.candidates(t)]
    assert kinds("write to ana at example dot\ncom") == [("ana at example dot\ncom", "EMAIL")]
    assert kinds("ana AT example\tDOT com") == [("ana AT example\tDOT com", "EMAIL")]
    assert ("山田太郎", "NAME") in kinds("山田太郎氏") and ("山田太郎", "NAME") in kinds("山田太郎殿")


def test_labelers_are_weighed():
    counts = [("PHONE", "1,1,1,1,0,0", 500), ("PHONE", "1,1,1,0,0,0", 300), ("PHONE", "-1,0,1,0,-1,0", 200), ("PHONE", "-1,0,0,0,-1,0", 50)]
    p = pii.likelihoods(counts)
    assert p["PHONE", "1,1,1,1,0,0"] > 0.9 and p["PHONE", "1,1,1,0,0,0"] > 0.9 and p["PHONE", "-1,0,1,0,-1,0"] < 0.1


def test_classifier_on_held_out_rows():
    r = random.Random(1)
    rows = [(t, k) for t, k in (("电话{}，", 1), ("订单号{}与", 0), ("call {} now", 1), ("build {}.", 0)) for _ in range(100)]
    made = [(t.format("555-01%02d" % r.randrange(99)), k) for t, k in rows]
    feats = [pii.features(t, t.index("5"), t.index("5") + 8, "PHONE", (1, 0, 0, 0, 0, 0), "x") for t, _ in made]
    import numpy as np

    w = pii.fit(feats[::2], np.array([k for _, k in made[::2]], dtype=float))
    right = sum((w[f].sum() > 0) == bool(k) for f, (_, k) in zip(feats[1::2], made[1::2]))
    assert right >= 0.95 * len(made[1::2])


# ---- residue

CASES = [
    "尊敬的{{ customer }}：", "Scope: ${doc_title}", "Long real content here that says something. This page is owned by __OWNER__ and was last changed on [TODO: version].", "签字：____（负责人）____", "Dear &lt;owner&gt;,", "项目%(version_no)s的目标", "范围：XX负责人XX",
    "504 Gateway Time-out\nHome > Help center", "页面不存在", "© Rosfomir 文档中心 本页面需要开启JavaScript才能正常使用。 首页 | 搜索 | 登录", "This app requires JavaScript. Turn it on and reload.", "Lorem ipsum dolor sit amet consectetur elit.", "正文内容正文内容，占位占位占位。", "Die Seite wurde nicht gefunden.", "YOUR SESSION HAS EXPIRED. PLEASE SIGN IN AGAIN.",
]
FINE = [
    None, "", "​", "To greet a user, write {{ user_name }} in the mail body; the renderer replaces it.", "The command `cp ${HOME}/a.yaml /srv` copies the settings.", "Set {a, b, c} has 3 subsets, and [1] points to the notes.", "def load(path):\n    return [row for row in open(path) if row]",
    "旧链接返回“页面不存在”属于预期，系统已为606个常用地址配置跳转。", "During the incident the proxy returned 502 Bad Gateway for 12 minutes until a node was replaced.", "The portal needs JavaScript enabled, which 793 of the tested browsers allow by default.", "Designers often put lorem ipsum into a layout first; we removed it in week 3.", "设计稿里的占位文字已经全部替换。", "A plain heading", "TODO items older than 9 days are closed automatically.",
]


def test_residue_of_marked_texts(spark):
    every = CASES + FINE
    df = spark.createDataFrame([(i, t, "https://h.example/x") for i, t in enumerate(every)], "doc_id long, text string, source_url string")
    got = {r.doc_id for r in residue.residue(df).collect()}
    assert got == set(range(len(CASES))), [every[i] for i in got ^ set(range(len(CASES)))]
    kept = residue.without_residue(df.withColumn("_gone", F.lit(1)).withColumn("host", F.lit(2)))
    assert kept.count() == len(FINE) and "host" in kept.columns


def test_recurrent_lines_are_no_content(spark):
    footer = "Prepared by the knowledge base team for internal readers only, all rights reserved."
    rows = [(i, f"Page {i} says something of its own about topic {i}.\n{footer}", "https://h.example") for i in range(30)] + [(99, f"404 Not Found\n{footer}", "https://h.example"), (None, "404 Not Found", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source_url string")
    assert [r.doc_id for r in residue.residue(df).collect()] == [99]
    assert residue.residue(df.limit(0)).count() == 0


def say(i):
    """A sentence that no other i has; digits do not count in lines."""
    return f"The chapter about {chr(97 + i % 26)}{chr(97 + i // 26)}ology says something of its own."


def test_evidence_that_recurs_beside_content_is_boilerplate(spark):
    h = "https://h.example/x"
    footer = "Please sign in again"
    rows = [(i, f"{say(i)}\n{footer}", h) for i in range(30)]
    rows += [(40, f"Release notes\n{footer}", h), (41, "404 Not Found", h)] + [(50 + i, "Access denied", h) for i in range(12)]
    got = {r.doc_id for r in residue.residue(spark.createDataFrame(rows, "doc_id long, text string, source_url string")).collect()}
    assert got == {41, *range(50, 62)}


def test_placeholders_of_the_frame_of_a_site(spark):
    rows = [(i, f"{say(i)}\nOwned by {{{{ site_owner }}}}", "https://a.example") for i in range(20)]
    rows += [(100 + i, say(i) + ("\nOwned by {{ site_owner }}" if i < 5 else ""), "https://b.example") for i in range(20)]
    rows += [(200 + i, "Owned by {{ site_owner }}", "https://c.example") for i in range(9)]
    got = {r.doc_id for r in residue.residue(spark.createDataFrame(rows, "doc_id long, text string, source_url string")).collect()}
    assert got == {*range(100, 105), *range(200, 209)}


def test_lorem_with_made_up_words(spark):
    every = ["Cursus zarem ipsum vexil fugit gravo semper verona posuere zarem cursus elit.", "Replace the lorem ipsum before release."]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(every)], "doc_id long, text string, source_url string")
    assert [r.doc_id for r in residue.residue(df).collect()] == [0]


def made(pattern, rng):
    """A random string that a parsed pattern matches."""
    groups = {}

    def walk(items):
        text = ""
        for kind, arg in items:
            name = str(kind)
            if name == "LITERAL":
                text += chr(arg)
            elif name == "IN":
                k, x = rng.choice(arg)
                text += "ß" if str(arg[0][0]) == "NEGATE" else chr(x) if str(k) == "LITERAL" else chr(rng.randint(*x)) if str(k) == "RANGE" else "7"
            elif name == "MAX_REPEAT":
                for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))):
                    text += walk(arg[2])
            elif name == "BRANCH":
                text += walk(rng.choice(arg[1]))
            elif name == "SUBPATTERN":
                part = walk(arg[-1])
                groups[arg[0]] = part
                text += part
            elif name == "GROUPREF":
                text += groups[arg]
            elif name == "NOT_LITERAL":
                text += "ß"
            else:
                raise AssertionError(name)
        return text

    return walk(residue._parser.parse(pattern))


def test_no_pattern_matches_without_a_keyword(spark):
    rng, texts = random.Random(5), []
    for p in (*residue._SCRIPT, *residue._ERROR, *residue._FILLER):
        assert residue.keywords(p) and "" not in residue.keywords(p), p
        texts += ["Ab. " + made(p, rng) + " yz" for _ in range(60)]
    texts += [f"zz {w} and {w}." for w in residue._LOREM.split("|")] + ["enable联系我们javascript"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", residue.possible(F.col("t")).alias("may"))
    assert [r.t for r in df.filter("not may").collect()] == []
    assert [r.may for r in spark.createDataFrame([("标题和标题",), ("a site of one message",), ("",), (None,)], "t string").select(residue.possible(F.col("t")).alias("may")).collect()] == [False] * 4


def test_evidence_without_a_listed_keyword(spark):
    every = [
        "500 服务器内部错误", "系统内部错误", "程序异常", "文档已下架", "该文件已移动", "此页面无法访问", "会话已超时", "登录状态已超时", "链接已经过期", "文档已经删除", "访问太频繁", "下载失败", "打开失败", "浏览器已禁用脚本", "检测到脚本被禁用",
        "请在设置中打开脚本后刷新页面", "此处省略", "待编辑", "标题标题标题标题", "405 method not allowed", "410 gone", "erreur 404", "slow down and retry", "Tellus augue turpis egestas.",
    ]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(every)], "doc_id long, text string, source_url string")
    got = {r.doc_id for r in residue.residue(df).collect()}
    assert got == set(range(len(every))), [every[i] for i in set(range(len(every))) - got]
