"""Nearest vectors, near-duplicates, names, mixing, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import mix, names, nearest, neardup

# ---- vectors

DIMS = 64


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "k", 1.0) for i, v in rows], "id long, embedding array<float>, key string, similarity double")


def brute(rows, k):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == DIMS and np.isfinite(v).all() and np.any(v)]
    ids = np.array([i for i, _ in good])
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    s = x @ x.T
    np.fill_diagonal(s, -2)
    return {(int(ids[i]), int(ids[j])): s[i, j] for i in range(len(ids)) for j in sorted(range(len(ids)), key=lambda j: (-round(s[i, j], 9), ids[j]))[:k] if s[i, j] > -2}


def clustered(n, seed=0):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n // 4, DIMS))
    out = [(i, base[i % len(base)] + 0.25 * r.standard_normal(DIMS) * (i >= len(base))) for i in range(n)]
    return [(i, v * (0.5 if i % 3 else 8)) for i, v in out]


def test_all_close_pairs_are_found(spark):
    rows = clustered(800)
    got = {(r.id, r.other): r.similarity for r in nearest.most_similar(vectors(spark, rows), 5, 0.9, dims=DIMS, bucket_rows=50).collect()}
    want = {p: s for p, s in brute(rows, 5).items() if s >= 0.9}
    assert len(set(want) & set(got)) >= 0.97 * len(want) > 100
    assert all(abs(got[p] - s) < 1e-5 for p, s in want.items() if p in got)


def test_queries_reach_their_recall(spark):
    rows = clustered(1000, 1)
    got = {(r.id, r.other) for r in nearest.most_similar(vectors(spark, rows), 5, None, F.col("id") % 20 == 0, dims=DIMS, bucket_rows=200, probes=8, least_tables=8).collect()}
    want = {p for p in brute(rows, 5) if p[0] % 20 == 0}
    assert len(got & want) >= 0.9 * len(want)
    assert {p[0] % 20 for p in got} == {0}


@pytest.mark.parametrize(("name", "buckets"), [("doc_chunks", 25), ("lightrag_entities", 10)])
def test_topk_recall_on_the_tables(spark, data, name, buckets):
    """At the depth that 200,000 chunks and 80,000 entities have in p2_topk, with its probes and tables; every row is
    asked, as few are there."""
    v = spark.read.parquet(f"{data}/{name}.parquet").select("id", "embedding")
    rows = [(r.id, r.embedding) for r in v.collect() if r.embedding is not None and len(r.embedding) == 512 and np.isfinite(r.embedding).all() and np.any(r.embedding)]
    got = nearest.most_similar(v, 5, bucket_rows=len(rows) // buckets, probes=12, least_tables=3, rerank=12)
    mine = {}
    for r in got.collect():
        mine.setdefault(r.id, []).append(r.similarity)
    ids = [i for i, _ in rows]
    x = np.array([w / np.linalg.norm(w) for w in (np.array(e, dtype=np.float64) for _, e in rows)])
    s = x @ x.T
    np.fill_diagonal(s, -9)
    fifth = np.sort(s, axis=1)[:, -5]
    hit = sum(min(5, sum(y >= f - 1e-6 for y in mine.get(i, []))) for i, f in zip(ids, fifth))
    assert hit >= 0.9 * 5 * len(ids)


def test_tables_follow_from_the_similarity():
    assert nearest.tables_for(7, 0.9) == 4 < nearest.tables_for(7, 0.8) < nearest.tables_for(7, 0.7)
    assert abs(nearest.met_in_table(0.0, 1, 0) - nearest.UNRELATED) < 0.03
    with pytest.raises(ValueError, match="bucket_rows"):
        nearest.tables_for(20, 0.3)


def test_codes_are_near_their_rows():
    x = np.random.default_rng(0).standard_normal((50, DIMS)).astype(np.float32)
    import pyarrow as pa

    back = nearest.decoded(pa.array([c.tobytes() for c in nearest.codes(x)], pa.binary()), DIMS)
    assert np.abs(back - x).max() < 0.02


def test_hot_buckets_of_queries_lose_nothing(spark, monkeypatch):
    rows = clustered(400, 4)
    run = lambda: {(r.id, r.other) for r in nearest.most_similar(vectors(spark, rows), 5, None, F.col("id") % 20 == 0, dims=DIMS, bucket_rows=1000, probes=4).collect()}
    want = run()
    monkeypatch.setattr(nearest, "HOT", 40)
    assert run() == want and len(want) == 100


def test_unusable_vectors_take_no_part(spark):
    v = np.ones(DIMS)
    rows = [(1, v), (2, 3 * v), (3, None), (4, 0 * v), (5, v[:9]), (6, v * np.nan), (7, v * np.inf), (None, v), (2, 3 * v), (8, -v), (9, 1e30 * v)]
    got = {(r.id, r.other, round(r.similarity, 6)) for r in nearest.most_similar(vectors(spark, rows), 5, 0.9, dims=DIMS).collect()}
    assert got == {(a, b, 1.0) for a in (1, 2, 9) for b in (1, 2, 9) if a != b}
    assert nearest.most_similar(vectors(spark, []), 5, 0.9, dims=DIMS).count() == 0
    assert nearest.most_similar(vectors(spark, [(3, None)]), 5, dims=DIMS).count() == 0


def test_a_third_of_all_rows_is_one_vector(spark):
    rows = clustered(600, 2) + [(1000 + i, np.arange(1, DIMS + 1.0)) for i in range(300)]
    got = nearest.most_similar(vectors(spark, rows), 5, 0.9, dims=DIMS).filter("id >= 1000").collect()
    assert len(got) == 1500
    assert {r.other for r in got} == set(range(1000, 1006))


def test_hot_buckets_lose_nothing(spark, monkeypatch):
    rows = clustered(400, 3)
    want = {(r.id, r.other) for r in nearest.most_similar(vectors(spark, rows), 5, 0.9, dims=DIMS, bucket_rows=1000).collect()}
    monkeypatch.setattr(nearest, "HOT", 40)
    got = {(r.id, r.other) for r in nearest.most_similar(vectors(spark, rows), 5, 0.9, dims=DIMS, bucket_rows=1000).collect()}
    assert got == want


# ---- near-duplicates


def edited(r, text, edits):
    t = list(text)
    for _ in range(edits):
        t[r.randrange(len(t))] = r.choice("abcdefgh 词句")
    return "".join(t)


def corpus(seed=0):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(400)]
    out = []
    for g in range(40):
        base = " ".join(r.choice(words) for _ in range(60))
        out.append(base)
        out += [edited(r, base, r.randrange(0, 22)) for _ in range(3)]
    return out + ["  " + out[0].upper().replace(" ", "\n "), "短" * 300, "短" * 300, "short", "short", "", None, " " * 250]


def text_rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", b"y") for i, t in enumerate(texts)] + [(None, texts[0], "x", b"y")], "id long, text string, key string, regs binary")


def test_pairs_against_brute_force(spark):
    texts = corpus()
    got = {(r.id_a, r.id_b) for r in neardup.similar_pairs(text_rows(spark, texts), 0.75, 200).collect()}
    want = {(i, j) for i, a in enumerate(texts) for j in range(i + 1, len(texts)) if a and texts[j] and len(a) >= 200 and len(texts[j]) >= 200 and neardup.jaccard(a, texts[j]) >= 0.75}
    assert got == want and len(want) > 30


def test_groups_are_components(spark):
    texts = corpus(1)
    got = {r.id: (r.class_id, r.class_size) for r in neardup.groups(text_rows(spark, texts), 0.8).collect()}
    parent = list(range(len(texts)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    live = [i for i, t in enumerate(texts) if t is not None]
    for i in live:
        for j in live:
            if i < j and neardup.jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert set(got) == set(live)
    assert all(got[i][0] == find(i) for i in live)
    assert got[0][1] == sum(find(i) == find(0) for i in live)
    assert neardup.groups(text_rows(spark, ["a"]).limit(0)).count() == 0


def test_a_third_of_all_rows_is_one_text(spark):
    texts = corpus(2)[:80] + ["same text over and over " * 20] * 60
    got = neardup.groups(text_rows(spark, texts), 0.8).filter("class_id = 80").collect()
    assert len(got) == 60 and {r.class_size for r in got} == {60}


def test_long_runs_go_through_blocks(spark, monkeypatch):
    r = random.Random(5)
    base = " ".join("".join(r.choice("abcdefghijkl") for _ in range(6)) for _ in range(70))
    texts = [edited(r, base, 4) for _ in range(60)]
    want = {(x.id_a, x.id_b) for x in neardup.similar_pairs(text_rows(spark, texts), 0.75, 200).collect()}
    monkeypatch.setattr(neardup, "RUN", 8)
    # the workers must see the smaller limit too
    monkeypatch.setattr(neardup, "_paired", _paired_short)
    got = {(x.id_a, x.id_b) for x in neardup.similar_pairs(text_rows(spark, texts), 0.75, 200).collect()}
    assert got == want and len(want) > 500


def _paired_short(batches):
    from quire.llm import neardup as n

    n.RUN = 8
    try:
        yield from _REAL(batches)
    finally:
        n.RUN = 64


_REAL = neardup._paired


def test_bands_follow_from_the_threshold(spark):
    assert [neardup.rows_for(x) for x in (0.75, 0.8, 0.5)] == [6, 7, 3]
    with pytest.raises(ValueError, match="registers"):
        neardup.rows_for(0.01)
    texts = corpus(4)[:60]
    got = {(r.id_a, r.id_b) for r in neardup.similar_pairs(text_rows(spark, texts), 0.45, 200).collect()}
    want = {(i, j) for i, a in enumerate(texts) for j in range(i + 1, len(texts)) if len(a) >= 200 and len(texts[j]) >= 200 and neardup.jaccard(a, texts[j]) >= 0.45}
    assert got == want


def test_estimate_is_unbiased():
    r = random.Random(3)
    a = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))
    for share in (0.2, 0.5, 0.9):
        b = a[: int(3000 * share)] + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(int(3000 * (1 - share))))
        x, y = neardup.registers([neardup.canonical(a), b])[:, None]
        assert abs(neardup.estimate(x, y)[0] - neardup_jaccard_raw(a, b)) < 0.12


def neardup_jaccard_raw(a, b):
    x, y = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


# ---- names

ONE = [
    ["Agnes Sadonujo", "AGNES SADONUJO", "Agnes L. Sadonujo", "Sadonujo, Agnes", "agnes.sadonujo", "Dr. Agnes  Sadonujo ", "Agnse Sadonujo", "Agnes Sadonuju", "A. Sadonujo", "Sadonujo Agnes"],
    ["Benjamin Runebigo", "Ben Runebigo", "Runebigo, B."],
    ["Fusagoko Velvet Publishing Corp.", "Fusagoko Velvet Publ.", "The Fusagoko Velvet Publishing Group", "Velvet Publishing Fusagoko", "FUSAGOKO VELVET PUBLISHING CORP", "Fusagoko Velvet Pubblishing Corp.", "Fusagoko-Velvet-Publishing", "Fusagoko Velvet Publishing (HQ)"],
    ["Fusagoko Velvet Insurance Ltd", "Fusagoko Velvet Ins. Ltd"],
    ["Tijuzowe Urban Engineering LLC", "Tijuzowe Urban Engineering L.L.C."],
    ["宏盛新源信息技术有限公司", "宏盛新源集团", "宏盛新源信息技术", "宏盛新源（柏泉）信息技术有限公司", "宏盛新源信息技术股份有限公司", "宏盛新源 信息技术 有限公司"],
    ["锐禾瑞嘉环境工程有限公司", "锐禾瑞嘉环境工程公司", "锐禾瑞嘉（柏泉）环境工程有限公司", "柏泉锐禾瑞嘉环境工程有限公司"],
    ["孙凌元", "孙凌元经理", "@孙凌元", "孙 凌元", "孙凌元（财务部）", "算法组-孙凌元"],
]
APART = ["Vera Fugathojo", "Milan Fugathojo", "Nora Fugathojo", "Zora Fugathojo", "V. Lone", "Vera Lone", "Viktor Lone", "孙凌云", "login module 051-SON", "login module 052-SON", "宏耀新源信息技术有限公司"]


def test_spellings(spark):
    rows = [(n, "person", n) for g in ONE for n in g] + [(n, None, n) for n in APART] + [(None, "person", ""), ("", None, ""), (ONE[0][0], "人物", ""), ("索引服务", "system", "")]
    df = spark.createDataFrame(rows, "entity_name string, entity_type string, form string")
    got = {(r.name_a, r.name_b) for r in names.same_pairs(df).collect()}
    want = {tuple(sorted((a, b), key=lambda x: x.encode())) for g in ONE for i, a in enumerate(g) for b in g[i + 1 :]}
    assert got == want, (want - got, got - want)
    assert names.same_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize(("a", "b", "same"), [("milan", "mialn", True), ("oscar", "oscr", True), ("nora", "zora", True), ("vera", "nils", False), ("sadonujo", "sadonuju", True), ("sadonujo", "sidonuja", False), ("una", "ida", False)])
def test_slips_of_the_pen(a, b, same):
    assert names.alike(a, b) == same


def test_common_suffixes_are_refined(spark, monkeypatch):
    r = random.Random(1)
    given = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(3)).title() for _ in range(120)]
    rows = [(f"{g} Sadonujo",) for g in given] + [(f"{g[:2]}{g[3]}{g[2]}{g[4:]} Sadonujo",) for g in given[:20]]
    got = {(x.name_a, x.name_b) for x in names.same_pairs(spark.createDataFrame(rows, "entity_name string")).collect()}
    made = {tuple(sorted((f"{g} Sadonujo", f"{g[:2]}{g[3]}{g[2]}{g[4:]} Sadonujo"))) for g in given[:20]}
    assert len(made - got) == 0


def test_nothing_is_left_out_of_common_blocks(spark, monkeypatch):
    r = random.Random(2)
    given = sorted({"".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(150)})
    typos = [f"{g[:3]}{g[4]}{g[3]}{g[5:]}" for g in given[::3]]
    rows = [(f"{g.title()} Sadonujo",) for g in given + typos]
    df = spark.createDataFrame(rows, "entity_name string")
    want = {(x.name_a, x.name_b) for x in names.same_pairs(df).collect()}
    monkeypatch.setattr(names, "COMMON", 2)
    monkeypatch.setattr(names, "BLOCK", 5)
    got = {(x.name_a, x.name_b) for x in names.same_pairs(df).collect()}
    assert got == want and len(want) >= 40


def test_digits_and_types_leave_no_name_out(spark):
    rows = [("3M Ltd", "metric"), ("3M", "system"), ("3N Ltd", "metric"), ("Acme Widgets Ltd", "concept"), ("ACME Widgets", None), ("Muhammad Alizade", "event"), ("Mohammed Alizade", None), ("node 17-A", "system"), ("node 17-B", "system"), ("孙凌元", "人物"), ("孙凌元经理", None), ("孙凌云", None)]
    got = {(x.name_a, x.name_b) for x in names.same_pairs(spark.createDataFrame(rows, "entity_name string, entity_type string")).collect()}
    assert got == {("3M", "3M Ltd"), ("ACME Widgets", "Acme Widgets Ltd"), ("Mohammed Alizade", "Muhammad Alizade"), ("孙凌元", "孙凌元经理")}


def test_initials_meet_similar_surnames(spark):
    rows = [("Agnes Sadonujo",), ("A. Sadnujo",), ("Vera Lonemil",), ("Viktor Lonemil",), ("V. Lonemil",)]
    got = {(x.name_a, x.name_b) for x in names.same_pairs(spark.createDataFrame(rows, "entity_name string")).collect()}
    assert got == {("A. Sadnujo", "Agnes Sadonujo")}


@pytest.mark.parametrize("seed", range(3))
def test_subsequences(seed):
    r = random.Random(seed)
    for _ in range(200):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randrange(0, 12))) for _ in "ab")
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                here, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
                last = here
        assert names.lcs(a, b) == row[-1]


# ---- mixing


def sized(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens int")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_hold_and_repeats_are_capped(spark):
    r = random.Random(0)
    d = sized(spark, {"wiki": [r.randrange(1, 90) for _ in range(900)], "pdf": [r.randrange(1, 90) for _ in range(300)], "faq": [r.randrange(1, 90) for _ in range(60)], "lost": [50] * 10})
    t = targets(spark, [(" Wiki", 0.5, 1), ("pdf", 0.3, 2), ("faq", 0.2, 4), ("none", 0.1, 3)])
    picked = mix.chosen(d, t)
    s = {x.source: x for x in mix.shares(picked, t, d).collect()}
    for name, want in (("wiki", 0.5), ("pdf", 0.3), ("faq", 0.2)):
        assert abs(s[name].actual_share - want) < 0.02
    assert s["none"].actual_share == 0 and "lost" not in s
    assert picked.groupBy("source").agg(F.max("repeats").alias("m"), F.min("repeats").alias("l")).filter("source = 'faq'").first()[1:] == (4, 4) or s["faq"].copies <= 240
    assert [n for n, x in s.items() if x.binding] == ["faq"] or sum(x.binding for x in s.values()) == 1
    assert all(x.unused == x.have - sum(r.n_tokens for r in picked.collect() if r.source == n) for n, x in s.items())
    o = mix.ordered(picked).collect()
    assert len(o) == sum(x.copies for x in s.values())
    assert all(a.position <= b.position for a, b in zip(o, o[1:])) and 0 <= o[0].position and o[-1].position <= 1


def test_a_given_total_fills_sources_in_turn(spark):
    d = sized(spark, {"a": [10] * 100, "b": [10] * 10})
    t = targets(spark, [("a", 0.5, 1), ("b", 0.5, 2)])
    demand = {r.source: r.demand for r in mix.plan(d, t, 600).collect()}
    assert demand == {"a": 400.0, "b": 200.0}
    assert {r.source: r.demand for r in mix.plan(d, t, 100).collect()} == {"a": 50.0, "b": 50.0}
    assert {r.source: r.demand for r in mix.plan(d, t, 99999).collect()} == {"a": 1000.0, "b": 200.0}


def test_running_totals_do_not_depend_on_ranges(spark, monkeypatch):
    d = sized(spark, {"a": list(range(1, 400)), "b": [5] * 50})
    want = sorted(map(tuple, mix._running(d).collect()))
    monkeypatch.setattr(mix, "RANGE", 7)
    assert sorted(map(tuple, mix._running(d).collect())) == want
    own = sorted((b, n) for _, s, n, b in want if s == "a")
    assert [b for b, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]


def test_position_inverts_the_schedule(spark):
    got = spark.range(0, 101).select((F.col("id") / 100).alias("u"), *[mix.position(F.col("id") / 100, F.lit(k)).alias(f"t{i}") for i, k in enumerate((0.0, 0.5, -0.5))]).collect()
    for r in got:
        for i, k in enumerate((0.0, 0.5, -0.5)):
            t = r[f"t{i}"]
            assert abs(t + k * (t * t - t) - r.u) < 1e-9


def test_mixture_of_odd_rows(spark):
    rows = [(1, "some text here", " A "), (2, None, "a"), (3, "", "a"), (4, "more text", None), (5, "more text", ""), (6, "other words", "a"), (6, "other words", "a"), (None, "x", "a"), (7, "no target", "z")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = targets(spark, [("A", 1.0, 1), ("b", 0.0, None)])
    assert sorted(r.doc_id for r in mix.mixture(d, t).collect()) == [1, 6, 6]
    assert mix.mixture(d.limit(0), t).count() == 0
    assert mix.mixture(d, t.limit(0)).count() == 0


# ---- all queries on whole and on empty tables


def test_queries(spark, data, tmp_path):
    from quire.llm import queries
    from tests.compare import connection, differences

    con = connection(data)
    tables = [r[0] for r in con.execute("SHOW TABLES").fetchall()]
    for t in tables:
        spark.read.parquet(f"{data}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, f in queries.QUERIES.items():
        if name in queries.ORACLES:
            assert differences(f(spark, data), con, queries.ORACLES[name]) == ""
        else:
            assert f(spark, data).count() > 0, name
        assert f(spark, str(tmp_path)).count() in (0, 10), name
