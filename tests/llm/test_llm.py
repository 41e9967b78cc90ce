"""The training-data operators against brute force, exact round trips and small fixtures with nulls, ties, repeats and empty tables."""

import random
import struct
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import encode, looks, pack, quality, scan, split, vectors
from leafmill.llm.automaton import MergeAutomaton
from leafmill.llm.graph import SmallWorld
from leafmill.llm.oracles import ORACLES

VOCABULARY = Path(encode.TOKENIZERS) / encode.VOCABULARY
needs_vocabulary = pytest.mark.skipif(not VOCABULARY.exists(), reason="no vocabulary files")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(compare, name):
    mine, sql = compare(name)
    assert mine == sql


# looks

SAME = [("café K", "café K"), ("fin st", "ﬁn ﬆ"), ("a b", "a　b"), ("a-b", "a‑b"), ("Ab,3", "Ａｂ，３"), ("нос", "нoc"), ("ab", "a‍b"), ("ab", "a­b"), ("ё", "ё"), ("a\nb", "a\r\nb"), ("x", "x ")]
OTHER = [("a", "A"), ("e", "é"), ("x²", "x2"), ("a-b", "a–b"), ("–", "—"), ("③", "3"), ("½", "1/2"), ("𝒳", "X"), ("👩‍🔬", "👩🔬"), ("ﷺ", "صلى الله عليه وسلم"), ("a\nb", "a b")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_looks_same(a, b):
    assert looks.look_form(a) == looks.look_form(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_looks_other(a, b):
    assert looks.look_form(a) != looks.look_form(b)


def test_look_form_is_stable():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(chr(rng.choice([rng.randrange(32, 0x600), rng.randrange(0x2000, 0x2100), rng.randrange(0xFB00, 0xFFF0), rng.randrange(0x1F300, 0x1F400)])) for _ in range(20))
        form = looks.look_form(t)
        assert looks.look_form(form) == form
    assert looks.look_form(None) is None and looks.look_form("Straße", fold_case=True) == "strasse"


def test_pairs_of_looks(spark):
    rows = [(1, "café"), (2, "café"), (3, "café"), (4, "​"), (5, " "), (6, None), (7, "CAFÉ"), (1, "café"), (8, ""), (9, "cаfé")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit(1)).withColumn("form", F.lit("x"))
    assert {tuple(r) for r in looks.same_looks(df).collect()} == {(1, 2), (2, 3), (1, 9), (2, 9), (3, 9)}
    assert looks.same_looks(df.limit(0)).collect() == []
    forms = looks.normalise_looks(df).collect()
    assert len(forms) == len(rows) and {r["form"] for r in forms if r["doc_id"] == 6} == {None}


# splitting


def test_pieces():
    rng = random.Random(4)
    for _ in range(3000):
        limit = rng.choice([8, 10, 20])
        overlap = rng.randrange(limit // 2)
        t = "".join(rng.choice(["a" * rng.choice([1, 5, 12]), " ", ". ", "\n", "\n\n", "é"]) for _ in range(rng.randrange(80)))
        got = split.pieces(t, limit, overlap)
        assert bool(t) == bool(got)
        if not t:
            continue
        assert got[0][0] == 0 and got[-1][1] == len(t) and all(0 < b - a <= limit for a, b, _ in got)
        assert all(b - overlap <= a2 <= b < b2 for (_, b, _), (a2, b2, _) in zip(got, got[1:], strict=False))
        if len(t) > limit:
            assert any(h for *_, h in got) == any(len(w) > limit for w in t.split())
    with pytest.raises(ValueError):
        split.pieces("x", 5, 5)


def test_split_texts(spark):
    long = "word " * 700
    df = spark.createDataFrame([(1, long), (1, long), (2, "x" * 2305), (3, "short"), (4, None), (5, "")], "id long, content string").withColumn("cuts", F.lit(1)).withColumn("text", F.lit("t"))
    rows = split.split_texts(df).orderBy("id", "piece_no").collect()
    assert all(r["text"] == {1: long, 2: "x" * 2305}[r["id"]][r["start"] : r["end"]] for r in rows)
    assert {tuple(r) for r in split.split_kinds(df).collect()} == {(1, "natural"), (2, "forced")}
    assert split.split_kinds(df.limit(0)).collect() == []


# tokens


@needs_vocabulary
def test_automaton_equals_library():
    from tokenizers import Tokenizer

    ours = MergeAutomaton(VOCABULARY.read_bytes())
    theirs = Tokenizer.from_file(str(VOCABULARY))
    theirs.encode_special_tokens = True
    rng = random.Random(5)
    parts = ["a", "b", "the", " ", "1", "é", "中", "\n", "<|endoftext|>", "!!!", "aaaa", "ing", "‍", "👩", "=", "-----", "\x00", "\x1c", "\x85", " ", "²", "Ⅳ", "𝒳", "\r\n", "\t", "'ll", "S"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(2000)] + ["a" * 5000, "-=" * 3000]
    texts += ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x30000)])) for _ in range(30)) for _ in range(300)]
    for t, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), strict=True):
        if all(t.isascii() or c < "　" or c in "中👩𝒳" for c in t):
            assert ours.encode(t) == e.ids
        assert ours.decode(ours.encode(t)) == t and ours.count(t) == len(ours.encode(t))


@needs_vocabulary
def test_encode_null_empty_and_back(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "x" * 20_000), (1, "Hello world")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    ids = encode.encode_corpus(df)
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert got[1] == [15496, 995] and got[2] == [] and got[3] == [] and ids.count() == 5
    assert {r["doc_id"]: r["text"] for r in encode.decode_corpus(ids).collect()} == {1: "Hello world", 2: "", 3: "", 4: "x" * 20_000}


# packing


def best_fit(sizes, capacity):
    room = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            room[min(fits)[1]] -= s
        else:
            room.append(capacity - s)
    return sorted(room)


def test_plan_equals_item_by_item():
    rng = random.Random(6)
    for _ in range(500):
        capacity = rng.choice([10, 30, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randrange(80))]
        runs, made = pack.plan_packing(dict(Counter(sizes)), capacity)
        used = Counter()
        for s, _, n, first, per in runs:
            for j in range(n):
                used[first + j // per] += s
        assert len(used) == made and sorted(capacity - v for v in used.values()) == best_fit(sizes, capacity)


def test_fill_containers(spark, monkeypatch):
    rng = random.Random(7)
    sizes = [(i, rng.choice([0, None, 7, 7, 7, 33, 60, 101, 250, rng.randint(1, 100)])) for i in range(400)]
    df = spark.createDataFrame(sizes, "id long, n_tokens long").withColumn("size", F.lit("clash"))
    shown = pack.fill_containers(df, 100).collect()
    used, seen = Counter(), Counter()
    for r in shown:
        used[r["container_id"]] += r["size"]
        seen[r["id"]] += r["size"]
    assert {i: n or 0 for i, n in sizes} == dict(seen) and used.pop(None) == 0 and max(used.values()) <= 100
    pieces = [p for _, n in sizes if n for p in [100] * (n // 100) + [n % 100] * (n % 100 > 0)]
    assert sorted(100 - v for v in used.values()) == best_fit(pieces, 100)
    monkeypatch.setattr(pack, "MAX_SHARED_RUNS", 0)  # the way by a join gives the same
    key = lambda rows: sorted((r["id"], r["piece_no"], r["start"], r["container_id"] or -1) for r in rows)
    assert key(pack.fill_containers(df, 100).collect()) == key(shown)
    assert pack.fill_containers(df.limit(0), 100).collect() == []


# quality


@pytest.fixture(scope="module")
def common():
    return dict.fromkeys("the of and to in is a for".split(), "en") | {"der": "de", "die": "de", "und": "de"}


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("The board measured the output of the plant in the year and sent it to the office. " * 3, "prose"), ("The board of the plant is\nin the town and to be a\nmember for the year of the\nboard is the aim.", "prose"),
        ("- safety data sheets\n- water meters\n- spare parts", "list"), ("Intro ........ 3\nNext part ..... 14\nLast one .... 20", "list"), ("Water meters\nSpare parts\nEnergy audits\nSite inspections", "list"),
        ("Year | 2014 | 2015\nHeat | 3,895 | -\nSite | 12 | 40.5%", "table"), ("Heat\n12\n14\nSite\n3,000\n-", "table"), ("A;1;2\nB;3;4", "table"), ("7f55238d17e0f53bb575f3ecf48b2efe\n28534ee40816d66ba67f55238d17e0f5", "junk"),
        ("." * 500, "junk"), ("(cid:35)(cid:152)(cid:115)\n(cid:3)(cid:154)", "junk"), ("xlxcxQv pbJb Xcd Kdg xnk fcdrgzh nrd sjQzsJvcc", "junk"), ("lorum " * 60, "junk"), ("", "prose"),
    ],
)
def test_kinds(common, text, kind):
    s = quality.measure(text, common)[1]
    assert quality.kind_of(s["list_share"], s["table_share"], s["junk_share"]) == kind


def test_scores_are_exact_ranks(spark, common):
    rng = random.Random(8)
    texts = [(i, " ".join(rng.choices(["the", "der", "house", "x9", "|", "12", "Ab."], k=rng.randrange(30)))) for i in range(150)] + [(900, None), (0, "again")]
    words = spark.createDataFrame([(v, k) for k, v in common.items()] + [(None, "x")], "lang string, word string")
    df = spark.createDataFrame(texts, "id long, content string").withColumn("lang", F.lit("clash"))
    got = quality.classify(df, words).toPandas()
    assert len(got) == 150
    for _, r in got.iterrows():
        group = got[got.lang == r.lang] if r.lang else got
        want = np.mean([-np.log((group[s] >= r[s]).mean() if tail > 0 else (group[s] <= r[s]).mean()) for s, tail in quality.STATS.items()])
        assert abs(want - r.score) < 1e-5
    assert quality.classify(df.limit(0), words).collect() == []


def test_common_lists_are_lists(spark, common):
    prose, items = "der Bericht und die Anlage der Stadt sind die Grundlage und der Plan der Jahre. " * 5, "- die Anlage\n- der Bericht\n- und Wasser"
    df = spark.createDataFrame([(0, "- the plant\n- the office"), *((i, items) for i in range(1, 9)), (9, prose), (10, prose)], "id long, content string")
    words = spark.createDataFrame([(v, k) for k, v in common.items()], "lang string, word string")
    got = {r["id"]: (r["lang"], r["kind"], r["score"]) for r in quality.classify(df, words).collect()}
    assert got[0] == ("en", "list", 0.0) and {got[i][:2] for i in range(1, 9)} == {("de", "list")} and got[1][2] < 0.5
    assert got[9][:2] == got[10][:2] == ("de", "prose")


# vectors


def test_small_world_recall():
    x = np.random.default_rng(1).standard_normal((3000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at, sims = SmallWorld(x).search(x[:300], 11, 32)
    s = x[:300] @ x.T
    true = np.argsort(-s, axis=1)[:, :11]
    assert np.mean([len(set(a) & set(b)) / 11 for a, b in zip(at, true, strict=True)]) > 0.9
    assert np.allclose(sims, np.take_along_axis(s, at, 1), atol=1e-5)
    for n in (0, 1, 2, 5):
        at, _ = SmallWorld(x[:n]).search(x[:3], 4, 8)
        assert (np.sort(at, 1)[:, ::-1][:, :n] >= 0).all() and (at >= 0).sum() == 3 * min(n, 4)


def test_nearest_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 8))
    x[100:115] = x[0] * np.arange(1, 16)[:, None]  # copies of one direction
    x[200:240] = x[240:280] + 0.05 * rng.standard_normal((40, 8))
    blob = lambda v: struct.pack(f"<{len(v)}f", *v)
    rows = [(i, "m" if i % 2 else "n", 8, blob(v)) for i, v in enumerate(x)]
    bad = [(900, "m", 8, None), (901, "m", 8, b"123"), (902, "m", 9, blob(x[0])), (903, "m", 8, blob([0.0] * 8)), (904, "m", 8, blob([float("nan")] * 8)), (905, "m", None, blob(x[0])), (906, None, 8, blob(x[0])), (907, "lone", 8, blob(x[0]))]
    df = spark.createDataFrame([*rows, rows[3], *bad], "id long, model_name string, dimensions int, vector_blob binary").withColumn("space", F.lit(0)).withColumn("rep", F.lit(0))
    unit = np.array([np.frombuffer(r[3], "<f4") for r in rows], np.float64)
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype("<f4").astype(np.float64)
    top = {}
    for i in range(400):
        others = [j for j in range(i % 2, 400, 2) if j != i]
        cos = {j: 1.0 if (unit[i] == unit[j]).all() else unit[i] @ unit[j] for j in others}
        top[i] = [(j, cos[j]) for j in sorted(others, key=lambda j: (-cos[j], j))[:10]]
    want = {(i, j) for i in top for j, c in top[i] if i < j and c >= 0.9 and any(a == i for a, _ in top[j])}
    for shard in (24_000, 60):
        monkeypatch.setattr(vectors, "SHARD", shard)
        got = vectors.nearest(df).toPandas()
        mine = {i: set(g) for i, g in got.groupby("id").neighbour_id}
        assert set(mine) == set(top) and np.mean([len(mine[i] & {j for j, _ in top[i]}) / 10 for i in top]) > 0.9
        assert len(want ^ {tuple(r) for r in vectors.mutual(df).collect()}) <= 0.02 * len(want)
    assert vectors.nearest(df.limit(0)).collect() == [] and vectors.mutual(df.where("id > 899")).collect() == []


def test_nearest_in_a_dense_group(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 16))
    x[:500] = x[0] / np.linalg.norm(x[0]) + 0.0025 * rng.standard_normal((500, 16))  # cosines of about 0.9999
    df = spark.createDataFrame([(i, "m", 16, struct.pack("<16f", *v)) for i, v in enumerate(x)], "id long, model_name string, dimensions int, vector_blob binary")
    unit = x.astype("<f4").astype(np.float64)
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype("<f4").astype(np.float64)
    s = unit @ unit.T
    np.fill_diagonal(s, -2)
    got = {i: set(g) for i, g in vectors.nearest(df).toPandas().groupby("id").neighbour_id}
    assert np.mean([len(got[i] & set(np.argsort(-s[i])[:10])) / 10 for i in range(500)]) > 0.97


# scans


@pytest.mark.parametrize(
    ("line", "value"),
    [("- l -", 1), ("l1 / 14", 11), ("vi", 6), ("Page 3 of 6", 3), ("p. 3l", 31), ("[12]", 12), ("Pagc 5", 5), ("— 2S —", 25), ("Seite l2 von 13", 12), ("Page 7 of the annex", None), ("1. Intro", None), ("Borstead | 1", None), ("total.", None), ("78990 sites.", None)],
)
def test_page_label(line, value):
    got = scan.page_label(line)
    assert (got and got[1]) == value


def test_misreading():
    assert scan.misreading("comm!ttee", "committee") == [4] and scan.misreading("hovvever", "however") == [2]
    assert scan.misreading("dog", "cat") is None and scan.misreading("same", "same") == []
    assert scan.strokes("tirnber") == scan.strokes("timber") and scan.strokes("vehide") == scan.strokes("vehicle")


def test_noisy_lines(spark):
    word = "committee reviewed the long-term transition and the measurement of weather records in every department of the company"
    pages = [(9, p, f"{word}\n{word}\n", "pdfplumber", True) for p in range(40)]
    pages += [(1, 1, f"Acme Report 2020\nthe {word}\nwith a measure-\nment of weather\nand the long-\nterm transition\nPage 1", "ocr", True)]
    pages += [(1, 2, "Acme Rep0rt 2021\nthe comm!ttee reviewed\nthe ¦ records in every depart-\n\nPage 2", "ocr", True)]
    pages += [(1, 4, "Acme Report 2022\nment of the company\n2019\nin every record of the\nweather and the\nPage 3", "ocr", True)] * 2
    pages += [(2, 1, None, "ocr", False), (2, 2, "  \n", "ocr", False), (None, 1, "x", "ocr", True)]
    df = spark.createDataFrame(pages, "doc_id long, page_number int, text string, method string, has_text boolean").withColumn("kind", F.lit("clash"))
    got = {tuple(r) for r in scan.noisy_lines(df).collect()}
    assert got == {
        (1, 1, 1, "header"), (1, 2, 1, "header"), (1, 4, 1, "header"), (1, 1, 7, "page_no"), (1, 2, 5, "page_no"), (1, 4, 6, "page_no"), (1, 1, 3, "hyphen"), (1, 2, 3, "hyphen"), (1, 2, 2, "ocr"), (1, 2, 3, "ocr"),
    }
    assert scan.noisy_lines(df.limit(0)).collect() == []


def test_headers_each_damaged_elsewhere(spark):
    body = "weather records of every department\nwere read by the company\nin the year of the measurement\nand sent to the office\n"
    heads = {1: ["Ac\ufffde Annual Review", "Acme A\ufffdnual Review", "Acme Annual Re\ufffdiew"], 2: ["Acme ` Annual Review", "Ac^me Annual Review", "Acme Annual ~ Review"], 3: ["Ac\ufffde Annual Review", "Acme A\ufffdnual Review", "Other words here"]}
    pages = [(d, p, f"{h}\n{body[p:]}{p * 'x'} ends", "ocr", True) for d, hs in heads.items() for p, h in enumerate(hs, 1)]
    df = spark.createDataFrame(pages, "doc_id long, page_number int, text string, method string, has_text boolean")
    got = {(r["doc_id"], r["page_number"]) for r in scan.furniture(scan.scanned_pages(df)).where("kind = 'header' AND line_no = 1").collect()}
    assert got == {(d, p) for d in (1, 2) for p in (1, 2, 3)}


def test_repair_text():
    text = "Head\nment of the old com-\npany; the comm!ttee \u00a6 met.\nIt was\n\n- an item\n- ano`ther\n\nNew part goes\n\non here\nand the depart-\n\n7"
    got = scan.repair_text(text, {1, 14}, {2: "company;", 12: "department"}, {2}, {"comm!ttee": "committee"})
    assert got == "of the old company; the committee met. It was\n\n- an item\n- another\n\nNew part goes on here and the department"


def test_repaired_pages(spark):
    word = "committee reviewed the measurement of weather records in every department of the company"
    pages = [(9, p, f"{word}\n{word}\n", "pdfplumber", True) for p in range(40)]
    pages += [(1, 1, "the comm!ttee of the depart-\nment in every\ndepart-\nPage 1", "ocr", True), (1, 3, "ment of the\ncompany\nPage 2", "ocr", True), (1, 4, None, "ocr", False)]
    df = spark.createDataFrame(pages, "doc_id long, page_number int, text string, method string, has_text boolean")
    got = {r["page_number"]: r["text"] for r in scan.repaired_pages(df).collect()}
    assert got == {1: "the committee of the department in every department", 3: "of the company"}


def test_repaired_documents(spark):
    word = "committee reviewed the measurement of weather records in every department of the company"
    pages = [(9, p, f"{word}\n{word}\n", "pdfplumber", True) for p in range(40)]
    one, two, three = "the comm!ttee of the department in every\ndepart-\nPage 1", "ment of the company and all records of the\nPage 2", "Company in\nthe end.\n\nWeather\nPage 3"
    pages += [(1, 1, one, "ocr", True), (1, 2, two, "ocr", True), (1, 3, "", "empty", False), (1, 4, three, "ocr", True), (3, 1, one, "ocr", True)]
    df = spark.createDataFrame(pages, "doc_id long, page_number int, text string, method string, has_text boolean")
    content = f"--- Metadata ---\nPages: 4\n--- End ---\n\n{one}\n\n{two}\n\n{three}"
    docs = spark.createDataFrame([(1, content), (1, content), (3, None), (9, word), (None, one)], "id long, content string")
    whole = "--- Metadata ---\nPages: 4\n--- End ---\n\nthe committee of the department in every department of the company and all records of the Company in the end.\n\nWeather"
    assert [tuple(r) for r in scan.repaired_documents(df, docs).collect()] == [(1, whole)]
    got = scan.repaired(df, docs).collect()
    assert {(r["doc_id"], r["page_number"]) for r in got if r["source_table"] == "page_results"} == {(1, 1), (1, 2), (1, 4), (3, 1)}
    assert [(r["doc_id"], r["page_number"], r["text"]) for r in got if r["source_table"] == "pdf_documents"] == [(1, None, whole)]
    assert scan.repaired(df.limit(0), docs.limit(0)).collect() == []


def test_place_of_a_page():
    content = "Pages: 7\n\nabout 7 sites\n\n7\n\nthe   end"
    assert scan._place(content, "7", 0) == (25, 26) and scan._place(content, "the end", 26) == (28, 37) and scan._place(content, "none", 0) is None
