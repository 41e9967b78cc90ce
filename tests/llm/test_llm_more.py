"""Token offsets, classes of looks, exact and measured vector search, outliers without letters, odd numbers of scans."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import encode, looks, quality, scan, split, vectors
from leafmill.llm.automaton import MergeAutomaton
from leafmill.llm.graph import SmallWorld


@pytest.fixture(scope="module")
def model():
    with open(f"{encode.TOKENIZERS}/{encode.VOCABULARY}", "rb") as f:
        return MergeAutomaton(f.read())


TEXTS = ["", "a", "plain words and, well, more of them. " * 40, "ÄÖÜ naïve 日本語のテキスト 🙂🙂 " * 30, "x" * 900, "one\n\ntwo three\nfour " * 50, "​" * 50 + "é" * 200]


@pytest.mark.parametrize("text", TEXTS)
def test_token_prefix_sums(model, text):
    tokens = [model.words[i] for i in model.encode(text)]
    before = split.token_offsets(tokens, text)
    raw = [len(c.encode()) for c in text]
    begins = np.cumsum([0, *map(len, tokens)])[:-1]
    want = [int((begins < sum(raw[:i])).sum()) for i in range(len(text) + 1)] if len(text) < 300 else None
    assert len(before) == len(text) + 1 and before[-1] == len(tokens) and (np.diff(before) >= 0).all()
    if want:
        assert before.tolist() == want
    for limit, overlap in ((20, 5), (64, 0), (7, 6)):
        cuts = split.pieces(text, limit, overlap, before)
        assert all(before[z] - before[a] <= limit or z - a == 1 for a, z, _ in cuts)
        end = 0
        for a, z, _ in cuts:
            assert a <= end < z or not text
            assert before[end] - before[a] <= overlap or end == 0
            end = z
        assert end == len(text)


def test_pieces_by_tokens_and_rebuilt(spark):
    rows = list(enumerate(TEXTS)) + [(2, TEXTS[2]), (90, None), (None, TEXTS[5])]
    df = spark.createDataFrame(rows, "id long, content string").withColumn("start", F.lit("clash"))
    got = split.split_texts(df, limit=100, overlap=10, vocabulary=f"{encode.TOKENIZERS}/{encode.VOCABULARY}")
    assert got.groupBy("id", "piece_no").count().where("count > 1").count() == 0
    back = {r["id"]: r["text"] for r in split.rebuilt(got).collect()}
    assert all(back[i] == TEXTS[i] for i in back if i is not None) and back[None] == TEXTS[5] and {2, 3} <= set(back) and 0 not in back and 1 not in back
    by_chars = {r["id"]: r["text"] for r in split.rebuilt(split.split_texts(df, limit=100, overlap=10)).collect()}
    assert by_chars == {i: t for i, t in rows if t and len(t) > 100}


def test_classes_of_looks(spark):
    rows = [(1, "Ab c"), (2, "Ab c"), (3, "Ab c"), (4, "Аb c"), (5, "other"), (6, None), (7, " "), (1, "Ab c")]  # 4 begins with a Cyrillic letter
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit(1))
    got = {r["doc_id"]: (r["class_id"], r["text_id"], r["n_texts"]) for r in looks.look_classes(df).collect()}
    assert got == {1: (1, 1, 3), 2: (1, 2, 3), 3: (1, 1, 3), 4: (1, 4, 3), 5: (5, 5, 1)}
    assert {tuple(r) for r in looks.same_looks(df).collect()} == {(1, 2), (2, 3), (1, 4), (3, 4), (2, 4)}
    forms = sorted((r["doc_id"], r["form"]) for r in looks.normalise_looks(df).collect())
    assert len(forms) == 8 and forms[0] == forms[1] == (1, "Ab c") and (6, None) in forms and (7, "") in forms


def blobs(spark, x, model="m"):
    d = x.shape[1]
    return spark.createDataFrame([(i, model, d, struct.pack(f"<{d}f", *v)) for i, v in enumerate(x)], "id long, model_name string, dimensions int, vector_blob binary")


def test_exact_search_and_recall(spark, monkeypatch):
    x = np.random.default_rng(11).standard_normal((500, 24))
    df = blobs(spark, x)
    unit = x.astype("<f4").astype(np.float64)
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype("<f4").astype(np.float64)
    s = unit @ unit.T
    np.fill_diagonal(s, -2)
    monkeypatch.setattr(vectors, "SHARD", 100)
    got = {i: list(g.sort_values("rank").neighbour_id) for i, g in vectors.nearest(df, 10, coverage=1.0).toPandas().groupby("id")}
    assert all(got[i] == np.argsort(-s[i], kind="stable")[:10].tolist() for i in range(500))
    r = vectors.recall(df, 10, 50).collect()
    assert len(r) == 1 and r[0]["n_queries"] == 10 and r[0]["recall"] >= 0.9


def test_graph_in_bulk_is_connected_enough():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 48)).astype(np.float32)
    x[3000:3400] = x[:400] + 0.2 * rng.standard_normal((400, 48)).astype(np.float32)  # pairs almost alike
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = SmallWorld(x)
    assert len(w.sizes) > 1 and all(a > b for a, b in zip(w.sizes, w.sizes[1:], strict=False))
    near, _ = w.around(np.arange(400), 5, 16, floor=0.9)
    assert np.mean([3000 + i in near[i] for i in range(400)]) > 0.995
    apart, _ = SmallWorld(x[400:]).search(x[:400], 5, 16)
    assert np.mean([2600 + i in apart[i] for i in range(400)]) > 0.97


def test_outliers_decide_where_lines_do_not(spark):
    prose = "the plant of the company is in the valley and the board of the plant said so. " * 4
    df = spark.createDataFrame([(i, prose) for i in range(30)] + [(90, "/-" * 80), (91, " ")], "id long, content string")
    words = spark.createDataFrame([("en", w) for w in "the of is in and so".split()], "lang string, word string")
    got = {r["id"]: r["kind"] for r in quality.classify(df, words).collect()}
    assert got[90] == "junk" and got[0] == "prose" and got[91] == "prose"


@pytest.mark.parametrize("frequent", [0, 3, 1_000_000])
def test_ranks_are_of_values_as_they_are(spark, monkeypatch, frequent):
    monkeypatch.setattr(quality, "FREQUENT", frequent)
    common = dict.fromkeys("the of is".split(), "en")
    texts = [("the pump of the town is in order and " * 150 + "so " * k + "x" * (k % 5)).strip() for k in range(12)] * 2 + ["9 # 9 #", "# 9 #", " "]
    found = [quality.measure(t, common) for t in texts]
    assert [s["word_count"] for _, s in found[:3]] == [1350, 1352, 1353] and len({s["mean_word_length"] for _, s in found[:12]}) == 12
    assert len({round(s["mean_word_length"], 3) for _, s in found[:12]}) < 12
    df = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    words = spark.createDataFrame([(v, k) for k, v in common.items()], "lang string, word string")
    got = {r["id"]: r["score"] for r in quality.classify(df, words).collect()}
    assert len(got) == len(texts)
    for i, (lang, s) in enumerate(found):
        group = [g for x, g in found if x == lang] if lang else [g for _, g in found]
        want = np.mean([-np.log(np.mean([g[k] >= s[k] if tail > 0 else g[k] <= s[k] for g in group])) for k, tail in quality.STATS.items()])
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_half_of_a_text_is_not_most_of_it():
    assert quality.kind_of(1 / 3, 0.0, 1 / 6) == quality.kind_of(0.1, 0.2, 0.2) == "prose" and quality.kind_of(0.3, 0.0, 0.2004) == "list"


@pytest.mark.parametrize("known", [0, 50_000])
def test_frequent_words_decide_nothing(spark, monkeypatch, known):
    monkeypatch.setattr(scan, "FREQUENT_WORDS", known)
    lines = "\n".join(f"the unit S0 of plant number {i} is in the report of the year" for i in range(30))
    pages = spark.createDataFrame([(1, 1, lines), (1, 2, "the sum 2O19 is in the report\nthe unit S0 of the plant")], "doc_id long, page_number int, text string").withColumn("method", F.lit("ocr"))
    got = {(r["page_number"], r["line_no"]) for r in scan.noisy_lines(pages).where("kind = 'ocr'").collect()}
    assert got == {(2, 1)}
