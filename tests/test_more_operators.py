"""PDF reading, page input, trees, reranking, indexes, ingestion and deletes on small fixtures."""

import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions.text import safe_filename
from leafmill.operators import chunk, embed, enrich, extract, graph, parse, validate
from leafmill.operators import search as se
from leafmill.plans import api, pipeline
from leafmill.session import clean, materialise
from leafmill.sources import files, store
from leafmill.streaming import ingest


def pdf(*texts, packed=False, title="A (small) test", encrypted=False):
    """A PDF of one page a text, lines at 14 points; a None is a page with an image and no text."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", 4: b"<< /Type /XObject /Subtype /Image /Width 1 /Height 1 /Length 1 >>\nstream\n0\nendstream"}
    kids = []
    for i, t in enumerate(texts):
        lines = "".join(f"({line}) Tj 0 -14 Td " for line in (t or "").split("\n"))
        body = f"BT /F1 12 Tf 72 700 Td {lines} ET".encode() if t else b"/Im0 Do"
        stream = zlib.compress(body) if packed else body
        objects[11 + 2 * i] = b"<< /Length %d %s>>\nstream\n" % (len(stream), b"/Filter /FlateDecode " if packed else b"") + stream + b"\nendstream"
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R /Resources << /Font << /F1 3 0 R >> %s >> >>" % (11 + 2 * i, b"" if t else b"/XObject << /Im0 4 0 R >>")
        kids.append(b"%d 0 R" % (10 + 2 * i))
    objects[2] = b"<< /Type /Pages /MediaBox [0 0 600 800] /Count %d /Kids [%s] >>" % (len(kids), b" ".join(kids))
    objects[5] = b"<< /Title (" + title.replace("(", r"\(").replace(")", r"\)").encode() + b") /Author <FEFF00C4> >>"
    out = b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % o for o in sorted(objects.items()))
    return out + b"trailer << /Root 1 0 R /Info 5 0 R %s>>\n%%%%EOF" % (b"/Encrypt 9 0 R " if encrypted else b"")


def as_files(spark, **named):
    return spark.createDataFrame([(f"/in/{k}.pdf", len(v), v) for k, v in named.items()], "path string, length long, content binary")


@pytest.mark.parametrize("packed", [False, True])
def test_pdf_pages_and_methods(spark, packed):
    got = files.pdf_pages(as_files(spark, mixed=pdf("Test Document Content\nline two", None, "Hello World", packed=packed), bad=b"this is not a pdf at all 12345", none=None or b""), ocr=lambda content, page: "seen" if page == 2 else 1 / 0)
    rows = {(r["doc_path"][4:-4], r["page_number"]): r for r in got.collect()}
    assert rows["mixed", 1]["text"].strip() == "Test Document Content\nline two" and rows["mixed", 1]["page_width"] == 600
    assert rows["mixed", 2]["ocr_text"] == "seen" and rows["mixed", 2]["n_images"] == 1 and rows["mixed", 1]["ocr_text"] is None
    assert rows["mixed", 1]["chars"][0]["x0"] == 72 and rows["mixed", 1]["chars"][0]["size"] == 12
    assert rows["bad", None]["error"] and rows["none", None]["error"]
    methods = [(r["page_number"], r["method"], r["has_text"]) for r in extract.page_results(got).orderBy("page_number").collect()]
    assert methods == [(1, "pdfplumber", True), (2, "ocr", True), (3, "pdfplumber", True)]


def test_pdf_metadata_and_checks(spark, tmp_path):
    df = as_files(spark, a=pdf("x" * 100), locked=pdf("x" * 100, encrypted=True), broken=b"%PDF-1.4\n" + b"nothing here " * 20, twin=pdf("x" * 100))
    meta = {r["path"][4:-4]: r for r in files.pdf_metadata(df).collect()}
    assert (meta["a"]["title"], meta["a"]["author"], meta["a"]["pages"], meta["a"]["encrypted"]) == ("A (small) test", "Ä", 1, False)
    assert meta["locked"]["encrypted"] and meta["broken"]["pages"] == 0 and meta["broken"]["bytes"] > 100
    got = {r["path"][4:-4]: r["summary"] for r in validate.validate_files(validate.readable_pdf(df).withColumn("readable", ~F.col("path").contains("zzz")), extra=validate.integrity()).collect()}
    assert got == {"a": "Passed", "locked": "Failed: Encryption", "broken": "Failed: Corruption", "twin": "Failed: Duplicate (SHA-256)"}
    closed = validate.validate_files(df.withColumn("readable", F.lit(False)))
    assert {r["summary"] for r in closed.collect()} == {"Failed: Permissions"}
    assert files.pdf_files(spark, str(tmp_path / "missing")).count() == 0


def test_ingest_duplicates_over_batches(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()

    def run():
        q = ingest.ingest(spark, str(folder), str(tmp_path / "cp"), lambda df, _: seen.extend((r["path"][-5:], r["summary"]) for r in df.collect()))
        q.awaitTermination(120)

    for name, body in (("a", b"same"), ("b", b"same"), ("c", b"other")):
        (folder / f"{name}.pdf").write_bytes(b"%PDF-" + body * 50)
        run()
    assert sorted(seen) == [("a.pdf", "Passed"), ("b.pdf", "Failed: Duplicate (SHA-256)"), ("c.pdf", "Passed")]


def test_upsert_null_keys_and_newest(spark):
    old = spark.createDataFrame([(1, "a", "x", 1), (2, None, "lost", 1), (3, "b", "z", 1), (4, "b", "y", 2)], "id long, filename string, title string, at int")
    new = spark.createDataFrame([(9, "a", "new", 3), (8, None, "two", 1)], "id long, filename string, title string, at int")
    got = {tuple(r) for r in store.upsert(old, new, "filename", ("id",), newest="at").collect()}
    assert got == {(1, "a", "new", 3), (4, "b", "y", 2), (2, None, "lost", 1), (8, None, "two", 1)}


def test_tables_created_and_cascade(spark, tmp_path):
    t = store.create_tables(spark, str(tmp_path))
    assert store.create_tables(spark, str(tmp_path))["chunks"].columns == t["chunks"].columns and api.health(t).where("status = 'ok'").count() == 0
    rows = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id long, doc_id long")
    left = store.delete_documents({"chunks": rows, "logs": rows.drop("doc_id")}, spark.createDataFrame([(7,)], "doc_id long"))
    assert left["chunks"].count() == 2 and left["logs"].count() == 3
    vectors = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id long, chunk_id long")
    assert sorted(r["id"] for r in store.live(vectors, rows).collect()) == [1, 3]
    assert spark.createDataFrame([("/a.b/x.tar.pdf",), ("y",)], "p string").select(files.text_path(F.col("p"))).collect() == [("x.tar.txt",), ("y.txt",)]
    assert spark.range(1).select(safe_filename(F.lit("a/b:c.pdf"))).first()[0] == "a_b_c.pdf"


def test_section_tree(spark):
    rows = [(1, 1, None, 1, "top"), (2, 1, 1, 3, 'q"b'), (3, 1, 1, 2, "a"), (4, 1, 3, 0, "deep"), (5, 1, 99, 9, "lost"), (6, 1, 7, 5, "c1"), (7, 1, 6, 6, "c2"), (8, 2, 1, 0, "foreign"), (1, 1, None, 1, "top"), (None, 3, None, 1, "n"), (11, 3, 12, 0, "f"), (12, 3, None, None, None)]
    s = spark.createDataFrame(rows, "id long, doc_id long, parent_section_id long, order_index int, title string").withColumns({"section_type": F.lit("p"), "level": F.lit(1), "content": F.lit("}")})
    trees = {r["doc_id"]: json.loads(r["tree"]) for r in parse.section_tree(s).collect()}
    shape = lambda ns: [(n["title"], shape(n["children"])) for n in ns]
    assert shape(trees[1]) == [("top", [("a", [("deep", [])]), ('q"b', [])]), ("c1", []), ("c2", []), ("lost", [])]
    assert shape(trees[2]) == [("foreign", [])] and sorted(x["title"] or "" for x in trees[3]) == ["", "f", "n"]
    docs = spark.createDataFrame([(1, "a.pdf", '{"k": [1]}'), (5, "e.pdf", "broken{")], "id long, filename string, metadata_json string").withColumns({"title": F.lit("T"), "doc_type": F.lit(None).cast("string")})
    got = {r["id"]: json.loads(r["metadata_json"])["unified_representation"] for r in parse.represented(docs, parse.section_tree(s)).collect()}
    assert got[1]["document"]["metadata"] == {"k": [1]} and len(got[1]["sections"]) == 4 and got[5]["sections"] == [] and got[5]["document"]["metadata"] is None
    assert parse.section_tree(s.limit(0)).count() == 0


def test_index_written_and_loaded(spark, tmp_path):
    chunks = spark.createDataFrame([(1, 1, "apple pie"), (2, 1, "apple apple"), (3, 2, None), (3, 2, None)], "id long, doc_id long, content string")
    q = spark.createDataFrame([(1, "apple pie pie"), (2, ""), (3, None)], "query_id long, query string")
    se.index_chunks(chunks, path=str(tmp_path / "i"))
    want = se.bm25(q, chunks).collect()
    assert want and se.bm25(q, se.load_index(spark, str(tmp_path / "i"))).collect() == want
    v = embed.embed(chunks, "id")
    embed.append_vectors(v, str(tmp_path / "v"))
    embed.append_vectors(v.withColumn("embedding", F.array(F.lit(1.0).cast("float"))), str(tmp_path / "v"))
    assert embed.load_vectors(spark, str(tmp_path / "v")).count() == 4 and embed.load_vectors(spark, str(tmp_path / "w")).count() == 0


def test_rerank_and_parents(spark):
    hits = spark.createDataFrame([(1, 10, 9.0, 1, "nothing"), (1, 11, 8.0, 2, "red apple"), (1, 12, 7.0, 3, None)], "query_id long, chunk_id long, score double, rank int, content string")
    q = spark.createDataFrame([(1, "red apple")], "query_id long, query string")
    assert [(r["chunk_id"], r["score"]) for r in se.rerank(hits, q, 2).orderBy("rank").collect()] == [(11, 1.0), (10, 0.0)]

    def fails(_q, _t):
        raise RuntimeError

    assert [(r["chunk_id"], r["score"]) for r in se.rerank(hits, q, model=fails).orderBy("rank").collect()] == [(10, 9.0), (11, 8.0), (12, 7.0)]
    chunks = spark.createDataFrame([(10, 1, 5, 0, "x"), (11, 1, None, 1, "y")], "id long, doc_id long, section_id long, chunk_index int, content string")
    sections = spark.createDataFrame([(5, "parent text")], "id long, content string")
    got = {r["chunk_id"]: (r["expanded"], r["parent_content"]) for r in se.with_parents(hits.select("chunk_id"), chunks, sections).collect()}
    assert got == {10: ("x\n\ny", "parent text"), 11: ("x\n\ny", "")}


def test_fallback_and_log(spark):
    docs = spark.createDataFrame([(1, "The Quick brown fox"), (2, None), (3, "ab quick quick BROWN"), (3, "ab quick quick BROWN")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "quick brown"), (2, "ab"), (3, "zzz zzz"), (4, None), (5, "QUICK")], "query_id long, query string")
    found = se.text_fallback(q, docs).select("query_id", "doc_id").distinct().collect()
    assert {tuple(r) for r in found} == {(1, 1), (1, 3), (2, 3), (5, 1), (5, 3)}
    hits = spark.createDataFrame([(1, 7, 1, 2.0, "bm25")], "query_id long, chunk_id long, doc_id long, score double, source string")
    rows = api.search_with_fallback(hits, q.where("query IS NOT NULL"), docs.distinct())
    log = {r["query_id"]: (r["results_count"], r["strategy"]) for r in api.log_rows(q.where("query IS NOT NULL"), rows).collect()}
    assert log[1] == (1, "lexical (alpha=0.20)") and log[3] == (0, "lexical (alpha=0.20)") and log[5] == (2, "lexical (alpha=0.20) + fallback_txt_search")


def test_hits_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    hits = spark.createDataFrame([(1, 7, 1, 2.0, "bm25"), (2, 8, 1, 1.0, "bm25")], "query_id long, chunk_id long, doc_id long, score double, source string")
    docs = spark.createDataFrame([(1, "The Quick brown fox"), (2, "quick")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "brown"), (2, "fox"), (3, "QUICK")], "query_id long, query string")
    got = api.search_with_fallback(hits.mapInArrow(run, hits.schema), q, docs).collect()
    assert sorted((r["query_id"], r["source"]) for r in got) == [(1, "bm25"), (2, "bm25"), (3, "fallback_txt"), (3, "fallback_txt")]
    assert made.value == 2


def test_log_rows_from_hits_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    c = spark.createDataFrame([(i, 0, f"pump seal number{i}") for i in range(30)] + [(40 + i, 0, f"other words{i}") for i in range(70)], "id long, doc_id long, content string")
    q = spark.createDataFrame([(1, "how to seal a pump"), (2, "number7"), (3, "lost part"), (4, "nowhere at all")], "query_id long, query string")
    hits = se.bm25(q, c).select("query_id", "chunk_id", F.lit(0).alias("doc_id"), "score", F.lit("bm25").alias("source"))
    docs = spark.createDataFrame([(1, "a LOST part"), (2, "lost parts"), (3, None)], "doc_id long, text string")
    rows = api.log_rows(q, api.search_with_fallback(hits.mapInArrow(run, hits.schema), q, docs)).drop("latency_ms").collect()
    assert {r["query_id"]: (r["results_count"], r["strategy"]) for r in rows} == {
        1: (10, "hybrid (alpha=0.60)"), 2: (1, "lexical (alpha=0.20)"), 3: (2, "lexical (alpha=0.20) + fallback_txt_search"), 4: (0, "hybrid (alpha=0.70)"),
    }
    assert len(rows) == 4 and made.value == 11


@pytest.mark.parametrize("small", [False, True])
def test_fallback_equals_search_one_by_one(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(se, "QUERY_BYTES", 300)
    texts = ["", "a", "Ärger über\nGrößen", "xx größe yy " * 40 + "Ende\nZeile", "日本語の本文", "aaa", "ab" * 150 + "größe", "größe", "en\nde"]
    asked = ["größe", "ÄRGER", "", "a", "ä", "本", "日本語", "aab", "e\nz", "nowhere", "aaa", "aaaa", "n\nd", "ab"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(asked)) + [(99, None)], "query_id long, query string")
    want = set()
    for i, x in enumerate(asked):
        for k, t in enumerate(texts):
            at = t.lower().find(x.lower())
            if at >= 0:
                start = max(0, at - 100)
                want.add((i, k, start, "..." + t[start : start + len(x) + 200].replace("\n", " ") + "..."))
    got = se.text_fallback(q, docs).select("query_id", "doc_id", "start", "snippet").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert se.text_fallback(q.limit(0), docs).collect() == [] and se.text_fallback(q, docs.limit(0)).collect() == []


def test_bm25_parts_send_their_best_only(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = ["pump", "valve", "seal", "rod", "oil", *(f"w{i}" for i in range(20))]
    rows = [(i, i % 7, " ".join(rng.choice(vocabulary, int(rng.integers(1, 9))))) for i in range(400)]
    c = spark.createDataFrame([*rows, rows[0], (400, 1, None)], "id long, doc_id long, content string")
    q = spark.createDataFrame([(1, "Pump"), (2, "valve pump pump"), (3, "nothing"), (4, "oil seal rod"), (5, None)], "query_id long, query string")
    index = se.index_chunks(c)
    whole = [tuple(r) for r in se.bm25(q, index, 1000).collect()]
    best = sorted(x for x in whole if x[3] <= 5)
    assert sorted(tuple(r) for r in se.bm25(q, index, 5).collect()) == best and len(best) == 15
    monkeypatch.setattr(se, "QUERY_BYTES", 300)
    assert sorted(tuple(r) for r in se.bm25(q, index, 5).collect()) == best
    idf = {r["term"]: r["idf"] for r in index.terms.collect()}
    n, avgdl = index.size.first()
    texts = {i: t.split() for i, _, t in rows}
    for qid, words in ((1, ["pump"]), (2, ["valve", "pump", "pump"]), (4, ["oil", "seal", "rod"])):
        score = {i: sum(idf[w] * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avgdl)) for w in words) for i, t in texts.items()}
        found = {x[1]: x[2] for x in whole if x[0] == qid}
        assert found == pytest.approx({i: x for i, x in score.items() if round(x, 6) > 0}, abs=1e-6)
    assert n == 401


def test_queries_of_the_same_words_are_scored_once(spark, monkeypatch):
    c = spark.createDataFrame([(i, 0, "pump seal") for i in range(6)] + [(7, 0, "number7")] + [(40 + i, 0, f"other words{i}") for i in range(20)], "id long, doc_id long, content string")
    q = spark.createDataFrame([(1, "seal vs pump"), (2, "  Pump vs  seal"), (3, "pump pump vs seal"), (None, "vs seal pump"), (5, "number7"), (6, "nowhere")], "query_id long, query string")
    sent, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or broadcast(value))
    rows = [tuple(r) for r in se.bm25(q, c, 4).collect()]
    assert [max(len(x) for x in value if isinstance(x, np.ndarray)) for value in sent] == [8]  # words to score: 3 + 3 + 1 + 1
    of = {i: sorted(r[1:] for r in rows if r[0] == i) for i in (1, 2, 3, None, 5, 6)}
    assert of[1] == of[2] == of[None] and [(x[0], x[2]) for x in of[1]] == [(x[0], x[2]) for x in of[3]] == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert of[3][0][1] > of[1][0][1] > 0 and [(x[0], x[2]) for x in of[5]] == [(7, 1)] and of[6] == [] and len(rows) == 17


def test_texts_and_postings_are_cut_between_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(se, "SLICE_BYTES", 7)
    texts = ["left out", "", "größe", "a", "much longer than seven", "", "b", "c"]
    got = [bytes(data[start:end]).decode() for _, data, ends in se._sliced(pa.array(texts).slice(1)) for start, end in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == texts[1:] and [i for i, *_ in se._sliced(pa.array(texts).slice(1))] == [0, 2, 3, 4]
    monkeypatch.setattr(se, "POSTINGS", 3)
    ids = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[i : i + 2]), pa.array([7, 8][: len(ids[i : i + 2])], pa.int32()), pa.array([0.5, 1.5])], ["chunk_id", "t", "w"]) for i in range(0, len(ids), 2)]
    parts = [(list(u.to_pylist()), at.tolist()) for u, at, _, _ in se._whole_chunks(iter(batches))]
    assert [u[k] for u, at in parts for k in at] == ids and sorted(x for u, _ in parts for x in u) == [1, 2, 3, 4, 5] and len(parts) > 1


def test_knn_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((60, 4))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(90, None), (91, [1.0]), (92, [None, 1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(i, x[i].tolist()) for i in range(20)] + [(50, []), (51, None)], "query_id long, qv array<double>")
    whole = {tuple(r) for r in se.knn(q, v, 3).collect()}
    monkeypatch.setattr(se, "QUERY_BYTES", 400)
    assert {tuple(r) for r in se.knn(q, v, 3).collect()} == whole and len(whole) == 60


def test_page_layout_helpers(spark):
    chars = spark.createDataFrame([("p", float(x), s) for x, s in [(0, 8.0), (1, 9.0), (2, 9.0), (3, 12.0)]] + [("p", 4.0, None), ("q", 1.0, 7.0)] + [("r", float(x), 1.0) for x in [*range(21), 90]], "page string, x0 double, size double")
    assert {tuple(r) for r in extract.median_size(chars).collect()} == {("p", 9.0), ("q", 7.0), ("r", 1.0)}
    assert {tuple(r) for r in extract.multi_column(chars).collect()} == {("p", False), ("q", False), ("r", True)}
    t = spark.createDataFrame([([[["head", None], ["b\nc", " d "]], [], [["x" * 50]]],)], "t array<array<array<string>>>").select(extract.format_tables(F.col("t"))).first()[0]
    assert t == "head | \n" + "-" * 40 + "\nb c | d\n\n" + "x" * 50 + "\n" + "-" * 50


def test_section_chunks_and_enrichment(spark):
    s = spark.createDataFrame([(1, 1, 0, "a" * 3000, 4), (2, 1, 1, "annual report summary " * 2, None), (2, 1, 1, "annual report summary " * 2, None), (3, 1, 2, " ", 1), (4, 2, 0, None, 1)], "id long, doc_id long, order_index int, content string, page_start int")
    got = [(r["chunk_index"], r["page_number"], r["start_char"]) for r in chunk.chunk_sections(s).orderBy("chunk_index").collect()]
    assert got == [(0, 4, 0), (1, 4, 1792), (2, 0, 0)]
    docs = spark.createDataFrame([(1, "x"), (2, "kept")], "id long, doc_type string")
    rows = {r["id"]: (r["doc_type"], r["keywords"]) for r in enrich.enrich(docs, s.where("order_index = 1")).collect()}
    assert rows == {1: ("report", ["annual", "report", "summary"]), 2: ("kept", None)}


def test_rules_and_ids(spark):
    text = "Dr Anna Weber of Stermere Energy paid 3,000 EUR (12 %) on 3 May 2021. The 2nd Lake Como City deal."
    m = graph.rule_entities(spark.createDataFrame([(1, 1, text), (2, 1, None)], "id long, doc_id long, content string"))
    assert [(r["name"], r["label"]) for r in m.orderBy("sentence_no", "pos").collect()] == [
        ("Dr Anna Weber", "PERSON"), ("Stermere Energy", "ORG"), ("3,000 EUR", "MONEY"), ("12 %", "PERCENT"), ("3 May 2021", "DATE"), ("2nd", "ORDINAL"), ("Lake Como City", "LOC"),
    ]
    e = spark.createDataFrame([(1, "A", "B"), (1, "A", "Z")], "doc_id long, source_entity string, target_entity string").withColumn("confidence", F.lit(0.5))
    ids = spark.createDataFrame([(5, 1, "A"), (6, 1, "A"), (7, 1, "B"), (9, 2, "Z")], "id long, doc_id long, name string")
    assert sorted((r["target_entity"], r["source_id"], r["target_id"]) for r in graph.with_ids(e, ids).collect()) == [("B", 6, 7), ("Z", 6, None)]
    assert api.relationships(e, 1).count() == 2 and api.relationships(e, 2).count() == 0


def test_counters_and_scratch(spark):
    df, seen = pipeline.counted(spark.createDataFrame([(1, "a"), (2, None)], "id long, x string"), "run", "x IS NOT NULL")
    df.collect()
    assert seen.get == {"processed": 2, "succeeded": 1, "failed": 1}
    kept = materialise(spark.range(3))
    assert kept.count() == 3
    clean(spark)
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist"):
        kept.selectExpr("id + 1").collect()
