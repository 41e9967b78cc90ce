"""Cleaner, parser, chunker, retrieval, layout, graph and store on small fixtures, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions.text import human_size, md5_mod, title_case
from leafmill.operators import chunk, clean, embed, enrich, extract, graph, parse, validate
from leafmill.operators import search as se
from leafmill.plans import api, pipeline
from leafmill.sources import store
from leafmill.streaming import ingest


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("beneﬁt", "benefit"), ("pro-\ngramming is fun", "programming is fun"), ("hello    world\t\tfoo", "hello world foo"), ("Some text\n42\nMore text", "Some text\nMore text"),
        ("Some text\n— 5 —\nMore text", "Some text\nMore text"), ("Hello\x00\x01\x02World", "HelloWorld"), ("", ""), ("   ", ""), (None, None), ("a\n\n\n\n\n\nb", "a\n\n\nb"), ("x Page 7 of 50 y\nPage 7 of 50", "x Page 7 of 50 y"), ("ok 😀 ###$$ fine", "ok fine"),
    ],
)
def test_clean(spark, text, want):
    assert one(spark, clean.clean, text) == want


def test_repeated_edges(spark):
    rows = [(1, p, f"ACME Report\nContent {p}") for p in range(5)] + [(2, p, "Same\nx") for p in range(2)] + [(3, p, ("Head\n" if p < 3 else "") + f"body {p}\nend {p}") for p in range(10)] + [(1, 0, "ACME Report\nContent 0"), (4, 1, None)]
    pages = spark.createDataFrame(rows, "doc_id long, page_number int, text string")
    edges = clean.repeated_edges(pages)
    assert {tuple(r) for r in edges.collect()} == {(1, "ACME Report")}
    docs = extract.full_text(pages).withColumnRenamed("text", "content")
    assert "ACME" not in clean.drop_repeated_edges(docs, edges).where("doc_id = 1").first()["content"]


def sections_of(kinds):
    """A direct restatement of block building over typed lines."""
    out, heading, level, block, kind = [("paragraph", "Document Root", "", 0)], "Document Root", 0, [], None

    def flush():
        nonlocal block, kind
        if block:
            out.append((kind, heading, "\n".join(block), level + 1))
        block, kind = [], None

    for t, line in kinds:
        if t[0] == "h":
            flush()
            heading, level = line, int(t[1])
            out.append(("heading", line, line, level))
        else:
            if block and t != kind:
                flush()
                kind = t
            block.append(line)
            kind = kind or "paragraph"
    flush()
    return out


def test_parse_random_lines(spark):
    rng, samples = random.Random(1), {"h1": "1. Introduction Text", "h2": "1.1 Background Notes", "h3": "1.1.1 History Notes", "list_item": "- an item", "caption": "Figure 3 shows", "paragraph": "some plain text."}
    docs, want = [], {}
    for i in range(60):
        kinds = [(t, samples[t]) for t in rng.choices(list(samples), k=rng.randrange(12))]
        docs.append((i, "\n\n".join(f"  {line} " for _, line in kinds)))
        want[i] = sections_of(kinds)
    got = {}
    for r in parse.parse_sections(spark.createDataFrame([*docs, docs[0], (None, "x")], "id long, content string")).orderBy("doc_id", "order_index").collect():
        got.setdefault(r["doc_id"], []).append((r["section_type"], r["title"], r["content"], r["level"]))
    assert got == want


def test_line_types(spark):
    for line, want in {"EXECUTIVE SUMMARY": "h1", "2022 2023": "h1", "-" * 40: "h1", "Table 3 x": "caption", "1) x": "list_item", "IV. Results Part": "h1", "a plain line": "paragraph"}.items():
        assert one(spark, parse.line_type, line) == want, line


def chunks_of(t, target=2048, overlap=256):
    if len(t) <= target + overlap:
        return [(0, len(t))]
    out, s = [], 0
    while True:
        e = s + target
        if e >= len(t):
            return [*out, (s, len(t))]
        nl, dot = t.rfind("\n", s + target // 2, e), t.rfind(". ", s + target // 2, e)
        e = nl + 1 if nl >= 0 else dot + 2 if dot >= 0 else e
        out.append((s, e))
        s = e - overlap if e - overlap > 0 else e


def test_chunk_offsets(spark):
    rng = random.Random(2)
    texts = ["x" * n for n in (1, 2304, 2305, 4096, 9000)] + ["".join(rng.choice(["word ", "é", ". ", "\n", "abc"]) for _ in range(rng.randrange(200, 4000))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").select("id", chunk.chunk_offsets(F.col("t")).alias("c"))
    for r in df.collect():
        assert [(c["start"], c["end"]) for c in r["c"]] == chunks_of(texts[r["id"]])
    with pytest.raises(ValueError):
        chunk.chunk_offsets(F.lit("x"), 100, 60)


def test_chunk_texts_blank_null_repeated(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  \n"), (4, " a b "), (4, " a b ")], "id long, content string")
    assert [(r["doc_id"], r["content"], r["start_char"], r["end_char"]) for r in chunk.chunk_texts(df).collect()] == [(4, "a b", 0, 3)]


@pytest.mark.parametrize(("q", "want"), [("What is X vs Y", ("definition", 0.8)), ("tl;dr x", ("summary", 1.0)), ("tldr x", ("summary", 1.0)), ("how to x", ("procedure", 0.6)), ("a b versus c", ("comparison", 0.5)), ("a b", ("keyword", 0.2)), ("a b c", ("qa", 0.7)), ("", ("keyword", 0.2))])
def test_route(spark, q, want):
    r = one(spark, se.route, q)
    assert (r["intent"], r["alpha"]) == want


def test_bm25_small(spark):
    import math

    docs = {1: "apple apple pie", 2: "apple tart", 3: "Apple juice here", 4: "banana", 5: None}
    queries = {1: "apple banana banana", 2: "unknown", 3: "PIE"}
    toks = {i: (t or "").lower().split() for i, t in docs.items()}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = {w: sum(w in t for t in toks.values()) for t in toks.values() for w in t}
    raw = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    idf = {w: v if v >= 0 else 0.25 * sum(raw.values()) / len(raw) for w, v in raw.items()}
    want = set()
    for q, text in queries.items():
        for i, t in toks.items():
            s = sum(idf[w] * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in text.lower().split() if w in t)
            if round(s, 6) > 0:
                want.add((q, i, round(s, 6)))
    c = spark.createDataFrame([(i, i % 2, t) for i, t in [*docs.items(), (1, docs[1])]], "id long, doc_id long, content string")
    q = spark.createDataFrame(list(queries.items()), "query_id long, query string")
    assert {tuple(r)[:3] for r in se.bm25(q, c).collect()} == want
    only = se.bm25(q, c, allowed=spark.createDataFrame([(0,)], "doc_id long"))
    assert {tuple(r)[:3] for r in only.collect()} == {w for w in want if w[1] % 2 == 0}
    assert se.bm25(q, c.limit(0)).collect() == []


def test_fusion(spark):
    lists = [spark.createDataFrame(x, "query_id long, chunk_id long, rank int") for x in ([(1, 10, 1), (1, 11, 2)], [(1, 11, 1), (1, 12, 2)])]
    got = se.fuse(*lists, spark.createDataFrame([(1, 0.5)], "query_id long, alpha double")).orderBy("rank").collect()
    assert [(r["chunk_id"], r["source"]) for r in got] == [(11, "hybrid"), (10, "bm25"), (12, "vector")]
    assert got[0]["score"] == pytest.approx(1 / 62 + 1 / 61, abs=1e-9)


def test_validate(spark):
    body = b"%PDF-" + b"x" * 200
    rows = [("/d/b/one.pdf", body), ("/d/a/one.pdf", body), ("/d/x.txt", body), ("/d/e.pdf", b""), ("/d/c.pdf", b"no pdf at all" * 20), ("/d/A.PDF", body + b"1")]
    files = spark.createDataFrame([(p, len(b), b) for p, b in rows], "path string, length long, content binary")
    got = {r["path"]: r["summary"] for r in validate.validate_files(files).collect()}
    assert got == {"/d/b/one.pdf": "Failed: Duplicate (SHA-256)", "/d/a/one.pdf": "Passed", "/d/x.txt": "Failed: Extension", "/d/e.pdf": "Failed: MIME Type, File Size, Readable", "/d/c.pdf": "Failed: MIME Type", "/d/A.PDF": "Passed"}


def test_layout_and_pages(spark):
    pages = spark.createDataFrame([(1, 1, "Summary Part\n- see Figure 2\n12\nplain text here."), (1, 2, ""), (1, 3, None)], "doc_id long, page_number int, text string")
    kinds = [(r["line_no"], r["element_type"]) for r in extract.layout_elements(pages).orderBy("line_no", "element_type").collect()]
    assert kinds == [(0, "heading"), (1, "figure_reference"), (1, "list_item"), (2, "page_number"), (3, "paragraph")]
    assert all(r["has_header"] and r["has_footer"] for r in extract.page_flags(pages).collect())
    r = spark.range(1).select(extract.page_method(F.lit(" "), F.lit("seen")).alias("m")).first()["m"]
    assert (r["method"], r["text"]) == ("ocr", "seen")
    t = spark.createDataFrame([([["a", None], ["b\nc", " d "]],)], "t array<array<string>>").select(extract.format_table(F.col("t"), F.lit(3), F.lit(1))).first()[0]
    assert t == "[Table 1 — Page 3]\na | \n" + "-" * 40 + "\nb c | d"


def test_gutter(spark):
    chars = [("p", float(x), 100.0) for x in [*range(0, 40), *range(45, 100)] for _ in range(3)] + [("q", 1.0, 100.0), ("r", float("nan") if False else 5.0, 0.0)]
    got = {r["page"]: (r["start_bin"], r["end_bin"], r["split"]) for r in extract.gutters(spark.createDataFrame(chars, "page string, x0 double, width double")).collect()}
    assert got["p"] == (40, 44, 42.5) and "r" not in got


def test_graph(spark):
    m = spark.createDataFrame([(1, 1, 0, "acme corp", "ORG"), (1, 1, 1, "x", "ORG"), (1, 1, 2, "Paris", "GPE"), (1, 1, 3, "12", "CARDINAL"), (1, 1, 4, "acme corp", "ORG")], "doc_id long, sentence long, pos int, name string, label string")
    u = graph.usable_entities(m)
    assert {(r["name"], r["count"]) for r in graph.entity_counts(u).collect()} == {("Acme Corp", 2), ("Paris", 1)}
    assert sorted((r["source_entity"], r["target_entity"]) for r in graph.cooccurrences(u, ["doc_id", "sentence"]).collect()) == [("Acme Corp", "Paris"), ("Paris", "Acme Corp")]


def test_text_functions(spark):
    import hashlib

    for s in ("o'neill x-ray ÉCOLE", "a1b", ""):
        assert one(spark, title_case, s) == s.title()
    assert one(spark, md5_mod, "a.txt:0") == int(hashlib.md5(b"a.txt:0").hexdigest(), 16) % 10000
    assert one(spark, human_size, 14_889_000, "long") == "14.2 MB" and one(spark, human_size, 12, "long") == "12.0 B"
    assert one(spark, enrich.document_type, "annual report summary") == "report" and one(spark, enrich.document_type, "annual report") == "general"


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, filename string, title string")
    new = spark.createDataFrame([(9, "b", "z"), (10, "c", None)], "id long, filename string, title string")
    assert {tuple(r) for r in store.upsert(old, new, "filename", ("id",)).collect()} == {(1, "a", "x"), (2, "b", "z"), (10, "c", None)}


def test_pipeline_and_search(spark):
    text = "1. Introduction Part\n\nGreenford Energy met Acme Foods in 2020. Solar panels are cheap.\n\n- item one\n- item two"
    docs = spark.createDataFrame([(1, "a.pdf", "", "extracted", text), (2, "b.pdf", "T", "indexed", "x"), (3, "c.pdf", "T", "extracted", None)], "id long, filename string, title string, status string, content string")
    out = pipeline.enrich_documents(docs)
    assert {r["status"] for r in out["documents"].collect()} == {"indexed"} and out["sections"].count() == 5
    sections = out["sections"].selectExpr("doc_id", "doc_id * 100 + order_index AS id", "title")
    chunks = out["chunks"].selectExpr("id", "doc_id", "CAST(NULL AS LONG) AS section_id", "content", "0 AS page_number")
    emb = out["embeddings"].join(chunks.select(F.col("id").alias("chunk_id"), "doc_id"), "chunk_id")
    hits = api.search(spark, ["solar panels are cheap today"], chunks, docs, sections, emb).collect()
    assert hits and hits[0]["source"] == "hybrid" and hits[0]["document_title"] == "a.pdf"
    assert out["relationships"].count() >= 1
    assert embed.same_length(emb, 384).count() == emb.count()


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in ("a", "b"):
        (folder / f"{n}.pdf").write_bytes(b"%PDF-" + b"same" * 50)
    seen = []
    q = ingest.ingest(spark, str(folder), str(tmp_path / "cp"), lambda df, _: seen.extend((r["path"][-5:], r["passed"]) for r in df.collect()))
    q.awaitTermination(60)
    assert sorted(seen) == [("a.pdf", True), ("b.pdf", False)]


def test_entities_at_the_end_of_a_long_text(spark):
    text = "In 2019 it was so. " + "nothing to see here. " * 6000 + "Stermere Energy said so in 2021."
    rows = graph.rule_entities(spark.createDataFrame([(1, 1, text), (2, 1, None)], "id long, doc_id long, content string")).collect()
    assert [(r["sentence_no"], r["name"]) for r in rows] == [(0, "2019"), (6001, "Stermere Energy"), (6001, "2021")]
