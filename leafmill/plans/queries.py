"""Queries over the test tables, by name; each takes (spark, sf_dir) and gives a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators import chunk, clean, embed, enrich, extract, graph, parse, validate
from leafmill.operators import hierarchy as hi
from leafmill.operators import search as se
from leafmill.plans import api
from leafmill.session import read_table
from leafmill.sources import files, store
from leafmill.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return hi.level_errors(read_table(spark, d, "sections"))


@query
def p1_paths(spark: SparkSession, d: str) -> DataFrame:
    return hi.hierarchy(read_table(spark, d, "sections")).select("id", "root_id", "depth", "in_cycle", F.array_join("path", "/").alias("path"))


@query
def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hi.descendants(hi.hierarchy(read_table(spark, d, "sections")))


@query
def p1_circle_descendants(spark: SparkSession, d: str) -> DataFrame:
    """The pairs among sections caught in circles, which p1_descendants by its SQL is without."""
    sections = read_table(spark, d, "sections")
    return hi.descendants(hi.circle_trees(sections, hi.hierarchy(sections, with_path=False)))


def _queries(spark: SparkSession, d: str) -> DataFrame:
    """Every different query ever asked, case aside: (query_id, query), the id being the first log row's."""
    return read_table(spark, d, "search_logs").where("query IS NOT NULL").groupBy(F.lower("query").alias("query")).agg(F.min("id").alias("query_id"))


def _vector_queries(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set: vectors whose id is divisible by 50."""
    return read_table(spark, d, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))


def _fused(spark: SparkSession, d: str) -> DataFrame:
    """BM25 over chunks fused with exact search over embeddings, a query's vector being that of its id among them."""
    q = _queries(spark, d).withColumn("r", se.route(F.col("query"))).withColumn("alpha", F.col("r.alpha"))
    emb = read_table(spark, d, "embeddings")
    pairs = q.where("alpha > 0").select("query_id", (F.col("query_id") % 500).alias("vec_id"))
    qv = pairs.join(emb, "vec_id").select("query_id", F.col("embedding").alias("qv"))
    dense = se.knn(qv, emb, 20)
    lexical = se.bm25(q.where("alpha < 1").select("query_id", "query"), read_table(spark, d, "chunks"), 20)
    return se.fuse(lexical, dense, q.select("query_id", "alpha"), 10)


@query
def intent_route(spark: SparkSession, d: str) -> DataFrame:
    return _queries(spark, d).select("query_id", se.route(F.col("query")).alias("r")).select("query_id", "r.intent", "r.strategy", "r.alpha")


@query
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return se.bm25(_queries(spark, d), read_table(spark, d, "chunks"))


@query
def bm25_filtered(spark: SparkSession, d: str) -> DataFrame:
    allowed = read_table(spark, d, "pdf_documents").where("status = 'indexed'").select(F.col("id").alias("doc_id"))
    return se.bm25(_queries(spark, d), read_table(spark, d, "chunks"), allowed=allowed)


@query
def knn_l2(spark: SparkSession, d: str) -> DataFrame:
    return se.knn(_vector_queries(spark, d), read_table(spark, d, "embeddings"))


@query
def knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    return se.knn(_vector_queries(spark, d), read_table(spark, d, "embeddings"), where=F.col("label") < 3)


@query
def rrf_fuse(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d)


@query
def hybrid_enriched(spark: SparkSession, d: str) -> DataFrame:
    hits = se.enrich(_fused(spark, d), *(read_table(spark, d, t) for t in ("chunks", "pdf_documents", "sections")))
    return hits.select("query_id", "rank", "chunk_id", "score", "source", "doc_id", "page_number", "filename", "document_title", "section_title")


@query
def context_expand(spark: SparkSession, d: str) -> DataFrame:
    return se.neighbours(read_table(spark, d, "chunks")).select("id", "doc_id", F.md5("expanded").alias("expanded_md5"), F.length("expanded").alias("expanded_length"))


@query
def fallback_text(spark: SparkSession, d: str) -> DataFrame:
    return se.text_fallback(_queries(spark, d), read_table(spark, d, "documents"))


@query
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", F.md5(clean.clean(F.col("text"), with_nfkc=False)).alias("clean_md5"))


@query
def clean_nfkc(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", clean.clean(F.col("text")).alias("clean_text"))


@query
def header_footer(spark: SparkSession, d: str) -> DataFrame:
    return clean.repeated_edges(read_table(spark, d, "page_results"))


@query
def drop_header_footer(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "page_results")
    docs = extract.full_text(pages).withColumnRenamed("text", "content")
    return clean.drop_repeated_edges(docs, clean.repeated_edges(pages)).select("doc_id", F.md5("content").alias("content_md5"))


@query
def parse_sections(spark: SparkSession, d: str) -> DataFrame:
    s = parse.parse_sections(read_table(spark, d, "pdf_documents"))
    return s.select("doc_id", "order_index", "section_type", "title", "level", F.md5("content").alias("content_md5"))


@query
def unified_tree(spark: SparkSession, d: str) -> DataFrame:
    t = parse.document_tree(read_table(spark, d, "sections").distinct())
    v = F.try_variant_get(F.try_parse_json("tree"), "$.sections", "array<struct<order_index:int,title:string>>")
    return t.withColumn("s", v).select("doc_id", F.size("s").alias("n_sections"), F.md5(F.array_join(F.array_sort(F.transform("s", lambda x: F.concat_ws(":", x["order_index"].cast("string"), x["title"]))), "|")).alias("titles_md5"))


@query
def chunk_docs(spark: SparkSession, d: str) -> DataFrame:
    return chunk.chunk_texts(read_table(spark, d, "pdf_documents")).drop("content")


@query
def doc_type(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", enrich.document_type(F.col("text")).alias("found_type"))


@query
def keywords_top10(spark: SparkSession, d: str) -> DataFrame:
    return enrich.keywords(read_table(spark, d, "documents"), "doc_id", "text")


@query
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", enrich.word_count(F.col("text")).alias("word_count"))


@query
def embed_chunks(spark: SparkSession, d: str) -> DataFrame:
    return embed.embed(read_table(spark, d, "chunks"))


@query
def rule_entities(spark: SparkSession, d: str) -> DataFrame:
    return graph.entity_counts(graph.usable_entities(graph.rule_entities(read_table(spark, d, "chunks"))))


def _brands(spark: SparkSession, d: str) -> DataFrame:
    """An order is a sentence, a line's brand an entity in it."""
    items, parts = read_table(spark, d, "lineitem"), read_table(spark, d, "part")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(F.col("l_orderkey").alias("sentence"), F.col("l_linenumber").alias("pos"), F.col("p_brand").alias("name"), F.col("l_suppkey").alias("doc_id"), F.lit("BRAND").alias("label"))


@query
def entity_upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.entity_counts(_brands(spark, d))


@query
def cooccurrence_edges(spark: SparkSession, d: str) -> DataFrame:
    e = graph.cooccurrences(_brands(spark, d), ["sentence"])
    return e.groupBy("source_entity", "target_entity", "relation_type").agg(F.count("*").alias("weight"))


@query
def edge_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return graph.edges_of(graph.cooccurrences(_brands(spark, d), ["sentence"]), "Brand#1").select("sentence", "source_entity", "target_entity", "confidence")


@query
def entity_name_search(spark: SparkSession, d: str) -> DataFrame:
    e = graph.entity_counts(_brands(spark, d)).groupBy("name").agg(F.sum("count").alias("count"))
    return graph.search_names(e, "bRAND#1")


@query
def entity_types(spark: SparkSession, d: str) -> DataFrame:
    return api.entity_types(read_table(spark, d, "sections").select(F.col("section_type").alias("entity_type")))


@query
def dedup_sha256(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "pdf_documents").where("content IS NOT NULL").select("id", "filename", "content").distinct()
    return validate.first_copies(docs, F.sha2("content", 256), ("filename", "id")).select("id", "filename", "is_first")


@query
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "pdf_documents").select("filename", "file_size_bytes", "content").distinct()
    magic = F.when(F.length("filename") % 7 == 0, F.lit("PK")).otherwise("%PDF-")
    files = docs.select(F.col("filename").alias("path"), F.col("file_size_bytes").alias("length"), F.concat(magic, F.coalesce("content", F.lit(""))).cast("binary").alias("content"))
    return validate.validate_files(files, max_bytes=250_000).select("path", "passed", "summary")


@query
def document_upsert(spark: SparkSession, d: str) -> DataFrame:
    old = read_table(spark, d, "pdf_documents").select("id", "filename", "title", "status")
    new = old.where("id % 10 = 0").select((F.col("id") + 1_000_000).alias("id"), F.when(F.col("id") % 20 == 0, F.col("filename")).otherwise(F.concat(F.lit("new-"), "filename")).alias("filename"), F.lit("revised").alias("title"), F.lit("extracted").alias("status"))
    return store.upsert(old, new, "filename", ("id",))


@query
def delete_reprocessed(spark: SparkSession, d: str) -> DataFrame:
    todo = read_table(spark, d, "pdf_documents").where("status <> 'indexed'").select(F.col("id").alias("doc_id"))
    return store.delete_by(read_table(spark, d, "chunks").select("id", "doc_id"), todo, "doc_id")


@query
def composed_text(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "pdf_documents").where("content IS NOT NULL").distinct()
    return docs.select("id", F.sha2(store.compose_text(F.col("title"), F.col("author"), F.col("page_count"), F.col("content")), 256).alias("text_sha256"))


@query
def missing_hashes(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "chunks").select("id", "doc_id", "content_hash").distinct()
    return store.missing_hashes(c, c.where("id % 3 = 0")).select("id", "doc_id", "content_hash")


@query
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.table_counts({t: read_table(spark, d, t) for t in ("pdf_documents", "sections", "chunks", "chunk_embeddings", "search_logs", "documents", "page_results")})


@query
def recent_logs(spark: SparkSession, d: str) -> DataFrame:
    return api.recent_logs(read_table(spark, d, "search_logs").distinct()).select("id", "query", "intent")


@query
def log_stats(spark: SparkSession, d: str) -> DataFrame:
    logs = read_table(spark, d, "search_logs").distinct()
    return logs.groupBy("strategy", "intent").agg(F.count("*").alias("n"), F.sum("results_count").alias("results"), F.sum(F.col("latency_ms").cast("decimal(18,3)")).cast("double").alias("total_latency"))


@query
def page_method_counts(spark: SparkSession, d: str) -> DataFrame:
    return extract.method_counts(read_table(spark, d, "page_results"))


@query
def page_text_agg(spark: SparkSession, d: str) -> DataFrame:
    return extract.full_text(read_table(spark, d, "page_results")).select("doc_id", F.md5("text").alias("text_md5"))


@query
def layout_elements(spark: SparkSession, d: str) -> DataFrame:
    return extract.layout_elements(read_table(spark, d, "page_results"))


@query
def layout_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.layout_summary(extract.layout_elements(read_table(spark, d, "page_results")))


@query
def page_flags(spark: SparkSession, d: str) -> DataFrame:
    return extract.page_flags(read_table(spark, d, "page_results"))


@query
def gutter_detect(spark: SparkSession, d: str) -> DataFrame:
    chars = read_table(spark, d, "events").select(F.col("user_id").alias("page"), F.abs("value").alias("x0"), F.lit(200.0).alias("width"))
    return extract.gutters(chars)


@query
def status_pending(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "pdf_documents").where("status <> 'indexed'").select("id", "filename").distinct()
    done = read_table(spark, d, "chunks").where("token_count > 0 AND page_number > 2").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(done, "id", "left_anti")


@query
def documents_by_status(spark: SparkSession, d: str) -> DataFrame:
    return api.documents(read_table(spark, d, "pdf_documents").distinct(), "indexed").select("id", "filename", "doc_type", "language")


@query
def representation_lookup(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


@query
def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return ingest.windowed_counts(read_table(spark, d, "events"))


@query
def cube_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query
def setops_docs(spark: SparkSession, d: str) -> DataFrame:
    docs, sections, chunks = (read_table(spark, d, t) for t in ("pdf_documents", "sections", "chunks"))
    of = lambda df: df.select(F.col("doc_id").alias("id"))
    return docs.select("id").intersect(of(sections)).unionByName(of(chunks).subtract(docs.select("id"))).distinct()


@query
def section_tree(spark: SparkSession, d: str) -> DataFrame:
    """Each document's nested tree, by its sections at the top and in all."""
    t = parse.section_tree(read_table(spark, d, "sections"))
    return t.select("doc_id", F.json_array_length("tree").alias("n_top"), F.size(F.regexp_extract_all("tree", F.lit('("children":\\[)'), F.lit(1))).alias("n_sections"))


@query
def representation_built(spark: SparkSession, d: str) -> DataFrame:
    """What a lookup finds in the metadata column after the unified representation is put there."""
    docs = read_table(spark, d, "pdf_documents").groupBy("id").agg(*(F.max(c).alias(c) for c in ("filename", "title", "doc_type", "metadata_json")))
    r = parse.represented(docs, parse.section_tree(read_table(spark, d, "sections")))
    v = F.try_parse_json("metadata_json")
    return r.select("id", F.try_variant_get(v, "$.unified_representation.document.filename", "string").alias("filename"), F.size(F.try_variant_get(v, "$.unified_representation.sections", "array<variant>")).alias("n_top"))


@query
def context_parent(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk as a hit, with its parent section's content."""
    chunks = read_table(spark, d, "chunks")
    hits = chunks.where("id IS NOT NULL").select(F.col("id").alias("chunk_id")).distinct()
    return se.with_parents(hits, chunks, read_table(spark, d, "sections")).select("chunk_id", F.md5("parent_content").alias("parent_md5"))


@query
def rerank_hits(spark: SparkSession, d: str) -> DataFrame:
    q, chunks = _queries(spark, d), read_table(spark, d, "chunks")
    texts = chunks.where("id IS NOT NULL").groupBy(F.col("id").alias("chunk_id")).agg(F.max("content").alias("content"))
    return se.rerank(se.bm25(q, chunks).join(texts, "chunk_id"), q, 5).select("query_id", "chunk_id", "score", "rank")


def _answered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q = _queries(spark, d)
    hits = se.bm25(q, read_table(spark, d, "chunks")).select("query_id", "chunk_id", F.lit(0).alias("doc_id"), "score", F.lit("bm25").alias("source"))
    return q, api.search_with_fallback(hits, q, read_table(spark, d, "documents"))


@query
def fallback_for_empty(spark: SparkSession, d: str) -> DataFrame:
    """Results of each query by where they are from: the text fallback answers only those without hits."""
    return _answered(spark, d)[1].groupBy("query_id", "source").agg(F.count("*").alias("n"))


@query
def search_log_rows(spark: SparkSession, d: str) -> DataFrame:
    q, found = _answered(spark, d)
    return api.log_rows(q, found).drop("latency_ms")


@query
def rule_relationships(spark: SparkSession, d: str) -> DataFrame:
    """Co-occurrences of entities in the sentences of chunks, with the ids of both."""
    mentions = graph.usable_entities(graph.rule_entities(read_table(spark, d, "chunks").select("id", "doc_id", "content").distinct()))
    entities = graph.entity_counts(mentions).withColumn("id", F.length("name") * 1000 + F.length("entity_type"))
    edges = graph.with_ids(graph.cooccurrences(mentions, ["doc_id", "chunk_id", "sentence_no"]), entities)
    return edges.groupBy("doc_id", "source_entity", "target_entity", "source_id", "target_id").agg(F.count("*").alias("n"))


@query
def chunk_sections(spark: SparkSession, d: str) -> DataFrame:
    return chunk.chunk_sections(read_table(spark, d, "sections")).drop("content")


@query
def enriched_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "pdf_documents").groupBy("id").agg(F.max("doc_type").alias("doc_type"))
    return enrich.enrich(docs, read_table(spark, d, "sections")).select("id", "doc_type", "word_count", F.array_join("keywords", " ").alias("keywords"))


@query
def chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.count_by(read_table(spark, d, "chunks"))


def _page_input(spark: SparkSession, d: str) -> DataFrame:
    """Pages in the shape of PAGE_INPUT: texts by their method; a table on even pages, an empty one on others; every third page without images."""
    p = read_table(spark, d, "page_results").groupBy("doc_id", "page_number").agg(F.max("method").alias("method"), F.max("text").alias("text"))
    cells = F.array(F.array(F.col("method"), F.lit(None).cast("string")), F.array(F.lit(" a\nb "), F.col("page_number").cast("string")))
    return p.select(
        F.col("doc_id").cast("string").alias("doc_path"), "page_number", F.when(F.col("method") == "pdfplumber", F.col("text")).alias("text"), F.when(F.col("method") == "ocr", F.col("text")).alias("ocr_text"),
        F.array(F.when(F.col("page_number") % 2 == 0, cells).otherwise(F.array().cast("array<array<string>>"))).alias("tables"), (F.col("page_number") % 3).alias("n_images"),
    )


@query
def page_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extract.page_results(_page_input(spark, d)).select("doc_path", "page_number", "method", "has_text", F.md5("text").alias("text_md5"))


@query
def page_tables(spark: SparkSession, d: str) -> DataFrame:
    return extract.page_tables(_page_input(spark, d))


@query
def drawn_elements(spark: SparkSession, d: str) -> DataFrame:
    return extract.drawn_elements(_page_input(spark, d))


@query
def order_tables(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines as a table by itself."""
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", F.array(F.col("l_linenumber").cast("string"), "l_returnflag", "l_linestatus").alias("r"))))
    t = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(rows, lambda s: s["r"]).alias("t"))
    return t.select("l_orderkey", F.md5(extract.format_tables(F.array("t"))).alias("table_md5"))


@query
def median_size(spark: SparkSession, d: str) -> DataFrame:
    return extract.median_size(read_table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("value").alias("size")))


@query
def multi_column(spark: SparkSession, d: str) -> DataFrame:
    return extract.multi_column(read_table(spark, d, "events").select(F.col("user_id").alias("page"), F.abs("value").alias("x0")))


@query
def delete_cascade(spark: SparkSession, d: str) -> DataFrame:
    gone = read_table(spark, d, "pdf_documents").where("status <> 'indexed'").select(F.col("id").alias("doc_id"))
    return store.table_counts(store.delete_documents({t: read_table(spark, d, t) for t in ("sections", "chunks", "chunk_embeddings", "page_results", "search_logs")}, gone))


@query
def live_vectors(spark: SparkSession, d: str) -> DataFrame:
    kept = store.live(read_table(spark, d, "chunk_embeddings"), read_table(spark, d, "chunks").where("token_count > 0"))
    return kept.groupBy("model_name", "level").agg(F.count("*").alias("n"))


@query
def text_paths(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "pdf_documents").select("id", files.text_path(F.concat(F.lit("/data/in.d/"), "filename")).alias("text_path")).distinct()


@query
def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user: events with at most 30 minutes between them."""
    return ingest.sessions(read_table(spark, d, "events"))


@query
def approx_distinct_users(spark: SparkSession, d: str) -> DataFrame:
    """Whether a sketch's count of users is within five times its stated error of the true one, by type of event."""
    e = read_table(spark, d, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("about"), F.count_distinct("user_id").alias("n"))
    return e.select("event_type", "n", (F.abs(F.col("about") - F.col("n")) <= 0.1 * F.col("n")).alias("near"))
