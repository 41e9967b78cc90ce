"""What the service offers, as functions that give frames."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators import embed, graph
from leafmill.operators import search as se
from leafmill.session import materialise
from leafmill.sources import store


def search(
    spark: SparkSession, queries: list[str], chunks: DataFrame, documents: DataFrame, sections: DataFrame, embeddings: DataFrame, top_k: int = 10, doc_ids: list[int] | None = None, alpha: float | None = None,
    expand_context: bool = False, index: se.Bm25Index | None = None, model: Callable[[list[str], list[str]], np.ndarray] | None = None,
) -> DataFrame:
    """Ranked, enriched hits of a batch of queries: routed, BM25 and vectors fused. An empty `doc_ids` is no restriction. `embeddings` has (chunk_id, doc_id, embedding).

    `index` is a BM25 index of the chunks made before; `model` reranks; `expand_context` adds neighbours' and parents' contents.
    """
    q = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    routed = _routed(q, alpha)
    allowed = spark.createDataFrame([(x,) for x in doc_ids], "doc_id long") if doc_ids else None
    vectors = embed.embed(q, "query_id", "query").select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("qv"))
    lexical = se.bm25(q.join(routed.where("alpha < 1").select("query_id"), "query_id"), index or chunks, 2 * top_k, allowed=allowed)
    pool = embeddings if allowed is None else embeddings.join(allowed, "doc_id", "left_semi")
    dense = se.knn(vectors.join(routed.where("alpha > 0").select("query_id"), "query_id"), pool, 2 * top_k, "chunk_id")
    hits = se.enrich(se.fuse(lexical, dense, routed.select("query_id", "alpha"), top_k), chunks, documents, sections)
    if expand_context or model is not None:
        hits = se.with_parents(hits, chunks, sections)
    if model is not None:
        hits = se.rerank(hits, q, top_k, model)
    if not expand_context:
        hits = hits.drop("content", "expanded", "parent_content")
    return hits.orderBy("query_id", "rank")


def _routed(q: DataFrame, alpha: float | None) -> DataFrame:
    r = q.withColumn("r", se.route(F.col("query"))).select("query_id", "query", "r.intent", "r.strategy", F.lit(alpha).cast("double").alias("given"), F.col("r.alpha").alias("a"))
    return r.withColumn("alpha", F.coalesce("given", "a")).drop("given", "a")


def search_with_fallback(hits: DataFrame, queries: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, chunk_id, doc_id, score, source, snippet): hits as they are; for the queries without any, every text that holds the query, with score 1.0, document 0 and source fallback_txt."""
    own = materialise(hits.select("query_id", F.col("chunk_id").cast("long"), F.col("doc_id").cast("long"), F.col("score").cast("double"), "source", F.lit(None).cast("string").alias("snippet")))
    without = queries.join(own.select("query_id").distinct(), "query_id", "left_anti")
    more = se.text_fallback(without, texts, id_col, text_col)
    return own.unionByName(more.select("query_id", F.col("result_id").cast("long").alias("chunk_id"), F.lit(0).cast("long").alias("doc_id"), F.lit(1.0).alias("score"), F.lit("fallback_txt").alias("source"), "snippet"))


def log_rows(queries: DataFrame, results: DataFrame, latency_ms: float | None = None, alpha: float | None = None) -> DataFrame:
    """A row for the search log of each query: (query_id, query, intent, results_count, latency_ms, strategy), the strategy with its alpha and, where the text fallback gave the results, that."""
    r = results.groupBy("query_id").agg(F.count("*").alias("n"), F.max(F.col("source") == "fallback_txt").alias("fell"))
    j = _routed(queries, alpha).join(r, "query_id", "left")
    strategy = F.concat(F.format_string("%s (alpha=%.2f)", "strategy", "alpha"), F.when(F.col("fell"), " + fallback_txt_search").otherwise(""))
    return j.select("query_id", "query", "intent", F.coalesce("n", F.lit(0)).cast("int").alias("results_count"), F.lit(latency_ms).cast("double").alias("latency_ms"), strategy.alias("strategy"))


def results(hits: DataFrame) -> DataFrame:
    """What the service shows of its hits: all but internal columns."""
    return hits.drop("highlights", "metadata")


def health(tables: dict[str, DataFrame]) -> DataFrame:
    """(status, table_name, n): 'ok' and the rows of each table, 'empty' for one without any."""
    return store.table_counts(tables).select(F.when(F.col("n") > 0, "ok").otherwise("empty").alias("status"), "table_name", "n")


def relationships(edges: DataFrame, doc_id: int) -> DataFrame:
    return graph.edges_in(edges, doc_id)


def documents(df: DataFrame, status: str | None = None) -> DataFrame:
    return (df.where(F.col("status") == status) if status else df).orderBy("id")


def document(df: DataFrame, id_: int) -> DataFrame:
    return df.where(F.col("id") == id_)


def representation(df: DataFrame, id_: int) -> DataFrame:
    """The unified representation kept in a document's JSON column; no row where there is none or the JSON is broken."""
    v = F.try_variant_get(F.try_parse_json("metadata_json"), "$.unified_representation", "string")
    return df.where(F.col("id") == id_).select("id", v.alias("representation")).where("representation IS NOT NULL")


def recent_logs(logs: DataFrame, limit: int = 50) -> DataFrame:
    return logs.orderBy(F.desc("id")).limit(limit)


def entities(df: DataFrame, doc_id: int, entity_type: str | None = None) -> DataFrame:
    df = df.where(F.col("doc_id") == doc_id)
    return (df.where(F.col("entity_type") == entity_type) if entity_type else df).orderBy(F.desc("count"), "name")


def entity_types(df: DataFrame) -> DataFrame:
    return df.select("entity_type").distinct().orderBy("entity_type")


entity_search = graph.search_names
