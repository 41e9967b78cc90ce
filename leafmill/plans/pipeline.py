"""Set-based enrichment of all pending documents: clean, parse, chunk, embed, entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leafmill.operators import chunk, clean, embed, enrich, graph, parse
from leafmill.session import materialise


def enrich_documents(documents: DataFrame, status: str = "extracted") -> dict[str, DataFrame]:
    """Tables made of the documents in `status`: documents (with type, status 'indexed'), sections, chunks, embeddings, entities, relationships. Sections and chunks are written once."""
    todo = documents.where(F.col("status") == status)
    cleaned = todo.withColumn("content", clean.clean(F.col("content")))
    sections = materialise(parse.parse_sections(cleaned).withColumn("id", F.xxhash64("doc_id", "order_index")))
    chunks = materialise(chunk.chunk_sections(sections).withColumn("id", F.xxhash64("doc_id", "chunk_index")))
    mentions = graph.usable_entities(graph.rule_entities(chunks))
    edges = graph.cooccurrences(mentions, ["doc_id", "chunk_id", "sentence_no"])
    entities = graph.entity_counts(mentions).withColumn("id", F.xxhash64("doc_id", "name", "entity_type"))
    return {
        "documents": enrich.enrich(cleaned, sections).withColumn("status", F.lit("indexed")),
        "sections": sections,
        "chunks": chunks,
        "embeddings": embed.embed(chunks),
        "entities": entities,
        "relationships": graph.with_ids(edges, entities),
    }


def counted(df: DataFrame, name: str, ok: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame and what is counted as it runs, at no extra pass: rows in all, and those that `ok` says succeeded and failed; read with `.get` after an action."""
    seen = Observation(name)
    good = F.expr(ok) if ok else F.lit(True)
    return df.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(good).alias("succeeded"), F.count_if(~F.coalesce(good, F.lit(False))).alias("failed")), seen
