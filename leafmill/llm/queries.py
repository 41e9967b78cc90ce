"""Queries of the training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import encode, looks, pack, quality, scan, split, vectors
from leafmill.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def both_tables(one: Callable[[DataFrame, str], DataFrame], spark: SparkSession, d: str) -> DataFrame:
    """`one` over pdf_documents.content and over chunks.content, named in source_table."""
    parts = [one(read_table(spark, d, t).select("id", "content"), t).withColumn("source_table", F.lit(t)) for t in ("pdf_documents", "chunks")]
    return parts[0].unionByName(parts[1])


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return vectors.mutual(read_table(spark, d, "chunk_embeddings"))


@query
def p2_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return vectors.nearest(read_table(spark, d, "chunk_embeddings"))


@query
def p2_recall(spark: SparkSession, d: str) -> DataFrame:
    """How much of the true ten nearest p2_neighbours holds, by kind of vectors, for the vectors whose id is divisible by 50."""
    return vectors.recall(read_table(spark, d, "chunk_embeddings"))


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return scan.noisy_lines(read_table(spark, d, "page_results"))


@query
def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scan.repaired(read_table(spark, d, "page_results"), read_table(spark, d, "pdf_documents").select("id", "content"))


def _qualities(spark: SparkSession, d: str) -> DataFrame:
    texts = both_tables(lambda df, _: df, spark, d)
    return quality.classify(texts, read_table(spark, d, "common_words"), ("source_table", "id"))


@query
def p4_quality(spark: SparkSession, d: str) -> DataFrame:
    return _qualities(spark, d)


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _qualities(spark, d).where("kind <> 'prose'").select("source_table", "id", "kind")


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return both_tables(lambda df, _: split.split_kinds(df), spark, d).select("source_table", "id", "kind")


@query
def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return both_tables(lambda df, _: split.split_texts(df), spark, d)


@query
def p5_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Oversized texts put together again from their pieces."""
    return split.rebuilt(p5_pieces(spark, d)).select("source_table", "id", F.md5("text").alias("text_md5"))


@query
def p5_token_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of at most 512 tokens, each repeating up to 64 of the one before."""
    pieces = both_tables(lambda df, _: split.split_texts(df, limit=512, overlap=64, with_text=False, vocabulary=f"{encode.TOKENIZERS}/{encode.VOCABULARY}"), spark, d)
    return pieces


@query
def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_corpus(read_table(spark, d, "documents"))


@query
def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Texts decoded from their own token ids."""
    docs = read_table(spark, d, "documents").where("text IS NOT NULL")
    return encode.decode_corpus(encode.encode_corpus(docs)).select("doc_id", F.md5("text").alias("text_md5"))


@query
def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack.pack_texts(read_table(spark, d, "documents"))


@query
def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """One row: containers used, and how many any packing of these tokens needs at least."""
    used = p7_containers(spark, d).agg(F.count_distinct("container_id").alias("containers"), F.coalesce(F.sum("size"), F.lit(0)).alias("tokens"))
    return used.select("containers", F.ceil(F.col("tokens") / pack.CAPACITY).alias("at_least"))


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that had to be split: those with a second piece in the packing."""
    return pack.pack_texts(read_table(spark, d, "documents")).where("piece_no = 1").select("doc_id")


@query
def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    return looks.normalise_looks(read_table(spark, d, "documents"))


@query
def p8_classes(spark: SparkSession, d: str) -> DataFrame:
    return looks.look_classes(read_table(spark, d, "documents"))


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return looks.same_looks(read_table(spark, d, "documents"))
