"""Document types and keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.functions.text import count_of

# Words that tell a document's type, in order of precedence.
DOC_TYPES = {
    "report": ["report", "annual", "summary", "fiscal", "quarterly", "esg"],
    "paper": ["abstract", "methodology", "conclusion", "references", "arxiv"],
    "manual": ["manual", "guide", "instructions", "troubleshooting", "setup"],
    "financial": ["10-k", "10-q", "earnings", "balance sheet", "revenue"],
    "legal": ["agreement", "contract", "liability", "terms", "party"],
}
# Words that are no keywords.
STOP_WORDS = (
    "the and to of a in is that for it as was with be by on not he i this are or his from at which but have an had they you were "
    "their one all we can her has there been if more when will would who so no"
).split()
WORD = r"(?<![\p{L}\p{N}_])([a-z]{4,20})(?![\p{L}\p{N}_])"


def document_type(c: Column) -> Column:
    """The type with most hits if over 2, the earlier one on a tie; else 'general'."""
    # one lambda's variable holds the text in small letters, another's the scores, so each is worked out once
    scores = lambda low: F.array(*(F.struct(sum((count_of(low, w) for w in ws), F.lit(0)).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, (k, ws) in enumerate(DOC_TYPES.items())))
    best = F.transform(F.array(F.lower(c)), lambda low: F.array_max(scores(low)))[0]
    return F.transform(F.array(best), lambda b: F.when(b["n"] > 2, b["k"]).otherwise("general"))[0]


def full_texts(sections: DataFrame) -> DataFrame:
    """(doc_id, text): the contents of a document's sections in order, joined by one space; null and empty contents are left out, documents without any give no row. Repeated rows once."""
    one = sections.where("doc_id IS NOT NULL AND content <> ''").select("doc_id", "order_index", "id", "content").distinct() if "id" in sections.columns else sections.where("doc_id IS NOT NULL AND content <> ''").select("doc_id", "order_index", F.lit(0).alias("id"), "content").distinct()
    listed = F.array_sort(F.collect_list(F.struct("order_index", "id", "content")))  # together as long as the document's text, one row
    return one.groupBy("doc_id").agg(F.array_join(F.transform(listed, lambda s: s["content"]), " ").alias("text"))


def enrich(documents: DataFrame, sections: DataFrame, top: int = 10) -> DataFrame:
    """Documents with doc_type, keywords and word_count of their sections' text; a document without text keeps its doc_type and has no keywords."""
    texts = full_texts(sections).withColumnRenamed("doc_id", "id")
    words = keywords(texts, "id", "text", top).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("keywords"))
    found = texts.select("id", document_type(F.col("text")).alias("_type"), word_count(F.col("text")).alias("word_count"))
    j = documents.drop("keywords", "word_count").join(found, "id", "left").join(words, "id", "left")
    kind = F.coalesce("_type", "doc_type") if "doc_type" in documents.columns else F.col("_type")
    return j.withColumn("doc_type", kind).drop("_type")


def keywords(df: DataFrame, id_col: str, text_col: str, top: int = 10) -> DataFrame:
    """(id, rank, word, count): the words of 4 to 20 plain letters most frequent in each text; ties in order of first occurrence."""
    found = df.select(id_col, F.posexplode(F.regexp_extract_all(F.lower(text_col), F.lit(WORD), F.lit(1))).alias("pos", "word")).where(~F.col("word").isin(STOP_WORDS))
    counted = found.groupBy(id_col, "word").agg(F.count("*").alias("count"), F.min("pos").alias("at"))
    rank = F.row_number().over(W.partitionBy(id_col).orderBy(F.desc("count"), "at"))
    return counted.withColumn("rank", rank).where(f"rank <= {top}").select(id_col, "rank", "word", "count")


def word_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(1)))
