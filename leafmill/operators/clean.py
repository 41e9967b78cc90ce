"""Cleaning of extracted text; each step a column expression, in this order."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafmill.functions.text import lines, strip

# A line that holds a page number only.
PAGE_NUMBER = r"^\p{IsWhite_Space}*(?:[-–—]?\p{IsWhite_Space}*[0-9]{1,4}\p{IsWhite_Space}*[-–—]?|[Pp]age\p{IsWhite_Space}+[0-9]+\p{IsWhite_Space}*(?:of\p{IsWhite_Space}+[0-9]+)?)\p{IsWhite_Space}*$"
MIN_REPEATS, REPEAT_SHARE = 3, 0.4


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no built-in for it."""
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def strip_blank_markers(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{4,}", "\n\n\n")


def strip_garbage(c: Column) -> Column:
    """Characters outside tab, line ends, printable ASCII and U+00A0 to U+FFFF go; runs of three or more signs become a space."""
    c = F.regexp_replace(c, r"[^\t\n\r\x20-\x7e\x{a0}-\x{ffff}]", "")
    return F.regexp_replace(c, r"[^\p{L}\p{N}_\p{IsWhite_Space}.,;:!?'\"-]{3,}", " ")


def join_broken_words(c: Column) -> Column:
    return F.regexp_replace(c, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")


def squeeze_lines(c: Column) -> Column:
    return F.array_join(F.transform(lines(c), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " "))), "\n")


def drop_page_numbers(c: Column) -> Column:
    return F.array_join(F.filter(lines(c), lambda x: ~x.rlike(PAGE_NUMBER)), "\n")


def clean(c: Column, with_nfkc: bool = True) -> Column:
    """All steps but the removal of repeated headers, which needs pages. Null stays null; blank text becomes empty."""
    c = nfkc(c) if with_nfkc else c
    for step in (strip_blank_markers, strip_garbage, join_broken_words, squeeze_lines, drop_page_numbers, strip):
        c = step(c)
    return c


def repeated_edges(pages: DataFrame, doc: str = "doc_id", page: str = "page_number", text: str = "text") -> DataFrame:
    """(doc, line): first and last lines that recur on at least max(3, 40 % of the pages) of a document of 3 pages or more. Pages without text count as pages; repeated rows once."""
    p = pages.groupBy(doc, page).agg(F.max(text).alias("_t")).withColumn("_l", F.when(strip(F.col("_t")) != "", lines(strip(F.col("_t")))))
    sizes = p.groupBy(doc).agg(F.count("*").alias("n")).where(f"n >= {MIN_REPEATS}")
    first = p.select(doc, strip(F.element_at("_l", 1)).alias("line"), F.lit("first").alias("edge"))
    last = p.select(doc, strip(F.element_at("_l", -1)).alias("line"), F.lit("last").alias("edge"))
    counted = first.unionByName(last).where("line <> ''").groupBy(doc, "edge", "line").agg(F.count("*").alias("k"))
    need = F.greatest(F.lit(MIN_REPEATS), F.floor(F.col("n") * REPEAT_SHARE))
    return counted.join(sizes, doc).where(F.col("k") >= need).select(doc, "line").distinct()


def drop_repeated_edges(docs: DataFrame, edges: DataFrame, doc: str = "doc_id", content: str = "content") -> DataFrame:
    """Every line of a document equal to one of its repeated edge lines goes; the lines are few, so they travel as one list a document."""
    flagged = edges.groupBy(doc).agg(F.collect_set("line").alias("_flagged"))
    kept = F.array_join(F.filter(lines(F.col(content)), lambda x: ~F.array_contains("_flagged", strip(x))), "\n")
    j = docs.join(flagged, doc, "left")
    return j.withColumn(content, F.when(F.col("_flagged").isNull(), F.col(content)).otherwise(kept)).drop("_flagged")
