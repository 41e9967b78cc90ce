"""Overlapping chunks as a fold over offsets, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.functions.text import blank, strip

TARGET, OVERLAP, CHARS_PER_TOKEN = 2048, 256, 4


def chunk_offsets(c: Column, target: int = TARGET, overlap: int = OVERLAP) -> Column:
    """Array of (start, end), 0-based code points: an end falls after the last newline, else after the last '. ', of the window's second half; the next start lies `overlap` before."""
    if overlap > target // 2:
        raise ValueError("overlap may be at most half of the target: no progress otherwise")
    n = F.length(c)
    half = target // 2
    step = lambda a, end: F.struct(F.concat(a["cuts"], F.array(F.struct(a["start"].alias("start"), end.alias("end")))).alias("cuts"), F.when(end >= n, n).otherwise(F.when(end - overlap > 0, end - overlap).otherwise(end)).alias("start"), (end >= n).alias("done"))

    def one(a: Column, _: Column) -> Column:
        hard = a["start"] + target
        window = F.reverse(F.substring(c, a["start"] + half + 1, F.lit(half)))
        nl, dot = F.instr(window, "\n"), F.instr(window, " .")
        cut = F.when(nl > 0, hard - nl + 1).when(dot > 0, hard - dot + 1).otherwise(hard)
        end = F.when(hard >= n, n).otherwise(cut).cast("int")
        return F.when(a["done"], a).otherwise(step(a, end))

    zero = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("cuts"), F.lit(0).alias("start"), F.lit(False).alias("done"))
    rounds = F.sequence(F.lit(0), F.ceil(n / (half + 1 - overlap)).cast("int") + 1)
    long = F.aggregate(rounds, zero, one, lambda a: a["cuts"])
    return F.when(n <= target + overlap, F.array(F.struct(F.lit(0).alias("start"), n.alias("end")))).otherwise(long)


def chunk_texts(df: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(doc_id, chunk_index, content, content_hash, start_char, end_char, token_count) of every non-blank text; repeated rows once (the greatest text of an id)."""
    d = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(text_col).alias("t")).where(F.col("t").isNotNull() & ~blank(F.col("t")))
    e = d.select("doc_id", "t", F.posexplode(chunk_offsets(F.col("t"))).alias("chunk_index", "c"))
    e = e.withColumn("content", strip(F.expr("substring(t, c.start + 1, c.end - c.start)")))
    return _record(e, F.col("c.start"))


def _record(e: DataFrame, start: Column, *more: str) -> DataFrame:
    return e.select(
        "doc_id", "chunk_index", "content", F.sha2("content", 256).alias("content_hash"), start.alias("start_char"), (start + F.length("content")).alias("end_char"), F.floor(F.length("content") / CHARS_PER_TOKEN).cast("int").alias("token_count"), *more,
    )


def chunk_sections(sections: DataFrame) -> DataFrame:
    """Chunks of (doc_id, order_index, content) rows, with `page_number` their section's page_start, 0 where it has none; chunk_index runs on through a document's sections.

    How many chunks the sections before have is summed up over one small row a section, never over texts. Null and blank contents have no chunk; rows of one place in a document go by content.
    """
    page = F.coalesce("page_start", F.lit(0)) if "page_start" in sections.columns else F.lit(0)
    s = sections.where("doc_id IS NOT NULL AND content IS NOT NULL").where(~blank(F.col("content"))).select("doc_id", "order_index", page.cast("int").alias("page_number"), F.col("content").alias("t"), chunk_offsets(F.col("content")).alias("cuts"), F.sha2("content", 256).alias("_h"))
    sizes = s.groupBy("doc_id", "order_index", "_h").agg(F.max(F.size("cuts")).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(W.partitionBy("doc_id").orderBy("order_index", "_h")) - F.col("n")).drop("n")
    once = s.groupBy("doc_id", "order_index", "_h").agg(F.min("page_number").alias("page_number"), F.any_value("t").alias("t"))
    e = once.join(before, ["doc_id", "order_index", "_h"]).select("doc_id", "order_index", "page_number", "t", "before", F.posexplode(chunk_offsets(F.col("t"))).alias("k", "c"))
    e = e.withColumn("content", strip(F.expr("substring(t, c.start + 1, c.end - c.start)"))).withColumn("chunk_index", (F.col("before") + F.col("k")).cast("int"))
    return _record(e, F.col("c.start"), "page_number")
