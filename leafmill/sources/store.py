"""Tables out: upserts, appends, deletes as set operations, written beside the old version and swapped in by the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.schemas import TABLES


def upsert(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = ("id", "created_at"), newest: str | None = None) -> DataFrame:
    """Rows of `new` replace those of `old` with the same key, but for the columns in `keep`.

    One row a key is taken from each side, the one with the greatest `newest`, on a tie or without that column the greatest. Rows without a key match nothing and all stay.
    """
    cols = [c for c in old.columns if c != key]
    order = [newest, *(c for c in cols if c != newest)] if newest else cols
    one = lambda df: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order)).alias("_v"))
    j = one(old).withColumnRenamed("_v", "o").join(one(new).withColumnRenamed("_v", "n"), key, "full_outer")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep else F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    keyless = old.unionByName(new).where(F.col(key).isNull())
    return j.select(key, *(pick(c).alias(c) for c in cols)).select(*old.columns).unionByName(keyless)


def create_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of `schemas.TABLES` below `folder`, made where absent; columns that an older table lacks come out null."""
    out = {}
    for name, schema in TABLES.items():
        path = f"{folder}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        out[name] = spark.read.schema(schema).parquet(path)
    return out


def delete_documents(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Tables without all that belongs to the documents in `gone` (doc_id): rows of each table with a doc_id go; one key set serves all."""
    return {name: delete_by(df, gone, "doc_id") if "doc_id" in df.columns else df for name, df in tables.items()}


def live(vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """Vectors whose chunk is still there; those of documents (chunk_id null) stay."""
    kept = vectors.join(chunks.select(F.col("id").alias("chunk_id")).distinct(), "chunk_id", "left_semi")
    return kept.select(*vectors.columns).unionByName(vectors.where("chunk_id IS NULL"))


def delete_by(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return df.join(gone.select(key).distinct(), key, "left_anti")


def set_status(df: DataFrame, which: Column, status: str) -> DataFrame:
    return df.withColumn("status", F.when(which, status).otherwise(F.col("status")))


def compose_text(title: Column, author: Column, pages: Column, text: Column) -> Column:
    """The text as stored: a metadata block if there is a title or an author, a blank line, the cleaned text."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    block = F.concat_ws("\n", F.lit("--- Document Metadata ---"), F.when(has(title), F.concat(F.lit("Title: "), title)), F.when(has(author), F.concat(F.lit("Author: "), author)), F.concat(F.lit("Pages: "), pages.cast("string")), F.lit("--- End Metadata ---"))
    return F.when(has(title) | has(author), F.concat_ws("\n\n", block, text)).otherwise(text)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def missing_hashes(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows whose (content_hash, doc_id) isn't stored yet."""
    return new.join(old.select("content_hash", "doc_id").distinct(), ["content_hash", "doc_id"], "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n): rows a key; null keys count as one key."""
    return df.groupBy(key).agg(F.count("*").alias("n"))
