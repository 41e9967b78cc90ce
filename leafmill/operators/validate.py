"""Checks of raw files: an array of (name, passed, message) and one verdict a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MIN_BYTES, MAX_BYTES = 100, 524_288_000


def _check(name: str, ok: Column, why: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.coalesce(ok, F.lit(False)).alias("passed"), F.when(F.coalesce(ok, F.lit(False)), "").otherwise(why).alias("message"))


def readable_pdf(files: DataFrame) -> DataFrame:
    """Files with `pages` and `encrypted`, by the reader of sources.pdf: what the checks "Encryption" and "Corruption" need."""
    from leafmill.sources.files import pdf_metadata

    return files.join(pdf_metadata(files).select("path", "pages", "encrypted", "error"), "path")


def integrity() -> dict[str, Column]:
    """The checks of a `readable_pdf` result: not encrypted; readable with a page or more."""
    return {"Encryption": ~F.col("encrypted"), "Corruption": F.col("encrypted") | (F.col("error").isNull() & (F.col("pages") > 0))}


def validate_files(files: DataFrame, virus_free: Column | None = None, extra: dict[str, Column] | None = None, min_bytes: int = MIN_BYTES, max_bytes: int = MAX_BYTES, known: DataFrame | None = None) -> DataFrame:
    """(path, sha256, checks, passed, summary) of (path, length, content) rows, as the binary file source gives them.

    Cheap checks come first and end the matter; only files that pass them compete for being the first with their content, in order of path, part by part.
    A column `readable` is the permission check, where there is one. `known` (sha256) has contents taken before: no file is the first with those.
    """
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    cheap = [
        _check("MIME Type", F.substring("content", 1, 5) == F.lit("%PDF-").cast("binary"), "not a PDF"),
        _check("Extension", ext == ".pdf", "extension is not .pdf"),
        _check("File Size", F.col("length").between(min_bytes, max_bytes), "size out of range"),
        _check("Readable", F.length("content") > 0, "empty or unreadable"),
    ]
    if "readable" in files.columns:
        cheap.append(_check("Permissions", F.col("readable"), "no permission to read"))
    f = files.withColumn("cheap", F.array(*cheap)).withColumn("ok", F.forall("cheap", lambda c: c["passed"])).withColumn("sha256", F.sha2("content", 256))
    dear = [_check(k, v, k) for k, v in (extra or {}).items()] + [_check("Virus", F.lit(True) if virus_free is None else virus_free, "infected")]
    f = f.withColumn("dear", F.array(*dear)).select("path", "cheap", "dear", "ok", "sha256")
    first = f.where("ok").groupBy("sha256").agg(F.min(F.struct(F.split("path", "/").alias("parts"), "path")).alias("first"))
    if known is not None:
        first = first.join(known.select("sha256").distinct(), "sha256", "left_anti")
    j = f.join(first, "sha256", "left")
    dup = _check("Duplicate (SHA-256)", F.col("path") == F.col("first.path"), "same content as an earlier file")
    checks = F.when(F.col("ok"), F.concat("cheap", F.array(dup), "dear")).otherwise(F.col("cheap"))
    j = j.withColumn("checks", checks)
    failed = F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: c["name"])
    return j.select("path", "sha256", "checks", (F.size(failed) == 0).alias("passed"), F.when(F.size(failed) == 0, "Passed").otherwise(F.concat(F.lit("Failed: "), F.array_join(failed, ", "))).alias("summary"))


def first_copies(df: DataFrame, key: Column, order: tuple[str, ...]) -> DataFrame:
    """Adds `copy_no`: 1 for the first row of each key by `order`. A minimum a key decides it; no group is sorted in one task."""
    k = df.withColumn("_k", key)
    first = k.groupBy("_k").agg(F.min(F.struct(*order)).alias("_f"))
    return k.join(first, "_k", "left").withColumn("is_first", F.coalesce(F.struct(*order) == F.col("_f"), F.lit(True))).drop("_k", "_f")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    r = F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_r", r).where("_r = 1").drop("_r")
