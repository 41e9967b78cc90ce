"""Incremental ingestion: a file stream, validated and de-duplicated, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.validate import validate_files
from leafmill.sources.files import pdf_files


def ingest(spark: SparkSession, folder: str, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """All files not seen yet, once: `sink` gets (verdicts, batch number). A file's content is taken once over all batches and runs on a checkpoint; within one, the first path wins.

    The digests taken lie beside the checkpoint, one folder a batch, so a batch run again after a failure replaces its own and is compared with those of the others only.
    The stream itself keeps no state but the source's list of files.
    """
    taken = f"{checkpoint}/taken"

    def batch(df: DataFrame, number: int) -> None:
        spark.createDataFrame([], "sha256 string").write.mode("ignore").parquet(f"{taken}/batch=-1")
        known = spark.read.schema("sha256 string, batch long").parquet(taken).where(F.col("batch") != number)
        verdicts = validate_files(df, known=known).persist()
        try:
            verdicts.where("passed").select("sha256").write.mode("overwrite").parquet(f"{taken}/batch={number}")
            sink(verdicts, number)
        finally:
            verdicts.unpersist()

    return pdf_files(spark, folder, stream=True).writeStream.option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).foreachBatch(batch).start()


def sessions(events: DataFrame, time: str = "ts", by: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(key, start, n): runs of a key's events with less than `gap` between them; the same on streams and on tables."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("start"), "n")


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts a window and key, with a watermark; the same on streams and on tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
