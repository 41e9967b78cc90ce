"""Embeddings behind an interface: by default hashed words, L2-normalised; a trained model may take its place."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 384


def hashed_words(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One unit vector a text; a word's digest chooses its place and sign. All zero for a text without words."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for row, text in zip(out, texts, strict=True):
        for w in (text or "").lower().split():
            h = int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "little")
            row[h % dimensions] += 1 if h >> 63 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embed(df: DataFrame, id_col: str = "id", text_col: str = "content", model: Callable[[list[str]], np.ndarray] = hashed_words, model_name: str = "hashed-words") -> DataFrame:
    """(chunk_id, level, model_name, dimensions, embedding) by Arrow batches; `model` is sent to the workers and called once a batch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            v = model(p.iloc[:, 1].fillna("").tolist())
            yield pd.DataFrame({"chunk_id": p.iloc[:, 0], "level": "chunk", "model_name": model_name, "dimensions": v.shape[1], "embedding": list(v)})

    return df.select(F.col(id_col), F.col(text_col)).mapInPandas(run, "chunk_id long, level string, model_name string, dimensions int, embedding array<float>")


def append_vectors(new: DataFrame, path: str, dimensions: int = DIMENSIONS, vec_col: str = "embedding") -> None:
    """Vectors of the index's length added to it, each with its own id; others are left out."""
    same_length(new, dimensions, vec_col).write.mode("append").parquet(path)


def load_vectors(spark: SparkSession, path: str, schema: str = "chunk_id long, level string, model_name string, dimensions int, embedding array<float>") -> DataFrame:
    """The index at `path`; an empty one where there is none yet."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def same_length(df: DataFrame, dimensions: int, vec_col: str = "embedding") -> DataFrame:
    """Rows an index of that length takes; ids stay with their vectors."""
    return df.where(F.size(vec_col) == dimensions)
