"""A public tokenizer over a whole corpus."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from leafmill.llm.automaton import MergeAutomaton

#: The folder of the vocabulary files; a parameter of every operator, and of the environment for the queries.
TOKENIZERS = os.environ.get("LEAFMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"
MAX_VOCABULARY_BYTES = 16 << 20

_compiled: dict[int, MergeAutomaton] = {}


def share_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's bytes as a broadcast; its size is checked, and it doesn't depend on the corpus."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_VOCABULARY_BYTES} are broadcast")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def automaton(shared) -> MergeAutomaton:
    """The compiled automaton, once for each Python worker and vocabulary."""
    key = hash(shared.value)
    if key not in _compiled:
        _compiled[key] = MergeAutomaton(shared.value)
    return _compiled[key]


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(id, ids): the token ids of every row's text, without special tokens.

    Null and empty texts have the empty list. Every row is encoded where it lies: no shuffle. Repeated rows come out repeated; other
    columns are ignored, whatever their names.
    """
    shared = share_vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = automaton(shared).encode
        for b in batches:
            values, ends = array("i"), array("i", [0])
            for text in b.column(1).to_pylist():
                if text:
                    values.extend(encode(text))
                ends.append(len(values))
            lists = pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(values, np.int32) if values else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], [id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, ids array<int>")


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(id, n_tokens): how long each row's text is; null and empty texts have 0."""
    shared = share_vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = automaton(shared).count
        for b in batches:
            n = [count(t) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"])

    return df.select(id_col, text_col).mapInArrow(run, f"id {dict(df.dtypes)[id_col]}, n_tokens long")


def decode_corpus(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(id, text): the labels of each row's ids put together; the exact inverse of encoding but for null texts, which come back empty."""
    shared = share_vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = automaton(shared).decode
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x or []) for x in b.column(1).to_pylist()], pa.string())], [id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, text string")
