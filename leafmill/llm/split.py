"""Splitting oversized texts at natural boundaries."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.encode import automaton, share_vocabulary
from leafmill.session import broadcast_if_small, materialise

LIMIT, OVERLAP = 2304, 256

#: Boundaries from the best to the least: after a blank line, after a line, after a sentence, after white space.
_AFTER = (re.compile(r"\n\s*\n\s*"), re.compile(r"\n\s*"), re.compile(r"[.!?…。]['\"»”)\]]*\s+"), re.compile(r"\s+"))


def boundaries(text: str) -> list[list[int]]:
    """For each kind, the sorted offsets at which a piece may end (and the next begin). White space is what Python calls so."""
    return [[m.end() for m in p.finditer(text)] for p in _AFTER]


class Measure:
    """How much of a text lies before each offset, as prefix sums: characters, or tokens of a tokenizer by where they begin."""

    def __init__(self, text: str, before: np.ndarray | None = None) -> None:
        self.n, self.before = len(text), before

    @property
    def whole(self) -> int:
        return self.n if self.before is None else int(self.before[-1])

    def ahead(self, start: int, amount: int) -> int:
        """The last offset with at most `amount` between it and `start`, one character on at least."""
        if self.before is None:
            return min(self.n, start + amount)
        return max(start + 1, int(np.searchsorted(self.before, self.before[start] + amount, "right")) - 1)

    def back(self, end: int, amount: int) -> int:
        """The first offset with at most `amount` between it and `end`."""
        return max(0, end - amount) if self.before is None else min(end, int(np.searchsorted(self.before, self.before[end] - amount, "left")))


def token_offsets(tokens: list[bytes], text: str) -> np.ndarray:
    """Prefix sums over a text's offsets: tokens that begin before each. A token that begins inside a character counts from the next character on."""
    width = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(np.where(width < 0x80, 1, np.where(width < 0x800, 2, np.where(width < 0x10000, 3, 4))))
    begins = np.cumsum([0, *map(len, tokens)])[:-1]
    at = np.searchsorted(np.concatenate([[0], ends]), begins, "left")  # the character in which each begins, or the next
    return np.searchsorted(at, np.arange(len(text) + 1), "left") if len(text) else np.zeros(1, np.int64)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP, before: np.ndarray | None = None) -> list[tuple[int, int, bool]]:
    """(start, end, hard) of each piece of a text, in code points.

    `limit` and `overlap` are in characters, or, with the prefix sums `before` of `token_offsets`, in tokens as they lie in the whole text. A text within the limit is one
    piece, the empty text none. Else each piece ends at the last boundary of the best kind found in its upper half, or at the last boundary at all within
    the limit, found by binary search; white space after which a boundary stands may itself fall in two (a run of blanks longer than the limit is cut anywhere). The next piece
    starts at the first word boundary within `overlap` of that end, or exactly there if nothing natural would then be reachable. Only a run without
    white space longer than the limit is cut hard; every piece is at most `limit` long (one character may have more tokens than that) and together they cover the text.
    """
    if limit < 2 or not 0 <= overlap < limit:
        raise ValueError("limit must be at least 2 and overlap below it")
    n, size = len(text), Measure(text, before)
    if size.whole <= limit:
        return [(0, n, False)] if n else []
    # Blanks themselves are places to cut: a run of white space may end a piece anywhere inside it.
    places = boundaries(text)
    blanks = [i + 1 for i, c in enumerate(text) if c.isspace()]
    starts = sorted({*blanks, *(i - 1 for i in blanks)})  # also just before a blank
    out: list[tuple[int, int, bool]] = []
    start = reach = 0
    while True:
        high = size.ahead(start, limit)
        if high >= n:
            out.append((start, n, False))
            return out
        end, hard = 0, False
        low = max(reach, size.ahead(start, limit // 2))
        for kind in places:
            k = bisect_right(kind, high) - 1
            if k >= 0 and kind[k] > low:
                end = kind[k]
                break
        if not end:
            k = bisect_right(starts, high) - 1
            if k >= 0 and starts[k] > reach:
                end = starts[k]
            elif start < reach:
                start = reach  # give the overlap up: the next run needs the whole limit
                continue
            else:
                end, hard = high, True
        out.append((start, end, hard))
        first = size.back(end, overlap)
        k = bisect_left(places[-1], first)
        back = places[-1][k] if k < len(places[-1]) and places[-1][k] < end else first if hard else end
        start, reach = max(back, out[-1][0] + 1), end


_PIECE = "piece_no int, n_pieces int, start int, end int, hard boolean"


def split_texts(
    df: DataFrame, id_col: str = "id", text_col: str = "content", limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True, vocabulary: str | None = None
) -> DataFrame:
    """(id, piece_no, n_pieces, start, end, hard, text) of every text over the limit; sizes are counted from the text, never read from a column.

    With a `vocabulary` file, limit and overlap are in its tokens, else in characters. Texts within the limit, empty and null texts need no cut and give no row.
    Repeated rows count once: which ids have the same text twice is told by digests, and only those rows are shuffled. Other columns are
    ignored. `hard` marks a piece that ends inside a run without white space longer than the limit.
    """
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a token is one byte or more, so a text of at most `limit` bytes is within it
    big = rows.where(F.length("text") > limit) if vocabulary is None else rows.where(F.octet_length("text") > limit)
    seen = big.groupBy("id", F.md5("text")).agg(F.count("*").alias("n")).where("n > 1").select("id").distinct()
    again = broadcast_if_small(materialise(seen), 32)
    once = big.join(again, big["id"].eqNullSafe(again["id"]), "left_anti").unionByName(big.join(again, big["id"].eqNullSafe(again["id"]), "left_semi").distinct())
    shared = None if vocabulary is None else share_vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automaton(shared) if shared else None
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            from_, no, of, start, end, hard, said = [], [], [], [], [], [], []
            size = 0
            for i, t in enumerate(texts):
                before = token_offsets([model.words[x] for x in model.encode(t)], t) if model else None
                if before is not None and before[-1] <= limit:
                    continue
                cuts = pieces(t, limit, overlap, before)
                for k, (a, z, h) in enumerate(cuts):
                    from_.append(i), no.append(k), of.append(len(cuts)), start.append(a), end.append(z), hard.append(h), said.append(t[a:z] if with_text else None)
                    size += z - a
                if size > 4_000_000:  # pieces of long texts go out in several batches
                    yield _pieces_batch(ids, from_, no, of, start, end, hard, said, with_text)
                    from_, no, of, start, end, hard, said, size = [], [], [], [], [], [], [], 0
            yield _pieces_batch(ids, from_, no, of, start, end, hard, said, with_text)

    return once.select("id", "text").mapInArrow(run, f"id {kind}, {_PIECE}" + (", text string" if with_text else ""))


def _pieces_batch(ids: pa.Array, from_: list, no: list, of: list, start: list, end: list, hard: list, said: list, with_text: bool) -> pa.RecordBatch:
    cols = [ids.take(pa.array(from_, pa.int64())), *(pa.array(c, pa.int32()) for c in (no, of, start, end)), pa.array(hard, pa.bool_())]
    names = ["id", *(f.split()[0] for f in _PIECE.split(", "))]
    return pa.RecordBatch.from_arrays([*cols, pa.array(said, pa.string())] if with_text else cols, [*names, "text"] if with_text else names)


def rebuilt(parts: DataFrame) -> DataFrame:
    """(id, text): texts put together again from their pieces, each without what it repeats of the one before; other columns than those of `split_texts` keep pieces apart, as a table's name does."""
    keys = [c for c in parts.columns if c not in {"text", *(f.split()[0] for f in _PIECE.split(", "))}]
    listed = F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "text")))  # together hardly longer than the text
    said = lambda p, i: F.substring(p["text"], F.when(i > 0, F.get("l", i - 1)["end"] - p["start"]).otherwise(0) + 1, F.lit(1 << 30))
    return parts.groupBy(*keys).agg(listed.alias("l")).select(*keys, F.array_join(F.transform("l", said), "").alias("text"))


def split_kinds(df: DataFrame, id_col: str = "id", text_col: str = "content", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, kind) of every text over the limit: 'forced' if a piece had to be cut hard, else 'natural'.

    Whole rows are not shuffled for this: each text is cut where it lies and only (id, forced) is made distinct.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hard = [any(h for _, _, h in pieces(t, limit, overlap)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hard, pa.bool_())], ["id", "hard"])

    kind = dict(df.dtypes)[id_col]
    big = df.where(F.length(text_col) > limit).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = big.mapInArrow(run, f"id {kind}, hard boolean")
    return cut.groupBy("id").agg(F.max("hard").alias("hard")).select("id", F.when(F.col("hard"), "forced").otherwise("natural").alias("kind"))
