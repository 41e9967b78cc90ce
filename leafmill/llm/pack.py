"""Filling containers of fixed capacity, best fit first, largest items first.

Best-fit decreasing looks at nothing but sizes, and there are no more sizes than the capacity has units. So the whole
corpus is packed exactly as if item by item, from the number of items of each size alone: the items of one size are placed in runs, each
run filling a range of containers with equal room left. The plan's runs are then looked up for each item by its rank
among the items of its size; the ranks come from one range-partitioned sort and the partitions' offsets. No task ever sees a whole size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.encode import TOKENIZERS, VOCABULARY, count_tokens
from leafmill.session import materialise, shuffle_partitions

CAPACITY = 4096
MAX_SHARED_RUNS = 500_000


class RoomTree:
    """A segment tree over the room left, 0 to capacity; a leaf is set while an open container has exactly that room."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.set = bytearray(2 * self.size)

    def mark(self, room: int, on: bool) -> None:
        i = room + self.size
        self.set[i] = on
        while i > 1:
            i >>= 1
            self.set[i] = self.set[2 * i] | self.set[2 * i + 1]

    def tightest(self, need: int) -> int:
        """The least room of at least `need` that an open container has; -1 if none has."""
        i = need + self.size
        if self.set[i]:
            return need
        while i > 1:
            if not i & 1 and self.set[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.set[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (size, first rank, items, first container, items a container), and how many containers there are.

    The same containers' contents as placing the items one by one into the tightest open container: an item put into the
    tightest one leaves it the tightest for the next of its size, until it has no more room for that size.
    """
    tree = RoomTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    made = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not open_.setdefault(room, []):
                tree.mark(room, True)
            open_[room].append((first, n))

    for size in sorted(counts, reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} is not within 1 to {capacity}")
        left, rank = counts[size], 0
        while left:
            room = tree.tightest(size)
            if room < 0:
                per = min(capacity // size, left)
                room, first, n = capacity, made, left // per
                made += n
            else:
                first, n = open_[room].pop()
                per = min(room // size, left)
                take = min(n, left // per)
                if n > take:
                    open_[room].append((first + take, n - take))
                elif not open_[room]:
                    tree.mark(room, False)
                n = take
            runs.append((size, rank, n * per, first, per))
            put(room - per * size, first, n)
            rank, left = rank + n * per, left - n * per
    return runs, made


def _ranked(items: DataFrame) -> DataFrame:
    """Adds `part` and `at`: each item's partition of a sort by size and id, and its place among that partition's items of its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            sizes = b.column("size").to_numpy(zero_copy_only=False)
            if not len(sizes):
                continue
            starts = np.flatnonzero(np.diff(sizes, prepend=sizes[0] - 1))
            at = np.arange(len(sizes)) - np.repeat(starts, np.diff(starts, append=len(sizes)))
            first = int(starts[1]) if len(starts) > 1 else len(sizes)
            if sizes[0] == last:
                at[:first] += seen
            last, seen = sizes[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "piece_no", "size")), pa.array(np.full(len(sizes), part, np.int64)), pa.array(at, pa.int64())], ["id", "piece_no", "size", "part", "at"])

    kind = dict(items.dtypes)["id"]
    ranged = items.repartitionByRange(shuffle_partitions(items.sparkSession), "size", "id", "piece_no").sortWithinPartitions("size", "id", "piece_no")
    return materialise(ranged.mapInArrow(run, f"id {kind}, piece_no int, size long, part long, at long"))


def fill_containers(sizes: DataFrame, capacity: int = CAPACITY, id_col: str = "id", size_col: str = "n_tokens") -> DataFrame:
    """(id, piece_no, start, size, container_id) for items (id, size).

    An item over the capacity is cut into full containers and a rest; no other is. A null, zero or negative size takes no
    room: one row with a null container. Ids are taken to be unique; rows with equal ids are items of their own. Equal sizes are placed in order
    of id, so the result depends on the rows alone. An empty table gives an empty result.
    """
    spark = sizes.sparkSession
    n = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0))
    base = sizes.select(F.col(id_col).alias("id"), n.alias("n")).withColumn("n_pieces", F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)).cast("int"))
    cut = base.select("id", "n", "n_pieces", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece_no"))
    cut = cut.withColumn("size", F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece_no") * capacity))
    items = _ranked(cut.where("size > 0").select("id", "piece_no", "size"))
    # as many rows as there are partitions and sizes, whatever the corpus
    groups = items.groupBy("size", "part").count().collect()
    counts: dict[int, int] = {}
    offsets: dict[tuple[int, int], int] = {}
    for g in sorted(groups, key=lambda g: (g["part"], g["size"])):
        offsets[g["part"], g["size"]] = counts.get(g["size"], 0)
        counts[g["size"]] = counts.get(g["size"], 0) + g["count"]
    runs, _ = plan_packing(counts, capacity)
    off = spark.createDataFrame([(p, s, o) for (p, s), o in offsets.items()], "part long, size long, off long")
    if len(runs) <= MAX_SHARED_RUNS:
        ro = np.array(runs or [(0, 0, 0, 0, 1)], np.int64)
        ro = ro[np.lexsort((ro[:, 1], ro[:, 0]))]
        shared = spark.sparkContext.broadcast((ro, offsets))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ro, offsets = shared.value
            stride = int(ro[:, 1].max()) + 2
            keys = ro[:, 0] * stride + ro[:, 1]
            for b in batches:
                size, part, at = (b.column(c).to_numpy(zero_copy_only=False) for c in ("size", "part", "at"))
                rank = at + np.array([offsets[p, s] for p, s in zip(part.tolist(), size.tolist(), strict=True)], np.int64)
                k = np.searchsorted(keys, size * stride + np.minimum(rank, stride - 1), side="right") - 1
                box = ro[k, 3] + (rank - ro[k, 1]) // ro[k, 4]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("piece_no"), b.column("size"), pa.array(box, pa.int64())], ["id", "piece_no", "size", "container_id"])

        placed = items.mapInArrow(look_up, f"id {dict(items.dtypes)['id']}, piece_no int, size long, container_id long")
    else:
        table = spark.createDataFrame(runs, "r_size long, r_rank long, r_n long, r_box long, r_per long")
        ranked = items.join(off, ["part", "size"]).withColumn("rank", F.col("at") + F.col("off"))
        on = (F.col("size") == F.col("r_size")) & (F.col("rank") >= F.col("r_rank")) & (F.col("rank") < F.col("r_rank") + F.col("r_n"))
        box = F.col("r_box") + F.floor((F.col("rank") - F.col("r_rank")) / F.col("r_per")).cast("long")
        placed = ranked.join(table, on).select("id", "piece_no", "size", box.alias("container_id"))
    # cut items again from their sizes, so no join is needed: an item's pieces before its last are full
    full = F.col("piece_no") * F.lit(capacity).cast("long")
    nothing = base.where("n = 0").select("id", F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("container_id"))
    return placed.unionByName(nothing).select("id", "piece_no", full.alias("start"), "size", "container_id")


def pack_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(id, piece_no, start, size, container_id): texts, measured in tokens, in containers of `capacity` tokens. Repeated ids count once.

    Null and empty texts have size 0 and no container. `start` and `size` are in tokens.
    """
    sizes = count_tokens(df.where(F.col(id_col).isNotNull()), id_col, text_col, vocabulary).groupBy("id").agg(F.max("n_tokens").alias("n_tokens"))
    return fill_containers(materialise(sizes), capacity).withColumnRenamed("id", id_col)
