"""Parent-child rows to full hierarchies.

Rows that name their parent form trees of unknown depth. Each partition contracts its own parent chains to the first
ancestor outside it (a fragment exit); the exits' rows make a smaller quotient forest, which is solved the same way,
and the answers are carried back with one join a level. No step depends on how deep a chain is, and circles are found
wherever they lie: inside one partition by the contraction, across partitions in the quotient.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialise

_FAR = np.iinfo(np.int64).max

#: A fragment: the way from a row up to `exit`, the first parent outside the partition.
#: hops: steps to `exit`; seg_min: smallest id on the way, `exit` left out; top, top_hops: the last row before `exit` and
#: the steps to it; croot: smallest id of the circle the chain ends in; seg: ids from below `exit` down to the row.
_FRAGMENT = "id long, exit long, hops long, seg_min long, top long, top_hops long, croot long, seg array<long>"


def _contract(with_path: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        num = lambda c: t[c].combine_chunks().fill_null(_FAR).to_numpy(zero_copy_only=False).astype(np.int64)
        ids, exit_, hops, seg_min, top, top_hops, croot = (num(c) for c in ("id", "exit", "hops", "seg_min", "top", "top_hops", "croot"))
        n = len(ids)
        order = np.argsort(ids, kind="stable")
        at = np.searchsorted(ids[order], exit_)
        here = order[np.minimum(at, n - 1)]
        inside = (ids[here] == exit_) & (exit_ != _FAR) & (croot == _FAR)
        nxt = np.where(inside, here, np.arange(n))
        up = nxt.copy()
        dist = np.where(inside, hops, 0)
        low = np.where(inside, seg_min, _FAR)
        for _ in range(int(n).bit_length() + 1):  # pointer doubling: each round doubles the steps taken
            if not inside[nxt].any():
                break
            dist, low, nxt = dist + dist[nxt], np.minimum(low, low[nxt]), nxt[nxt]
        circle = inside[nxt]  # never left the partition: nxt is on the circle and low[nxt] spans all of it
        end = np.where(circle, 0, nxt)
        new_croot = np.where(circle, low[nxt], croot[end])
        new_exit = np.where(circle | (new_croot != _FAR), _FAR, exit_[end])
        some = lambda a, off: pa.array(a, pa.int64(), mask=off)
        segs: list = [None] * n
        if with_path:
            old = t["seg"].to_pylist()
            steps = np.where(circle, -1, dist)
            for i in np.argsort(steps, kind="stable").tolist():
                if not circle[i] and croot[end[i]] == _FAR:
                    segs[i] = segs[up[i]] + old[i] if inside[i] else old[i]
        off = circle | (new_croot != _FAR)
        out = {
            "id": pa.array(ids),
            "exit": some(new_exit, new_exit == _FAR),
            "hops": pa.array(np.where(off, 0, dist + hops[end])),
            "seg_min": pa.array(np.minimum(low, seg_min[end])),
            "top": pa.array(np.where(off, ids, top[end])),
            "top_hops": pa.array(np.where(off, 0, dist + top_hops[end])),
            "croot": some(new_croot, new_croot == _FAR),
            "seg": pa.array(segs, pa.list_(pa.int64())),
        }
        yield from pa.table(out).to_batches(max_chunksize=20_000)

    return run


def _splice(q: DataFrame, salt: int) -> tuple[DataFrame, DataFrame]:
    """Take an independent set of rows out of the quotient: their children point past them. Used where contraction by partition no longer shrinks it."""
    coin = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(salt)), F.lit(2))
    out_now = q.where((coin("id") == 1) & F.col("exit").isNotNull() & (coin("exit") == 0) & F.col("croot").isNull())
    past = out_now.select(*(F.col(c).alias(f"r_{c}") for c in out_now.columns))
    kept = q.join(out_now.select("id"), "id", "left_anti")
    j = kept.join(past, kept["exit"] == past["r_id"], "left")
    hit = F.col("r_id").isNotNull()
    kept = j.select(
        "id",
        F.when(hit, F.col("r_exit")).otherwise(F.col("exit")).alias("exit"),
        (F.col("hops") + F.coalesce("r_hops", F.lit(0))).alias("hops"),
        F.least("seg_min", F.coalesce("r_seg_min", "seg_min")).alias("seg_min"),
        F.when(hit, F.col("r_top")).otherwise(F.col("top")).alias("top"),
        F.when(hit, F.col("hops") + F.col("r_top_hops")).otherwise(F.col("top_hops")).alias("top_hops"),
        "croot",
        F.when(hit, F.concat("r_seg", "seg")).otherwise(F.col("seg")).alias("seg"),
    )
    return kept, out_now


def _expand(frag: DataFrame, solved: DataFrame) -> DataFrame:
    s = solved.select(*(F.col(c).alias(f"s_{c}") for c in solved.columns))
    j = frag.join(s, frag["exit"] == s["s_id"], "left")
    known, circ = F.col("s_id").isNotNull(), F.coalesce("croot", "s_croot")
    return j.select(
        "id",
        F.when(known, F.col("s_root")).otherwise(F.col("top")).alias("root"),
        F.when(circ.isNotNull(), F.lit(None)).when(known, F.col("s_depth") + F.col("hops")).otherwise(F.col("top_hops")).cast("long").alias("depth"),
        circ.alias("croot"),
        F.when(circ.isNotNull(), F.lit(None)).when(known, F.concat("s_path", "seg")).otherwise(F.col("seg")).alias("path"),
    )


def _solve(frag: DataFrame, limit: int, with_path: bool, level: int = 1) -> DataFrame:
    exits = frag.where("exit IS NOT NULL").select(F.col("exit").alias("id")).distinct()
    quotient = materialise(frag.join(exits, "id", "left_semi"))
    size = quotient.count()
    if not size:
        return _expand(frag, quotient.selectExpr("id", "top AS root", "hops AS depth", "croot", "seg AS path").limit(0))
    if size <= limit:
        one = quotient.repartition(1).mapInArrow(_contract(with_path), _FRAGMENT)
        solved = one.selectExpr("id", "top AS root", "IF(croot IS NULL, top_hops, NULL) AS depth", "croot", "seg AS path")
        return _expand(frag, solved)
    taken = None
    if level > 1:
        quotient, taken = _splice(quotient, level)
    parts = -(-size // limit)
    smaller = quotient.withColumn("_b", F.pmod(F.xxhash64("id", F.lit(level)), F.lit(parts))).repartition(parts, "_b").drop("_b")
    smaller = materialise(smaller.mapInArrow(_contract(with_path), _FRAGMENT))
    solved = _solve(smaller, limit, with_path, level + 1)
    if taken is not None:
        solved = solved.unionByName(_expand(taken, solved))
    return _expand(frag, solved)


def hierarchy(
    df: DataFrame, id_col: str = "id", parent_col: str = "parent_section_id", locality_col: str | None = "doc_id", limit: int = 100_000, with_path: bool = True
) -> DataFrame:
    """Rows naming their parent -> (id, root_id, depth, in_cycle, path).

    A parent that is null or no row's id ends the chain: that row is a root at depth 0. ``path`` runs from the root to
    the row. A chain that ends in a circle has a null depth and path, ``in_cycle`` true and the circle's smallest id as
    root. Rows with a null id are no nodes. Repeated rows count once; where an id comes with several parents, the smallest
    holds. Other columns are ignored, whatever their names. An empty table gives an empty result. ``limit`` bounds the rows
    of one task; a locality group above half of it (one hot document) is spread by id.
    """
    key = F.col(locality_col) if locality_col else F.col(id_col)
    nodes = materialise(
        df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(parent_col).cast("long")).alias("exit"), F.min(key).alias("loc"))
    )
    size = nodes.count()
    parts = max(1, -(-size // limit))
    if locality_col and parts > 1:
        hot = nodes.groupBy("loc").count().where(F.col("count") > limit // 2).select("loc", F.lit(True).alias("hot"))
        nodes = nodes.join(hot, "loc", "left")  # null locality matches nothing and is spread by id
        spread = F.when(F.col("hot") | F.col("loc").isNull(), F.xxhash64("id")).otherwise(F.xxhash64("loc"))
    else:
        spread = F.xxhash64("id")
    start = nodes.select(
        "id", "exit", F.lit(1).cast("long").alias("hops"), F.col("id").alias("seg_min"), F.col("id").alias("top"), F.lit(0).cast("long").alias("top_hops"),
        F.lit(None).cast("long").alias("croot"), (F.array("id") if with_path else F.lit(None).cast("array<long>")).alias("seg"), F.pmod(spread, F.lit(parts)).alias("_b"),
    )
    frag = materialise(start.repartition(parts, "_b").drop("_b").mapInArrow(_contract(with_path), _FRAGMENT))
    done = _solve(frag, limit, with_path)
    return done.select("id", F.coalesce("croot", "root").alias("root_id"), "depth", F.col("croot").isNotNull().alias("in_cycle"), "path")


def circle_trees(
    df: DataFrame, paths: DataFrame, id_col: str = "id", parent_col: str = "parent_section_id", locality_col: str | None = "doc_id", limit: int = 100_000
) -> DataFrame:
    """The rows caught in circles, of a table and its ``hierarchy`` result -> (id, root_id, on_circle, depth, path).

    A row on a circle ends the chain of the rows below it: it is at depth 0 of its own path and has no ancestor, and ``path`` runs from it
    down to the row. ``root_id`` is the circle's smallest id, as in ``hierarchy``. Without circles the result is empty.
    """
    key = F.col(locality_col) if locality_col else F.col(id_col)
    rows = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(parent_col).cast("long")).alias("up"), F.min(key).alias("loc"))
    caught = materialise(rows.join(paths.where("in_cycle").select("id", "root_id"), "id"))
    # cut above its smallest id, a circle is the path from there down to that row's parent
    opened = hierarchy(caught.withColumn("up", F.when(F.col("id") != F.col("root_id"), F.col("up"))), "id", "up", "loc", limit)
    last = caught.where("id = root_id").select(F.col("up").alias("id"))
    circle = materialise(opened.join(last, "id").select(F.explode("path").alias("id")))
    loose = caught.join(circle.withColumn("on_circle", F.lit(True)), "id", "left").withColumn("on_circle", F.coalesce("on_circle", F.lit(False)))
    loose = materialise(loose.withColumn("up", F.when(~F.col("on_circle"), F.col("up"))))
    return hierarchy(loose, "id", "up", "loc", limit).select("id", "depth", "path").join(loose.select("id", "root_id", "on_circle"), "id").select("id", "root_id", "on_circle", "depth", "path")


def descendants(paths: DataFrame) -> DataFrame:
    """Every pair (ancestor_id, id, distance) of a ``hierarchy`` result, in which rows caught in circles have none, or of a ``circle_trees`` result, which has theirs."""
    e = paths.where("path IS NOT NULL").select("id", "depth", F.posexplode("path").alias("at", "ancestor_id"))
    return e.where("at < depth").select("ancestor_id", "id", (F.col("depth") - F.col("at")).alias("distance"))


def level_errors(df: DataFrame, id_col: str = "id", parent_col: str = "parent_section_id", level_col: str = "level", locality_col: str | None = "doc_id", limit: int = 100_000) -> DataFrame:
    """(id, root_id) of rows whose non-null level is not their depth, and of all rows caught in a circle."""
    tree = hierarchy(df, id_col, parent_col, locality_col, limit, with_path=False)
    levels = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(level_col).alias("lv"), F.max(level_col).alias("lv2"))
    j = tree.join(levels, "id")
    return j.where("in_cycle OR lv <> depth OR lv2 <> depth").select("id", "root_id")
