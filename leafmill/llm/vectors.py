"""The most similar vectors of every vector.

Vectors of one model and length make a space. A space is divided into shards around centroids; each shard is a hierarchical navigable
small-world graph in flat arrays. Every vector looks for its neighbours in its own shard, from its own links, and in those other shards whose
centroids are nearly as near as its own's: by how much, a sample of vectors compared with all says. The shards' results are merged,
and an edge found from either end counts for both.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.llm.graph import SmallWorld
from leafmill.session import materialise

#: Vectors of a shard, about, and vectors that one task looks up at most.
SHARD, LOOKUPS = 24_000, 250_000
#: Vectors that the centroids are fitted on, a space and in all; rounds of fitting.
SAMPLE, SAMPLE_IN_ALL, ROUNDS = 20_000, 400_000, 8
#: Vectors, a space, whose true neighbours say which shards must be asked, and the share of those that must lie in them; as an edge needs to be found from one end only, fewer are missed.
PROBED, COVERAGE = 1_500, 0.9
#: The same share where only neighbours above a similarity are asked for.
COVERAGE_IN_RANGE = 0.999
#: Candidates followed in a search.
WIDTH = 16
#: More than k are kept until similarities are exact, as they are in single precision before, which errs by far less than SLACK.
SPARE, SLACK = 4, 0.001
MAX_SPACES = 10_000
#: Rows of vectors copied often are spread over so many keys.
SALTS = 16


def _usable(df: DataFrame, id_col: str, with_vector: bool) -> DataFrame:
    """(id, space, d) of each usable vector, d being a digest of its direction; and `h`, the unit vector itself as little-endian float32. Nothing is shuffled."""
    names = ["id", "space", "d", "h"][: 3 + with_vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = pa.array(np.flatnonzero(dims == dim))
                v = np.frombuffer(b"".join(b.column(3).take(rows).to_pylist()), "<f4").reshape(len(rows), dim).astype(np.float64)
                norm = np.sqrt((v * v).sum(1))
                ok = np.isfinite(v).all(1) & (norm > 0) & np.isfinite(norm)
                rows = rows.filter(pa.array(ok))
                unit = (v[ok] / norm[ok, None]).astype("<f4")
                raw, width = unit.tobytes(), 4 * int(dim)
                blobs = [raw[i : i + width] for i in range(0, len(raw), width)]
                space = pa.array([f"{dim}:{m}" for m in b.column(1).take(rows).to_pylist()], pa.string())
                out = [b.column(0).take(rows), space, pa.array([md5(x).digest() for x in blobs], pa.binary()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(out[: len(names)], names)

    fits = (F.col("dimensions") > 0) & (F.octet_length("vector_blob") == 4 * F.col("dimensions")) & F.col(id_col).isNotNull() & F.col("model_name").isNotNull()
    rows = df.where(fits).select(F.col(id_col).cast("long"), "model_name", F.col("dimensions").cast("int"), "vector_blob")
    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, ("long", "string", "binary", "binary"), strict=False)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long blobs of float32 as the rows of a matrix."""
    if not len(column):
        return np.zeros((0, 1), np.float32)
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1)


def fit_centroids(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k directions fitted to a sample of unit vectors; an empty one starts anew at the vector farthest from its own."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near, best = np.empty(len(x), np.int64), np.empty(len(x), np.float32)
        for i in range(0, len(x), 2048):
            s = x[i : i + 2048] @ c.T
            near[i : i + 2048], best[i : i + 2048] = s.argmax(1), s.max(1)
        new = np.zeros_like(c)
        np.add.at(new, near, x)
        for j in np.flatnonzero(np.bincount(near, minlength=k) == 0):
            new[j] = x[best.argmin()]
            best[best.argmin()] = 2
        c = (new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return c


def _sampled(reps: DataFrame, sizes: dict[str, int], most: int, salt: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """About `most` vectors of each space, chosen by a digest of their ids: space -> (ids, vectors)."""
    spark = reps.sparkSession
    share = spark.createDataFrame([(s, int(min(1.0, most / n) * 1_000_000)) for s, n in sizes.items()], "space string, upto long")
    got = reps.join(F.broadcast(share), "space").where(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_000)) < F.col("upto")).select("space", "id", "h").toArrow()
    out = {}
    for s in sizes:
        one = got.filter(pa.compute.equal(got["space"], s)).sort_by("id")
        out[s] = (one["id"].to_numpy(), _matrix(one["h"]))
    return out


def _compared(reps: DataFrame, queries: dict[str, tuple[np.ndarray, np.ndarray]], k: int, floor: float, more: str, extra) -> DataFrame:
    """(space, q, id, sim, more): the k nearest of the given queries (ids, vectors) by comparing them with all vectors, in blocks; `extra` adds a column to each block's."""
    shared = reps.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spaces = np.array(b.column("space").to_pylist(), object)
            for s in set(spaces):
                qi, q = shared.value.get(s, ((), ()))
                if not len(q):
                    continue
                at = np.flatnonzero(spaces == s)
                x, ids = _matrix(b.column("h").take(pa.array(at))), b.column("id").to_numpy()[at]
                sims = q @ x.T
                sims[qi[:, None] == ids[None, :]] = -2
                n = min(k, len(at))
                if floor > -2:
                    r, c = np.nonzero(sims >= floor)  # few
                else:
                    r, c = np.repeat(np.arange(len(q)), n), np.argpartition(-sims, n - 1, axis=1)[:, :n].ravel()
                got = sims[r, c]
                ok = got > -2
                r, c, got = r[ok], c[ok], got[ok]
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(r), pa.string()), pa.array(qi[r]), pa.array(ids[c]), pa.array(got.astype(np.float64)), pa.array(extra(s, q[r], x[c]))], ["space", "q", "id", "sim", more])

    found = reps.select("id", "space", "h").mapInArrow(run, f"space string, q long, id long, sim double, {more} double")
    return found.withColumn("r", F.row_number().over(W.partitionBy("space", "q").orderBy(F.desc("sim"), "id"))).where(f"r <= {k}")


def _margins(reps: DataFrame, centroids: dict[str, np.ndarray], queries: dict[str, tuple[np.ndarray, np.ndarray]], k: int, at_least: float, coverage: float) -> dict[str, float]:
    """By how much less similar than its own a shard's centroid may be to a vector for the shard to be asked: so much that `coverage` of the true neighbours of the sample lie in shards asked.

    Where the sample has no neighbour of that similarity, the bound that no neighbour can break is taken.
    """

    def behind(space: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        c = centroids[space]
        s, home = q @ c.T, (x @ c.T).argmax(1)
        return (s.max(1) - s[np.arange(len(s)), home]).astype(np.float64)

    best = _compared(reps, queries, k, at_least, "behind", behind)
    got = {r["space"]: float(r["p"]) for r in best.groupBy("space").agg(F.percentile("behind", F.lit(coverage)).alias("p")).collect()}
    return {s: got.get(s, 2 * float(np.sqrt(max(0, 2 - 2 * at_least))) if at_least > -2 else 2.0) + 1e-6 for s in centroids}


def _edges(reps: DataFrame, k: int, at_least: float = -2.0, coverage: float = COVERAGE) -> DataFrame:
    """(a, b, cosine): candidate neighbours among distinct vectors, from either end, in double precision; at least k + SPARE a vector where there are as many of that similarity.

    A coverage of 1 asks every shard and compares with all vectors instead of walking the graphs: exact, and quadratic.
    """
    spark = reps.sparkSession
    exact = coverage >= 1
    sizes = {r["space"]: r["count"] for r in reps.groupBy("space").count().limit(MAX_SPACES + 1).collect()}
    if len(sizes) > MAX_SPACES:
        raise ValueError(f"over {MAX_SPACES} kinds of vectors")
    if not sizes:
        return spark.createDataFrame([], "a long, b long, cosine double")
    several = {s: n for s, n in sizes.items() if n > SHARD}
    centroids = {s: np.ones((1, int(s.split(":")[0])), np.float32) for s in sizes}
    if several:
        sample = _sampled(reps, several, min(SAMPLE, SAMPLE_IN_ALL // len(several)), 1)
        centroids |= {s: fit_centroids(x, min(-(-sizes[s] // SHARD), len(x))) for s, (_, x) in sample.items() if len(x)}
    split = {s: c for s, c in centroids.items() if len(c) > 1}
    margins = dict.fromkeys(sizes, 4.0)
    if split and not exact:
        margins |= _margins(reps.where(F.col("space").isin(list(split))), split, _sampled(reps, {s: sizes[s] for s in split}, min(PROBED, SAMPLE_IN_ALL // len(split)), 2), k, at_least, coverage)
    shared = spark.sparkContext.broadcast((centroids, margins))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, margins = shared.value
        for b in batches:
            spaces = np.array(b.column("space").to_pylist(), object)
            for s in set(spaces):
                at = np.flatnonzero(spaces == s)
                sims = _matrix(b.column("h").take(pa.array(at))) @ centroids[s].T
                home = sims.argmax(1)
                asked = sims >= sims.max(1, keepdims=True) - margins[s]
                asked[np.arange(len(at)), home] = False
                row, shard = np.nonzero(asked)
                row, shard, own = np.concatenate([np.arange(len(at)), row]), np.concatenate([home, shard]), np.arange(len(at) + len(row)) < len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s] * len(row)), pa.array(b.column("id").to_numpy()[at][row]), pa.array(shard.astype(np.int32)), pa.array(own), b.column("h").take(pa.array(at[row]))], ["space", "id", "shard", "home", "h"]
                )

    routed = reps.select("id", "space", "h").mapInArrow(route, "space string, id long, shard int, home boolean, h binary")  # done twice, as writing vectors costs more
    load = routed.groupBy("space", "shard").agg(F.count_if("home").alias("members"), F.count("*").alias("lookups")).orderBy("space", "shard").collect()
    slots, first = [], 0  # as many rows as shards; a shard grown too large is a few graphs, one asked too often a few tasks
    for r in load:
        graphs, tasks = max(1, round(r["members"] / (2 * SHARD))), -(-r["lookups"] // LOOKUPS)
        slots.append((r["space"], r["shard"], graphs, tasks, first))
        first += graphs * tasks
    plan = F.broadcast(spark.createDataFrame(slots, "space string, shard int, graphs int, tasks int, first int"))
    sent = routed.join(plan, ["space", "shard"])
    graph, task = F.pmod(F.xxhash64("id"), F.col("graphs")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("tasks")).cast("int")
    every = F.sequence(F.lit(0), F.col("graphs") * F.col("tasks") - 1)
    # a row goes to each task of its shard in which it is a member of the graph, or is looked up
    to = F.filter(every, lambda i: (F.floor(i / F.col("tasks")).cast("int") == graph) & F.col("home") | (F.pmod(i, F.col("tasks")) == task))
    sent = sent.select("id", "h", F.explode(to).alias("i"), "tasks", "first", "home", graph.alias("g"), task.alias("t"))
    sent = sent.select(
        (F.col("first") + F.col("i")).alias("slot"), "id", "h", (F.col("home") & (F.floor(F.col("i") / F.col("tasks")).cast("int") == F.col("g"))).alias("member"), (F.pmod("i", "tasks") == F.col("t")).alias("asks")
    )
    floor = None if at_least <= -2 else at_least

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        ids, member, asks = t["id"].to_numpy(), t["member"].to_numpy(), t["asks"].to_numpy()
        x = _matrix(t["h"])
        del t, got
        inside = np.flatnonzero(member)
        inside = inside[np.argsort(ids[inside], kind="stable")]
        inner, n = ids[inside], k + SPARE
        if not len(inner):
            return
        base = x[inside]
        world = None if exact else SmallWorld(base)
        place = np.full(len(ids), -1)
        place[inside] = np.arange(len(inside))
        for own in (True, False):
            queries = np.flatnonzero(asks & (member == own))
            for i in range(0, len(queries), 8192):
                part = queries[i : i + 8192]
                if exact:
                    at = _all_nearest(x[part], base, n + 1)
                elif own:
                    at, _ = world.around(place[part], n, WIDTH, floor)
                else:
                    at, _ = world.search(x[part], n, WIDTH)
                r, c = np.nonzero(at >= 0)
                a, b = part[r], at[r, c]
                s = np.einsum("ij,ij->i", x[a].astype(np.float64), base[b].astype(np.float64))
                ok = (s >= at_least) & (ids[a] != inner[b])
                yield pa.RecordBatch.from_arrays([pa.array(ids[a][ok]), pa.array(inner[b][ok]), pa.array(s[ok])], ["a", "b", "cosine"])

    found = sent.repartitionById(max(1, first), "slot").mapInArrow(search, "a long, b long, cosine double")
    merged = found.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("cosine")).alias("o"), "b"))), 1, k + SPARE).alias("l"))  # at most k + SPARE + 1 a shard asked
    merged = materialise(merged.select("a", F.explode("l").alias("e")).select("a", "e.b", (-F.col("e.o")).alias("cosine")))
    return merged.unionByName(merged.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine")).groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def _all_nearest(q: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows of x nearest to each query, by comparing with all of them."""
    out = []
    for i in range(0, len(q), 512):
        s = q[i : i + 512] @ x.T
        out.append(np.argpartition(-s, n - 1, axis=1)[:, :n] if n < len(x) else np.broadcast_to(np.arange(len(x)), s.shape))
    return np.concatenate(out)


def _spaces(df: DataFrame, k: int, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, rep) of every usable vector, rep being the smallest id with the very same direction; the distinct ones' groups (id, same), `same` being
    the k + 1 smallest ids of each; and (id, space, h), the distinct unit vectors as float32. Only digests are shuffled to find copies."""
    rows = materialise(_usable(df, id_col, False).groupBy("id").agg(F.min(F.struct("space", "d")).alias("x")).select("id", "x.space", "x.d"))
    by = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    # copies are folded in two steps, so no list is longer than a salted share of one group
    part = by.groupBy("space", "d", "salt").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"))
    whole = materialise(part.groupBy("space", "d").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("same")))
    copied = whole.where("size(same) > 1").select("space", "d", F.element_at("same", 1).alias("rep"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(copied, ["space", "d", "salt"], "left").select("id", F.coalesce("rep", "id").alias("rep"))
    same = whole.select(F.element_at("same", 1).alias("id"), "same", "space", "d")
    reps = _usable(df, id_col, True).join(same.select("id", "space", "d"), ["id", "space", "d"]).groupBy("id", "space", "d").agg(F.min("h").alias("h"))
    return materialise(members), same.select("id", "same"), materialise(reps.select("id", "space", "h"))


def nearest(df: DataFrame, k: int = 10, at_least: float | None = None, id_col: str = "id", coverage: float | None = None) -> DataFrame:
    """(id, neighbour_id, cosine, rank): the k most similar other vectors of the same model and length for every usable vector of (id, model_name, dimensions, vector_blob).

    Ties go to the smaller id. Copies of one vector are searched for once; every one of them gets its list, other copies first. Vectors that
    aren't usable (null, cut, padded, all-zero or non-finite blobs, wrong dimensions, null models) have none and are no one's neighbour. Repeated rows
    count once; empty tables give empty results. `at_least` keeps neighbours of that cosine or more, which narrows the search; ranks are the same as without.
    `coverage`, the share of a sample's true neighbours that must lie in the shards asked, is COVERAGE, or with `at_least` COVERAGE_IN_RANGE;
    1 makes the search exact: all vectors of a space are compared with each other.
    """
    members, same, reps = _spaces(df, k, id_col)
    if coverage is None:
        coverage = COVERAGE if at_least is None else COVERAGE_IN_RANGE
    edges = _edges(reps, k, -2.0 if at_least is None else at_least - SLACK, coverage)
    others = edges.join(same, edges["b"] == same["id"]).select(F.col("a").alias("rep"), F.explode("same").alias("neighbour_id"), "cosine")
    own = same.where("size(same) > 1").select(F.col("id").alias("rep"), F.explode("same").alias("neighbour_id"), F.lit(1.0).alias("cosine"))
    r = F.row_number().over(W.partitionBy("rep").orderBy(F.desc("cosine"), "neighbour_id"))
    lists = others.unionByName(own).withColumn("r", r).where(f"r <= {k + 1}")  # one more, as a vector is not its own neighbour
    lists = materialise(lists.groupBy("rep").agg(F.collect_list(F.struct("neighbour_id", "cosine")).alias("l")))  # at most k + 1
    # the first of each group of copies meets its list once; the others are spread, as there may be many
    firsts = lists.join(members.where("id = rep"), "rep").select("id", "l")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    copies = members.where("id <> rep").withColumn("salt", salt)
    copied = lists.join(same.where("size(same) > 1").select(F.col("id").alias("rep")), "rep", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    got = firsts.unionByName(copies.join(copied, ["rep", "salt"]).select("id", "l"))
    if at_least is not None:
        got = got.withColumn("l", F.filter("l", lambda e: e["cosine"] >= at_least))
    # a list is in a row already: no shuffle ranks it
    ranked = F.sort_array(F.transform(F.filter("l", lambda e: e["neighbour_id"] != F.col("id")), lambda e: F.struct((-e["cosine"]).alias("o"), e["neighbour_id"].alias("n"))))
    out = got.select("id", F.posexplode(F.slice(ranked, 1, k)).alias("pos", "e"))
    return out.select("id", F.col("e.n").alias("neighbour_id"), (-F.col("e.o")).alias("cosine"), (F.col("pos") + 1).alias("rank"))


def recall(df: DataFrame, k: int = 10, every: int = 50, id_col: str = "id") -> DataFrame:
    """(space, n_queries, recall): the share of the true k nearest that `nearest` finds, with each usable vector whose id is divisible by `every` compared with all; a neighbour as similar as the k-th true one counts."""
    members, _, reps = _spaces(df, k, id_col)
    got = nearest(df, k, id_col=id_col).where(F.col("id") % every == 0).groupBy("id").agg(F.array_agg("cosine").alias("found"))
    asked = reps.where(F.col("id") % every == 0).select("space", "id", "h").toArrow()  # the stated query set
    queries = {}
    for s in set(asked["space"].to_pylist()):
        one = asked.filter(pa.compute.equal(asked["space"], s))
        queries[s] = (one["id"].to_numpy(), _matrix(one["h"]))
    true = _compared(reps, queries, k, -2.0, "zero", lambda _s, q, _x: np.zeros(len(q)))
    true = true.groupBy("space", "q").agg(F.count("*").alias("n"), F.min("sim").alias("last"))
    j = true.join(got, F.col("q") == F.col("id"), "left")
    hits = F.least("n", F.coalesce(F.size(F.filter("found", lambda c: c >= F.col("last") - 1e-6)), F.lit(0)))
    return j.groupBy("space").agg(F.count("*").alias("n_queries"), F.round(F.sum(hits) / F.sum("n"), 4).alias("recall"))


def mutual(df: DataFrame, k: int = 10, at_least: float = 0.9) -> DataFrame:
    """(id_a, id_b), smaller id first: vectors each among the other's k most similar, with a cosine of at least `at_least`."""
    got = nearest(df, k, at_least).select(F.least("id", "neighbour_id").alias("id_a"), F.greatest("id", "neighbour_id").alias("id_b"))
    return got.groupBy("id_a", "id_b").count().where("count > 1").select("id_a", "id_b")
