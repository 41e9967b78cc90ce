"""Batch retrieval: many queries at once, every frame carries query_id."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.functions.text import md5_mod, strip, words
from leafmill.session import broadcast_if_small, materialise, scratch, shuffle_partitions

K1, B, EPSILON = 1.5, 0.75, 0.25
RRF_K = 60
QUERY_BYTES = 64 << 20  # of vector queries that a task holds at a time; more are searched for in several blocks
POSTINGS = 500_000  # of asked terms that a task holds at a time
DIGITS = 6  # scores are rounded before they are ranked or compared


def route(query: Column) -> Column:
    """struct(intent, strategy, alpha) of a query."""
    q = strip(F.lower(query))
    pick = lambda i, s, a: F.struct(F.lit(i).alias("intent"), F.lit(s).alias("strategy"), F.lit(a).alias("alpha"))
    return (
        F.when(q.rlike(r"^(what is|define|meaning of)\b"), pick("definition", "semantic", 0.8))
        .when(q.rlike(r"^(summarize|summary of|tl;?dr)\b"), pick("summary", "semantic", 1.0))
        .when(q.rlike(r"^(how to|steps to|guide for)\b"), pick("procedure", "hybrid", 0.6))
        .when(q.rlike(r"\b(vs|versus|compare|difference between)\b"), pick("comparison", "hybrid", 0.5))
        .when(F.size(words(q)) < 3, pick("keyword", "lexical", 0.2))
        .otherwise(pick("qa", "hybrid", 0.7))
    )


def postings(chunks: DataFrame, id_col: str = "id", text_col: str = "content", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(term, chunk_id, tf, dl, kept columns) and (chunk_id, dl) of a corpus; words are lower-cased and split at white space, punctuation stays. Repeated rows once."""
    base = chunks.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("chunk_id")).agg(F.max(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"), *(F.max(c).alias(c) for c in keep))
    tok = base.withColumn("_w", words(F.lower("_t"))).select("chunk_id", *keep, "_w", F.size("_w").alias("dl"))
    terms = tok.select("chunk_id", *keep, "dl", F.explode("_w").alias("term")).groupBy("term", "chunk_id", "dl", *keep).agg(F.count("*").alias("tf"))
    return terms, tok.select("chunk_id", "dl")


@dataclass(frozen=True)
class Bm25Index:
    """`postings` (term, chunk_id, doc_id, tf, dl), sorted by term where the index is kept at a path; `terms` (term, idf) has the idf as scored; `size` (n, avgdl) is one row."""

    postings: DataFrame
    terms: DataFrame
    size: DataFrame


def index_chunks(chunks: DataFrame, id_col: str = "id", text_col: str = "content", doc_col: str = "doc_id", path: str | None = None) -> Bm25Index:
    """The index of a corpus, each text read and tokenised once; written to `path`, else to the shared folder. A negative idf becomes EPSILON times the mean idf. Null texts are empty ones."""
    spark = chunks.sparkSession
    kept, path = path is not None, path or scratch(spark)
    if doc_col not in chunks.columns:
        chunks = chunks.withColumn(doc_col, F.lit(None).cast("long"))
    found, _ = postings(chunks, id_col, text_col, (doc_col,))
    found = found.withColumnRenamed(doc_col, "doc_id")
    if kept:  # an index to be read many times is sorted by term, so that queries skip most of it
        found = found.repartitionByRange(shuffle_partitions(spark), "term", "chunk_id").sortWithinPartitions("term", "chunk_id")
    found.write.mode("overwrite").parquet(f"{path}/postings")
    found = spark.read.schema(found.schema).parquet(f"{path}/postings")
    n = chunks.where(F.col(id_col).isNotNull()).agg(F.count_distinct(id_col).alias("n"))
    size = n.crossJoin(found.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))).select("n", (F.col("words") / F.greatest("n", F.lit(1))).alias("avgdl"))  # one row by one row
    size.write.mode("overwrite").parquet(f"{path}/size")
    size = spark.read.schema(size.schema).parquet(f"{path}/size")
    raw = found.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(size)).select("term", (F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("idf"))  # one row
    raw.write.mode("overwrite").parquet(f"{path}/raw")
    raw = spark.read.schema(raw.schema).parquet(f"{path}/raw")
    return Bm25Index(found, _weighted(raw), size)


def load_index(spark: SparkSession, path: str) -> Bm25Index:
    """An index as `index_chunks` wrote it; only its metadata is read."""
    found, raw, size = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "raw", "size"))
    return Bm25Index(found, _weighted(raw), size)


def _weighted(raw: DataFrame) -> DataFrame:
    floor = raw.agg((F.avg("idf") * EPSILON).alias("floor"))  # one row
    return raw.crossJoin(F.broadcast(floor)).select("term", F.when(F.col("idf") < 0, F.col("floor")).otherwise(F.col("idf")).alias("idf"))


def bm25(queries: DataFrame, chunks: DataFrame | Bm25Index, top_k: int = 10, id_col: str = "id", text_col: str = "content", allowed: DataFrame | None = None, doc_col: str = "doc_id") -> DataFrame:
    """(query_id, chunk_id, score, rank): Okapi scores over the whole corpus, or an index of it; positive ones only, ties to the smaller id.

    A repeated query word counts again. `allowed` (a frame with `doc_col`) restricts results, not the corpus statistics, which stay global. None means no restriction.
    The stated query set lies in blocks of at most QUERY_BYTES, as in `knn`; queries of the same words, in whatever order, are scored once; each part of the corpus sends on its own top_k only.
    """
    index = chunks if isinstance(chunks, Bm25Index) else index_chunks(chunks, id_col, text_col, doc_col)
    q = queries.select("query_id", F.explode(words(F.lower("query"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qf"))
    found = index.postings
    if allowed is not None:
        found = found.join(allowed.select(F.col(doc_col).alias("doc_id")).distinct(), "doc_id", "left_semi")
    size = q.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, -(-2 * size // QUERY_BYTES))
    parts = [_bm25_block(q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i), index, found, top_k) for i in range(blocks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bm25_block(q: DataFrame, index: Bm25Index, found: DataFrame, top_k: int) -> DataFrame:
    """The ranked top_k of each query of the block. Only the postings of asked terms are moved, once, to where their chunk is; no row is made for a query and a chunk that it hits."""
    spark = q.sparkSession
    same = q.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", "qf"))).alias("ts")).groupBy("ts").agg(F.collect_list(F.struct("query_id")).alias("askers"))
    rows = same.toArrow()  # one block, of at most about QUERY_BYTES
    pairs, askers = rows["ts"].combine_chunks(), rows["askers"].combine_chunks()
    flat, ends = pairs.flatten(), np.cumsum(pa.compute.list_value_length(pairs).to_numpy(zero_copy_only=False))
    coded = flat.field("term").dictionary_encode()
    asked = spark.createDataFrame(pa.table({"term": coded.dictionary, "t": pa.array(np.arange(len(coded.dictionary), dtype=np.int32))}), "term string, t int")
    asked = asked.join(index.terms, "term")
    tf = F.col("tf")
    part = F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    hit = found.join(broadcast_if_small(asked, 96), "term").crossJoin(F.broadcast(index.size.select("avgdl"))).select("chunk_id", "t", part.alias("w"))
    hit = hit.repartition("chunk_id").sortWithinPartitions("chunk_id")  # every part goes through all queries, so small ones may be put together
    shared = spark.sparkContext.broadcast((ends, coded.indices.to_numpy(), flat.field("qf").to_numpy(), len(coded.dictionary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, terms, qf, n_terms = shared.value
        for ids, at, t, w in _whole_chunks(batches):
            order = np.argsort(t, kind="stable")
            at, w, starts = at[order], w[order], np.searchsorted(t[order], np.arange(n_terms + 1))
            score, best = np.zeros(len(ids)), []
            for i, end in enumerate(ends):
                mine = [(starts[x], starts[x + 1], qf[k]) for k in range(ends[i - 1] if i else 0, end) for x in [terms[k]] if starts[x] < starts[x + 1]]
                if not mine:
                    continue
                for a, b, n in mine:
                    score[at[a:b]] += n * w[a:b]
                touched = at[mine[0][0] : mine[0][1]] if len(mine) == 1 else np.unique(np.concatenate([at[a:b] for a, b, _ in mine])) if 16 * sum(b - a for a, b, _ in mine) < len(ids) else np.flatnonzero(score)
                got = score[touched].round(DIGITS)
                score[touched] = 0
                if len(got) > top_k:
                    keep = got >= np.partition(got, len(got) - top_k)[len(got) - top_k]
                    touched, got = touched[keep], got[keep]
                first = np.argsort(-got, kind="stable")[:top_k]
                first = first[got[first] > 0]
                best.append((np.full(len(first), i), touched[first], got[first]))
            if best:
                i, c, x = map(np.concatenate, zip(*best, strict=True))
                yield from pa.table({"query": i.astype(np.int32), "chunk_id": ids.take(pa.array(c)), "score": x}).to_batches(65_536)

    kinds = dict(q.dtypes) | dict(hit.dtypes)
    best = top(hit.mapInArrow(run, f"query int, chunk_id {kinds['chunk_id']}, score double"), top_k, of="query")
    each = np.repeat(np.arange(len(askers), dtype=np.int32), pa.compute.list_value_length(askers).to_numpy(zero_copy_only=False))
    asking = spark.createDataFrame(pa.table({"query": each, "query_id": askers.flatten().field("query_id")}), f"query int, query_id {kinds['query_id']}")
    return best.join(broadcast_if_small(asking, 32), "query").select("query_id", "chunk_id", "score", "rank")


def _whole_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, each posting's place among them, its term's number, its weight) of postings sorted by chunk, some POSTINGS rows at a time, no chunk being cut."""
    rest: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        rest.append(b)
        n += len(b)
        if n >= POSTINGS:
            ready = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            ids = ready.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(ids != ids[-1])[-1]) + 1 if ids[0] != ids[-1] else 0
            if cut:
                yield _placed(ready.slice(0, cut))
            rest, n = [ready.slice(cut)], n - cut
    if n:
        yield _placed(pa.Table.from_batches(rest).combine_chunks().to_batches()[0])


def _placed(b: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    ids = b.column(0).to_numpy(zero_copy_only=False)
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    return b.column(0).take(pa.array(np.flatnonzero(new))), np.cumsum(new) - 1, b.column(1).to_numpy(), b.column(2).to_numpy()


def top(scored: DataFrame, k: int, by: str = "score", tie: str = "chunk_id", of: str = "query_id") -> DataFrame:
    r = F.row_number().over(W.partitionBy(of).orderBy(F.desc(by), tie))
    return scored.withColumn("rank", r).where(F.col("rank") <= k)


def knn(queries: DataFrame, vectors: DataFrame, top_k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", where: Column | None = None) -> DataFrame:
    """(query_id, chunk_id, score, rank): exact nearest by squared distance d, score 1 / (1 + d).

    The stated query set (query_id, qv) lies in blocks of at most QUERY_BYTES; each block is broadcast once and compared with all vectors, and each batch of vectors sends on
    its own top_k of a query only. Vectors of another length than the query's, and null ones, don't match. The filter comes before the ranking, so it never shortens a list.
    """
    v = vectors if where is None else vectors.where(where)
    v = v.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("chunk_id"), F.col(vec_col).cast("array<double>").alias("_v"))
    q = queries.where("qv IS NOT NULL AND size(qv) > 0").select(F.col("query_id").cast("long"), F.col("qv").cast("array<double>").alias("qv"))
    size = q.agg(F.coalesce(F.sum(F.size("qv") * 8 + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, -(-2 * size // QUERY_BYTES))
    parts = [_knn_block(q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i), v, top_k) for i in range(blocks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return top(out, top_k)


def _knn_block(q: DataFrame, v: DataFrame, top_k: int) -> DataFrame:
    rows = q.toArrow()  # one block, of at most about QUERY_BYTES
    ids, lists = rows["query_id"].to_numpy(), rows["qv"].combine_chunks() if len(rows) else None
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if lists is not None:
        sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            by_length[int(n)] = (ids[at], lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(n)).astype(np.float64))
    shared = v.sparkSession.sparkContext.broadcast(by_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, all_ids = b.column(1), b.column(0).to_numpy(zero_copy_only=False)
            sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            for n, (qi, qv) in shared.value.items():
                at = np.flatnonzero(sizes == n)
                if not len(at):
                    continue
                at = at[np.argsort(all_ids[at], kind="stable")]
                x = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), n)
                whole = np.isfinite(x).all(1)  # a null component comes as NaN
                x, ids = x[whole], all_ids[at[whole]]
                if not len(ids):
                    continue
                xx = (x * x).sum(1)
                for i in range(0, len(qi), 256):
                    block = qv[i : i + 256]
                    d = np.maximum((block * block).sum(1)[:, None] + xx - 2 * block @ x.T, 0)
                    score = np.round(1 / (1 + d), DIGITS)
                    best = np.argsort(-score, axis=1, kind="stable")[:, :top_k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(qi[i : i + 256], best.shape[1])), pa.array(ids[best].ravel()), pa.array(np.take_along_axis(score, best, 1).ravel())], ["query_id", "chunk_id", "score"]
                    )

    return v.mapInArrow(run, "query_id long, chunk_id long, score double")


def fuse(lexical: DataFrame, dense: DataFrame, weights: DataFrame, top_k: int = 10) -> DataFrame:
    """Weighted reciprocal-rank fusion of two (query_id, chunk_id, rank) lists -> (query_id, chunk_id, score, source, rank); `weights` has (query_id, alpha), alpha being the dense side's. A list that alpha leaves without weight is left out before."""
    a = lexical.select("query_id", "chunk_id", F.col("rank").alias("lr"))
    b = dense.select("query_id", "chunk_id", F.col("rank").alias("dr"))
    j = a.join(b, ["query_id", "chunk_id"], "full_outer").join(weights.select("query_id", "alpha"), "query_id")
    part = lambda w, r: F.coalesce(w / (RRF_K + F.col(r)), F.lit(0.0))
    j = j.withColumn("score", F.round(part(2 * (1 - F.col("alpha")), "lr") + part(2 * F.col("alpha"), "dr"), 9))
    source = F.when(F.col("dr").isNull(), "bm25").when(F.col("lr").isNull(), "vector").otherwise("hybrid")
    r = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("lr"), F.asc_nulls_last("dr")))
    return j.withColumn("source", source).withColumn("rank", r).where(F.col("rank") <= top_k).select("query_id", "chunk_id", "score", "source", "rank")


def enrich(hits: DataFrame, chunks: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Hits with their chunk's document and section; a hit without a chunk goes, a missing document or section leaves empty strings. Tables are joined one row an id."""
    one = lambda df, cols: df.where(F.col("id").isNotNull()).groupBy("id").agg(*(F.max(c).alias(c) for c in cols))
    c = one(chunks, ("doc_id", "section_id", "page_number")).withColumnRenamed("id", "chunk_id")
    d = one(documents, ("filename", "title")).select(F.col("id").alias("doc_id"), "filename", F.coalesce(F.nullif("title", F.lit("")), "filename").alias("document_title"))
    s = one(sections, ("title",)).select(F.col("id").alias("section_id"), F.col("title").alias("section_title"))
    out = hits.join(c, "chunk_id").join(d, "doc_id", "left").join(s, "section_id", "left")
    return out.fillna("", ["filename", "document_title", "section_title"])


def neighbours(chunks: DataFrame) -> DataFrame:
    """(id, doc_id, previous, content, following, expanded): each chunk with its neighbours by chunk_index, joined by blank lines; repeated rows once."""
    one = chunks.where(F.col("id").isNotNull()).groupBy("id").agg(*(F.max(c).alias(c) for c in ("doc_id", "chunk_index", "content")))
    prev = one.select("doc_id", (F.col("chunk_index") + 1).alias("chunk_index"), F.col("content").alias("previous"))
    foll = one.select("doc_id", (F.col("chunk_index") - 1).alias("chunk_index"), F.col("content").alias("following"))
    pick = lambda x, c: x.groupBy("doc_id", "chunk_index").agg(F.min(c).alias(c))
    j = one.join(pick(prev, "previous"), ["doc_id", "chunk_index"], "left").join(pick(foll, "following"), ["doc_id", "chunk_index"], "left")
    return j.select("id", "doc_id", "previous", "content", "following", F.concat_ws("\n\n", "previous", "content", "following").alias("expanded"))


def with_parents(hits: DataFrame, chunks: DataFrame, sections: DataFrame) -> DataFrame:
    """Hits (chunk_id, ...) with `content`, `expanded` (the chunk with its neighbours) and `parent_content`: the content of the section its chunk is cut from, empty where there is none."""
    one = chunks.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("section_id").alias("section_id"))
    near = neighbours(chunks).join(one, "id").select(F.col("id").alias("chunk_id"), "content", "expanded", "section_id")
    parent = sections.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("content").alias("parent_content")).withColumnRenamed("id", "section_id")
    out = hits.join(near, "chunk_id").join(parent, "section_id", "left")
    return out.drop("section_id").fillna("", ["parent_content"])


def overlap_score(query: list[str], text: list[str]) -> np.ndarray:
    """Share of a query's words that a text has: the stand-in for a trained cross-encoder."""
    words = [(set((q or "").lower().split()), set((t or "").lower().split())) for q, t in zip(query, text, strict=True)]
    return np.array([len(q & t) / len(q) if q else 0.0 for q, t in words])


def rerank(hits: DataFrame, queries: DataFrame, top_k: int = 10, model: Callable[[list[str], list[str]], np.ndarray] = overlap_score, text_col: str = "content") -> DataFrame:
    """Hits (query_id, chunk_id, score, rank, text, ...) with the score of `model`, called with a batch of queries and texts, in place of theirs, ranked by it and cut to top_k a query.

    Ties keep the earlier rank. A batch for which the model fails keeps its scores' order below those of the others, so a model that always fails leaves the order as it was.
    """
    j = hits.join(queries.select("query_id", F.col("query").alias("_query")), "query_id")
    score = F.pandas_udf(_scorer(model), "double")(F.col("_query"), F.coalesce(text_col, F.lit("")))
    j = j.withColumn("_new", score)
    r = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc_nulls_last("_new"), "rank"))
    return j.withColumn("_r", r).where(F.col("_r") <= top_k).withColumns({"score": F.coalesce("_new", "score"), "rank": F.col("_r")}).drop("_new", "_r", "_query")


def _scorer(model: Callable[[list[str], list[str]], np.ndarray]):
    def run(query: pd.Series, text: pd.Series) -> pd.Series:
        try:
            return pd.Series(np.asarray(model(query.tolist(), text.tolist()), np.float64).round(DIGITS))
        except Exception:  # noqa: BLE001
            return pd.Series([None] * len(query), dtype="float64")

    return run


GRAM = 3  # bytes
SLICE_BYTES = 1 << 20  # of texts that are looked through at a time


def text_fallback(queries: DataFrame, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, doc_id, result_id, start, snippet): every text that holds the query, case aside; not limited.

    A text meets only queries whose rarest three bytes it has, then comes the exact check; texts are looked through where they are and not moved. Queries shorter than that are compared
    with every text, one by one. The queries, read once, lie in blocks of at most QUERY_BYTES. Null texts and queries match nothing; the empty query matches every text.
    """
    d = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), F.lower(text_col).alias("lt"))
    q = materialise(queries.where("query IS NOT NULL").select("query_id", "query", F.lower("query").alias("lq")))
    size = q.agg(F.coalesce(F.sum(F.octet_length("query") * 8 + 64), F.lit(0)).alias("bytes")).first()["bytes"]  # with their letter groups
    blocks = max(1, -(-2 * size // QUERY_BYTES))
    parts = [_fallback_block(q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id", "query"), F.lit(blocks)) == i), d) for i in range(blocks)]
    j = parts[0]
    for p in parts[1:]:
        j = j.unionByName(p)
    key = F.concat_ws(":", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")), F.col("start").cast("string"))
    return j.select("query_id", "doc_id", md5_mod(key).cast("int").alias("result_id"), "start", "snippet")


def _codes(b: np.ndarray) -> np.ndarray:
    """A number for each GRAM bytes in a row."""
    x = b.astype(np.int32)
    return (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]


def _sliced(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, where each row ends in them) of some rows at a time, as many as SLICE_BYTES hold, at least one."""
    n = pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset]
    data, ends, i = np.frombuffer(column.buffers()[2] or b"", np.uint8), np.cumsum(n), 0
    while i < len(n):
        began = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, began + SLICE_BYTES, "right")))
        yield i, data[at + began : at + int(ends[j - 1])], ends[i:j] - began
        i = j


def _table(grams: np.ndarray) -> np.ndarray:
    """The place in `grams` of every number that _codes can give, len(grams) where it isn't there."""
    out = np.full(1 << 8 * GRAM, len(grams), np.int32)
    out[grams] = np.arange(len(grams), dtype=np.int32)
    return out


def _fallback_block(q: DataFrame, d: DataFrame) -> DataFrame:
    spark = d.sparkSession
    rows = q.toArrow()  # one block, of at most about QUERY_BYTES
    asked = [x.encode() for x in rows["lq"].to_pylist()]
    own = [np.unique(_codes(np.frombuffer(x, np.uint8))) if len(x) >= GRAM else np.empty(0, np.int32) for x in asked]
    wanted = np.unique(np.concatenate([*own, np.empty(0, np.int32)]))
    shared_wanted = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared_wanted.value)
        n = np.zeros(len(shared_wanted.value) + 1, np.int64)
        for b in batches:
            for _, data, _ in _sliced(b.column(0)):
                n += np.bincount(table[_codes(data)], minlength=len(n))
        there = np.flatnonzero(n[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(n[there])], ["g", "n"])

    found = np.zeros(len(wanted), np.int64)
    if len(wanted):  # a row for each group of letters that is asked for
        got = d.select("lt").mapInArrow(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
        found[got["g"].to_numpy()] = got["n"].to_numpy()
    # each query goes by its rarest letters; none of its texts is there if they are nowhere
    keys: dict[int, list[int]] = {}
    for i, x in enumerate(own):
        if len(x):
            k = np.searchsorted(wanted, x)
            k = int(k[found[k].argmin()])
            if found[k]:
                keys.setdefault(int(wanted[k]), []).append(i)
    grams = np.array(sorted(keys), np.int32)
    short = [i for i, x in enumerate(asked) if len(x) < GRAM]
    shared = spark.sparkContext.broadcast((rows["query_id"].combine_chunks(), rows["lq"].to_pylist(), [len(x) for x in rows["query"].to_pylist()], grams, [keys[int(g)] for g in grams], short))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, lqs, lengths, grams, by_gram, short = shared.value
        table = _table(grams)
        for b in batches:
            texts, lower = b.column(1), b.column(2)
            for first, data, ends in _sliced(lower):
                met: list[tuple[int, int]] = []
                if len(grams):
                    g = table[_codes(data)]
                    at = np.flatnonzero(g < len(grams))
                    pairs = np.unique(np.searchsorted(ends, at, "right") * np.int64(len(grams)) + g[at])
                    met = [(int(x) // len(grams), i) for x in pairs for i in by_gram[int(x) % len(grams)]]
                out: list[tuple[int, int, int, str]] = []
                row, lt, t = -1, "", ""
                for r, i in heapq.merge(met, ((r, i) for r in range(len(ends)) for i in short), key=lambda x: x[0]):
                    if r != row:
                        row, lt, t = r, lower[first + r].as_py(), texts[first + r].as_py()
                    p = lt.find(lqs[i])
                    if p >= 0:
                        start = max(0, p - 100)
                        out.append((i, first + r, start, "..." + t[start : start + lengths[i] + 200].replace("\n", " ") + "..."))
                        if len(out) >= 10_000:
                            yield batch(query_ids, b, out)
                            out = []
                if out:
                    yield batch(query_ids, b, out)

    def batch(query_ids: pa.Array, b: pa.RecordBatch, out: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
        i, r, start, snippet = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([query_ids.take(pa.array(i)), b.column(0).take(pa.array(r)), pa.array(start, pa.int32()), pa.array(snippet, pa.string())], ["query_id", "doc_id", "start", "snippet"])

    kinds = dict(q.dtypes) | dict(d.dtypes)
    return d.mapInArrow(run, f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, start int, snippet string")
