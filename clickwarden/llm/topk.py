"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are laid out by range of their length, so a batch of them is a bucket of like
lengths. Queries go to the tasks in stored blocks of about equal size, one after another, together with a bounded seed: the
longest vectors of all, which give every query a first threshold, its k-th best score among
them. For each bucket and query the threshold turns into a local cosine threshold, threshold
/ (query length * longest vector of the bucket). Above 1 the bucket is skipped. Near 1 the
bucket is pruned by coordinates: on the query's largest coordinates a vector of that cosine
must lie in a narrow range. Below, it is pruned by length alone. The products of what is left
are verified in whole numbers and raise the thresholds as they come. Tasks return at most k
rows a query; a window over these rows gives the ranks.

Components are floor(scale * x). Null vectors and vectors with null or non-finite components
take no part; shorter vectors count as padded with zeros. Queries with one id count once (the
smallest vector); rows with the query's id are its own and no candidates. Ties go to the
smaller vec_id. Products must fit 63 bits. Extra columns are ignored; empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import fresh_folder, spill
from clickwarden.runtime import track

FOUND = "query_id long, vec_id long, score long"
SLACK = 1e-9


def whole_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, whole-number components and length of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    rows = rows.select("vec_id", F.transform("embedding", lambda v: F.floor(v * scale).cast("long")).alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def matrix(lists: list, width: int | None = None) -> np.ndarray:
    width = width or max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, :min(len(v), width)] = v[:width]
    return out


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy()
    if len(flat) == len(column) * width and bool((np.diff(column.offsets.to_numpy()) == width).all()):
        return flat.reshape(-1, width)
    return matrix(column.to_pylist(), width)


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """a @ b.T in whole numbers; through doubles while these are exact."""
    if bound < 2 ** 52:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class TopK:
    """Best k scores of each query so far, smaller ids first among equal scores."""

    def __init__(self, ids: np.ndarray, k: int, limit: int = 400_000):
        self.ids, self.k, self.limit = ids, k, limit
        self.floor = np.full(len(ids), np.iinfo(np.int64).min)
        self.rows: list[np.ndarray] = []
        self.held = 0

    def add(self, query: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        keep = (score >= self.floor[query]) & (vec_id != self.ids[query])
        self.rows.append(np.stack([query[keep], vec_id[keep], score[keep]]))
        self.held += int(keep.sum())
        if self.held > self.limit:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate(self.rows, 1) if self.rows else np.zeros((3, 0), np.int64)
        rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        rank = np.arange(rows.shape[1]) - first
        full = rank == self.k - 1
        self.floor[rows[0, full]] = np.maximum(self.floor[rows[0, full]], rows[2, full])
        rows = rows[:, rank < self.k]
        self.rows, self.held = [rows], rows.shape[1]
        return rows


def search_bucket(best: TopK, queries: np.ndarray, lengths: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                  norms: np.ndarray, near: float = 0.75, focus: int = 3, slice_: int = 256) -> None:
    """Add what a bucket holds for the queries; the bucket is sorted by length, longest first."""
    top = norms[0]
    scale = np.maximum(lengths * top, 1e-300)
    local = np.where(best.floor > np.iinfo(np.int64).min, best.floor / scale, -np.inf)
    active = local <= 1 + SLACK
    bound = float(lengths.max(initial=0) * top)
    by_length = np.flatnonzero(active & (local < near))
    for at in range(0, len(by_length), slice_):
        q = by_length[at:at + slice_]
        # length pruning: only the bucket's first vectors are long enough for the easiest of these queries
        need = np.min(np.where(best.floor[q] > 0, best.floor[q] / np.maximum(lengths[q], 1e-300), 0))
        n = int(np.searchsorted(-norms, -need * (1 - SLACK), "right"))
        score = products(queries[q], vectors[:n], bound)
        i, j = np.nonzero(score >= best.floor[q][:, None])
        best.add(q[i], ids[j], score[i, j])
    units = None
    for q in np.flatnonzero(active & (local >= near)).tolist():
        if units is None:
            units = vectors / np.maximum(norms, 1e-300)[:, None]
        angle, unit = np.arccos(min(1.0, local[q])), queries[q] / max(lengths[q], 1e-300)
        keep = np.ones(len(ids), bool)
        for f in np.argsort(-np.abs(unit))[:focus].tolist():
            # |arccos(unit_f) - arccos(vector_f)| can't exceed the angle of the threshold
            own = np.arccos(np.clip(unit[f], -1, 1))
            keep &= units[:, f] >= np.cos(min(np.pi, own + angle)) - 1e-7
            keep &= units[:, f] <= np.cos(max(0.0, own - angle)) + 1e-7
        j = np.flatnonzero(keep)
        if len(j):
            score = products(queries[q:q + 1], vectors[j], bound)[0]
            best.add(np.full(len(j), q), ids[j], score)


def block_hits(laid: DataFrame, block: list, seed: list, k: int) -> DataFrame:
    """Up to k rows per query and task for one block of queries."""

    def search(batches):
        width = max((len(r[1]) for r in block), default=0)
        ids, queries = np.array([r[0] for r in block], np.int64), matrix([r[1] for r in block], width)
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        best = TopK(ids, k)
        if seed:
            s = matrix([r[1] for r in seed], width)
            own, norms = np.array([r[0] for r in seed], np.int64), np.sqrt((s.astype(np.float64) ** 2).sum(1))
            for at in range(0, len(ids) if len(seed) > k else 0, 256):
                score = products(queries[at:at + 256], s, float(lengths.max() * norms.max(initial=0)))
                score[ids[at:at + 256, None] == own] = np.iinfo(np.int64).min
                best.floor[at:at + 256] = np.partition(score, -k, axis=1)[:, -k]
        for batch in batches:
            norms = batch.column(2).to_numpy()
            order = np.argsort(-norms, kind="stable")
            vectors = matrix_of(batch.column(1), width)[order]
            if len(order):
                search_bucket(best, queries, lengths, batch.column(0).to_numpy()[order], vectors, norms[order])
        rows = best.settle()
        for at in range(0, rows.shape[1], 50_000):
            part = rows[:, at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[part[0]]), pa.array(part[1]), pa.array(part[2])], ["query_id", "vec_id", "score"])

    return laid.mapInArrow(search, FOUND)


def top_inner_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64,
                       block_queries: int = 4000, seed_vectors: int = 2048) -> DataFrame:
    """The k highest inner products of every vector whose id is divisible by ``every``."""
    rows = whole_vectors(vectors, scale)
    laid = spill(rows.repartitionByRange(F.desc("norm"), F.col("vec_id")).sortWithinPartitions(
        F.desc("norm"), "vec_id"), "topk_vectors")
    seed = [(r["vec_id"], r["vec"]) for r in laid.orderBy(F.desc("norm"), "vec_id").limit(seed_vectors).collect()]
    spark, folder = vectors.sparkSession, fresh_folder(vectors.sparkSession, "topk")
    track(folder)
    queries = spill(laid.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec")), "topk_queries")
    blocks = max(1, -(-queries.count() // block_queries))
    # distinct ids spread evenly over the blocks; each has its own folder, so the driver reads one at a time
    queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(
        f"{folder}/queries")
    stored = spark.read.schema("vec_id long, vec array<long>, block int").parquet(f"{folder}/queries")
    for number in range(blocks):
        block = [(r["vec_id"], r["vec"]) for r in stored.filter(F.col("block") == number).select("vec_id", "vec").collect()]
        block_hits(laid, block, seed, k).write.mode("append").parquet(f"{folder}/hits")
    hits = spark.read.schema(FOUND).parquet(f"{folder}/hits")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
