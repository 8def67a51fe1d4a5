"""Hard negatives by a residue-number-system GEMM and windowed selection.

Components are floor(scale * x). A product of two component matrices is computed modulo
several small primes, each a float32 GEMM over symmetric residues: blocks of ``DEPTH``
columns keep every sum below 2^24, where float32 is exact. There are enough primes for their
product to exceed four times the largest possible score (Cauchy-Schwarz over the longest vectors),
so the Chinese remainder theorem gives every signed score exactly. Its digits are found one
prime at a time, again in float32, and added up in whole numbers modulo 2^64.

Anchors lie in a stored table in blocks of bounded bytes, in the shared folder. A task holds
a bounded slice of rows at a time and reads the blocks one after the other, so all rows meet
all anchors in one job, without a shuffle of vectors, without a broadcast, and without any
anchor on the driver. A target is a range of scores that an anchor looks for: for positives
all scores of its own label, then for each positive the scores from ``low`` percent of the
positive's up to it, of other labels. A slice returns the first k rows of every target, and
a window over these picks the first k of all. A first pass over one row in ``sample`` (by hash of the
id) gives every target a floor, its k-th best score there, so that the pass over all rows
returns few rows more than the result has; no row is lost by it.

Rows with a null id, label, vector or component, or a non-finite one, take no part. Shorter
vectors count as padded with zeros. Anchors of one id count once (the smallest label, then
vector), and rows with the anchor's id are never its positives or negatives; otherwise every
repeated row counts. Ties go to the smaller vec_id. Scores must fit 63 bits. Extra columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwarden.llm.common import fresh_folder, spill
from clickwarden.llm.topk import matrix_of
from clickwarden.runtime import track

DEPTH = 64
HITS = "target long, anchor_id long, positive_id long, positive_score long, vec_id long, score long"
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1


# --- residue arithmetic ----------------------------------------------------------------

def primes_for(bound: float) -> list[int]:
    """Primes from 1021 downwards whose product exceeds ``4 * bound + 4``. Half of 1021
    squared, ``DEPTH`` times, stays below 2^24. The factor of four keeps the last digit away
    from half its prime, where rounding in float32 could give it the wrong sign."""
    out, product, candidate = [], 1, 1021
    while product <= 4 * bound + 4:
        if all(candidate % d for d in range(2, 32)):
            out.append(candidate)
            product *= candidate
        candidate -= 1
    return out


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Symmetric residues of whole-number rows, one float32 matrix per prime."""
    out = []
    for p in primes:
        r = vectors % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def _reduce(values: np.ndarray, p: int) -> np.ndarray:
    return values - np.float32(p) * np.rint(values / np.float32(p))


def residue_products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact whole-number ``a @ b.T`` from residues, while it stays below a quarter of the
    product of the primes."""
    total = np.zeros((a[0].shape[0], b[0].shape[0]), np.int64)
    weight, digits = 1, []
    for k, (x, y, p) in enumerate(zip(a, b, primes)):
        rest = np.zeros(total.shape, np.float32)
        for at in range(0, x.shape[1], DEPTH):
            rest = _reduce(rest + _reduce(x[:, at:at + DEPTH] @ y[:, at:at + DEPTH].T, p), p)
        # mixed radix: take off the digits found so far, divide by their primes
        for digit, q in zip(digits, primes):
            inverse = pow(q, -1, p)
            rest = _reduce((rest - _reduce(digit, p)) * np.float32(inverse if inverse <= p // 2 else inverse - p), p)
        digits.append(rest)
        total += rest.astype(np.int64) * np.int64((weight + 2 ** 63) % 2 ** 64 - 2 ** 63)
        weight *= p
    return total


# --- rows and targets ------------------------------------------------------------------

def usable_rows(vectors: DataFrame, scale: int, relabel: Column) -> DataFrame:
    """vec_id, label and whole-number components of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          x.alias("embedding")).dropna()
    rows = rows.filter(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("vec_id", relabel.alias("label"),
                       F.transform("embedding", lambda v: F.floor(v * scale).cast("long")).alias("vec"))


def _parquet(folder: str):
    """Anchor blocks of a stored table, one Arrow table per block, read in the task."""
    store, path = fs.FileSystem.from_uri(folder)
    for info in sorted(store.get_file_info(fs.FileSelector(path, recursive=True)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as handle:
                yield from pq.ParquetFile(handle).iter_batches(batch_size=512)


class Anchors:
    """A block of anchors with their targets."""

    def __init__(self, batch: pa.RecordBatch, width: int, primes: list[int]):
        self.ids, self.labels = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("vec_id", "label"))
        self.parts = residues(matrix_of(batch.column(batch.schema.get_field_index("vec")), width), primes)
        self.targets = batch.column(batch.schema.get_field_index("targets")).to_pylist()
        self.low = np.array([min(t["low"] for t in ts) for ts in self.targets])
        self.high = np.array([max(t["high"] for t in ts) for ts in self.targets])


def scan(rows: DataFrame, targets: DataFrame, k: int, alike: bool, width: int, primes: list[int],
         slice_bytes: int = 32 << 20, file_bytes: int = 64 << 20) -> DataFrame:
    """The first k rows of every target in each slice of rows.

    ``targets`` holds one row per anchor: vec_id, label, vec and ``targets``, an array of
    ranges ``low <= score <= high`` with what they are for. ``alike`` looks for rows of the
    anchor's label, else for rows of others.
    """
    spark, folder = rows.sparkSession, fresh_folder(rows.sparkSession, "anchors")
    track(folder)
    # files, and so row groups, of bounded size; the hash deals the anchors out evenly
    files = max(1, targets.count() * width * 8 // file_bytes)
    targets.repartition(files, "vec_id").write.parquet(folder)
    held = max(512, slice_bytes // (4 * max(1, width) * (len(primes) + 2)))

    def first_rows(slice_):
        ids = np.concatenate([b.column(0).to_numpy() for b in slice_])
        labels = np.concatenate([b.column(1).to_numpy() for b in slice_])
        order = np.argsort(ids, kind="stable")  # then a stable sort by score keeps smaller ids first
        vectors = np.concatenate([matrix_of(b.column(2), width) for b in slice_])[order]
        ids, labels, parts = ids[order], labels[order], residues(vectors, primes)
        found = []
        for batch in _parquet(folder):
            block = Anchors(batch, width, primes)
            for at in range(0, len(ids), 8192):
                to = at + 8192
                scores = residue_products(block.parts, [p[at:to] for p in parts], primes)
                fit = (scores >= block.low[:, None]) & (scores <= block.high[:, None])
                fit &= (labels[at:to] == block.labels[:, None]) == alike
                fit &= ids[at:to] != block.ids[:, None]
                for a in np.flatnonzero(fit.any(1)).tolist():
                    j = np.flatnonzero(fit[a])
                    own = scores[a, j]
                    rank = np.argsort(-own, kind="stable")
                    j, own = j[rank], own[rank]
                    for target in block.targets[a]:
                        first = int(np.searchsorted(-own, -target["high"], "left"))
                        for place in range(first, min(first + k, len(own))):
                            if own[place] < target["low"]:
                                break
                            found.append((target["target"], int(block.ids[a]), target["positive_id"], target["positive_score"],
                                          int(ids[at + j[place]]), int(own[place])))
            if len(found) > 50_000:
                yield found
                found = []
        yield found

    def search(batches):
        slice_, n = [], 0

        def emit():
            for found in first_rows(slice_):
                columns = list(zip(*found)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["target", "anchor_id", "positive_id", "positive_score", "vec_id", "score"])

        for batch in batches:
            for at in range(0, batch.num_rows, held):
                slice_.append(batch.slice(at, held))
                n += slice_[-1].num_rows
                if n >= held:
                    yield from emit()
                    slice_, n = [], 0
        if n:
            yield from emit()

    return rows.select("vec_id", "label", "vec").mapInArrow(search, HITS)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("anchor_id", "target").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def first_of_all(rows: DataFrame, targets: DataFrame, k: int, alike: bool, width: int, primes: list[int],
                 sample: int) -> DataFrame:
    """The first k rows of every target, over all rows, with their rank."""
    some = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(sample)) == 0)
    early = ranked(scan(some, targets, k, alike, width, primes), k)
    floors = early.filter(F.col("rank") == k).groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("target", "score"))).alias("floors"))
    raised = targets.join(floors.withColumnRenamed("anchor_id", "_a"), F.col("vec_id") == F.col("_a"), "left").select(
        "vec_id", "label", "vec", F.transform("targets", lambda t: t.withField(
            "low", F.greatest(t["low"], F.coalesce(F.try_element_at("floors", t["target"]), t["low"])))).alias("targets"))
    return ranked(scan(rows, raised, k, alike, width, primes), k)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 5, every: int = 100, scale: int = 256,
    share: tuple[int, int] = (80, 100), relabel: Column | None = None, sample: int = 32,
) -> DataFrame:
    """The first ``negatives`` rows of other labels for each anchor and positive, whose score
    lies between ``share`` (a fraction as two numbers) of the positive's score and that score.

    ``relabel`` replaces the labels, for instance to repair them first.
    """
    relabel = F.col("label") if relabel is None else relabel
    rows = spill(usable_rows(vectors, scale, relabel), "negatives_rows")
    square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    anchors = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("_m")).select(
        "vec_id", "_m.label", "_m.vec")
    size = rows.agg(F.max(F.size("vec")).alias("width"), F.max(square).alias("square")).first()
    width = max(1, size["width"] or 0)
    primes = primes_for((size["square"] or 0.0) * (1 + 1e-9))

    def target(number, positive_id, positive_score, low, high):
        return F.struct(number.cast("long").alias("target"), positive_id.cast("long").alias("positive_id"),
                        positive_score.cast("long").alias("positive_score"), low.cast("long").alias("low"),
                        high.cast("long").alias("high"))

    zero = F.lit(0)
    wanted = spill(anchors.withColumn("targets", F.array(target(zero, zero, zero, F.lit(LEAST), F.lit(MOST)))), "negatives_anchors")
    near = spill(first_of_all(rows, wanted, positives, True, width, primes, sample), "negatives_positives")
    # the smallest whole score that reaches the share of the positive's
    ready = F.col("score").cast("decimal(25,0)") * share[0]
    low = F.ceil(ready / share[1]).cast("long")
    windows = near.filter(F.col("score") >= low).groupBy("anchor_id").agg(
        F.collect_list(target(F.col("rank"), F.col("vec_id"), F.col("score"), low, F.col("score"))).alias("targets"))
    asked = spill(windows.withColumnRenamed("anchor_id", "_a").join(wanted.drop("targets"), F.col("vec_id") == F.col("_a")).select(
        "vec_id", "label", "vec", "targets"), "negatives_targets")
    mined = first_of_all(rows, asked, negatives, False, width, primes, sample)
    return mined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))
