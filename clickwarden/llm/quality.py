"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are taken where the texts are read. A bounded sample of labelled
rows (``max_train_rows``, chosen by hash of the id) trains the trees: features are cut into
histogram bins at quantiles, every tree grows level by level to a fixed depth by the best
gain over the histograms of gradients, with logistic loss. Trees of a fixed depth are
complete, so the model is three arrays (feature, threshold, leaf value) and a score is a
walk down all trees for a whole batch in numpy. Only text statistics are inputs.

Null and empty texts have zero statistics and get a score. Without usable labels of both
kinds every score is the share of good labels, or 0.5. Null ids are never held out and match
no label. Labels given several times count as often. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches, held_out, memo_of, spill

FEATURES = (
    "log_bytes", "log_words", "letters", "upper", "digits", "spaces", "punctuation", "symbols", "wide",
    "distinct_bytes", "entropy", "word_mean", "word_max", "distinct_words", "top_word", "one_char_words",
    "upper_words", "symbol_words", "log_lines", "line_mean", "distinct_lines", "pipes", "stops",
    "compressed", "bang_per_word", "pair_repeats",
)
_KIND = np.zeros((256, 7), bool)  # letter, upper, digit, space, punctuation, symbol, wide
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (_c.isascii() and _c.isalpha() or _b >= 128, _c.isascii() and _c.isupper(), _c.isascii() and _c.isdigit(),
                 _c in " \t\r\n", _c in ".,;:!?'\"()-", _c in "#$%&*@^_~|<>=+/\\[]{}`", _b >= 128)
_KIND = _KIND.astype(np.float64)
_SYMBOL_END = re.compile(r"[#$%&*@^~|<>=+]")


def document_statistics(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, upper, digits, spaces, punct, symbols, wide = (counts @ _KIND / n).tolist()
    share = counts[counts > 0] / n
    words = text.split()
    n_words = max(1, len(words))
    seen = Counter(words)
    lines = text.split("\n")
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = [len(w) for w in seen]
    pack = zlib.compressobj(1)
    packed = len(pack.compress(data)) + len(pack.flush())
    return [
        np.log1p(n), np.log1p(len(words)), letters, upper, digits, spaces, punct, symbols, wide,
        len(share) / 256, float(-(share * np.log2(share)).sum()), n / n_words, max(lengths, default=0),
        len(seen) / n_words, max(seen.values(), default=0) / n_words,
        sum(k for w, k in seen.items() if len(w) == 1) / n_words,
        sum(k for w, k in seen.items() if w.isupper()) / n_words,
        sum(k for w, k in seen.items() if _SYMBOL_END.search(w)) / n_words,
        np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines), counts[124] / n_words,
        counts[46] / n_words, packed / n, counts[33] / n_words, 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and an array of document statistics for every row."""

    def measure(batches):
        memo_of("quality")
        for batch in column_batches(batches, 500):
            values = [document_statistics(t) for t in batch.column(1).to_pylist()]
            flat = pa.array(np.array(values, np.float64).ravel())
            offsets = pa.array(np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        measure, "doc_id long, stats array<double>")


@dataclass
class BoostedTrees:
    """Complete trees of one depth as arrays of shape (trees, nodes)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        node = np.zeros((len(x), len(self.feature)), np.int64)
        trees = np.arange(len(self.feature))
        rows = np.arange(len(x))[:, None]
        for _ in range(depth):
            feature, threshold = self.feature[trees, node], self.threshold[trees, node]
            node = 2 * node + 1 + (x[rows, feature] > threshold)
        return self.base + self.leaf[trees, node - (self.leaf.shape[1] - 1)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
              bins: int = 64, penalty: float = 1.0, least_hessian: float = 1.0) -> BoostedTrees:
    """Histogram boosting with logistic loss."""
    share = float(y.mean()) if len(y) else 0.5
    empty = np.zeros((0, 2 ** depth - 1))
    if not len(y) or not 0 < share < 1:
        return BoostedTrees(float(np.log((share + 1e-6) / (1 - share + 1e-6))), empty.astype(int), empty, np.zeros((0, 2 ** depth)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature = np.zeros((trees, 2 ** depth - 1), np.int64)
    threshold = np.full((trees, 2 ** depth - 1), np.inf)
    leaf = np.zeros((trees, 2 ** depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            best = np.zeros(width)
            where = np.zeros((width, 2), np.int64) - 1
            for f in range(x.shape[1]):
                slot = (node - first) * bins + binned[:, f]
                g = np.bincount(slot, grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(slot, hess, width * bins).reshape(width, bins).cumsum(1)
                gl, hl, ga, ha = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl ** 2 / (hl + penalty) + (ga - gl) ** 2 / (ha - hl + penalty) - ga ** 2 / (ha + penalty)
                gain[(hl < least_hessian) | (ha - hl < least_hessian)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best + 1e-9
                best[better], where[better] = top[better], np.stack([np.full(width, f), at], 1)[better]
            for k in range(width):
                f, at = where[k]
                if f >= 0 and at < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][at]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        last = node - (2 ** depth - 1)
        g, h = np.bincount(last, grad, 2 ** depth), np.bincount(last, hess, 2 ** depth)
        leaf[t] = rate * g / (h + penalty)
        margin += leaf[t, last]
    return BoostedTrees(base, feature, threshold, leaf)


def training_rows(labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold: doc_id, label."""
    return labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """doc_id, text and label of the training rows. Two numbers for each of ``max_rows`` rows
    at most are broadcast, so the texts are not shuffled."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(training_rows(labels, column, max_rows)), "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000, **options) -> BoostedTrees:
    """Trees on the statistics of at most ``max_train_rows`` labelled documents."""
    sample = spill(labelled_texts(docs, labels, "quality", max_train_rows).select(
        "doc_id", "label", "text"), "quality_sample")
    stats = statistics(sample.select((F.col("doc_id") * 2 + F.col("label")).alias("doc_id"), "text")).toPandas()
    stats = stats.assign(key=[tuple(v) for v in stats["stats"]]).sort_values(["doc_id", "key"])
    x = np.array(stats["stats"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit_trees(x, (stats["doc_id"].to_numpy() % 2).astype(np.float64), **options)


def text_scores(texts: pa.Array, model: BoostedTrees) -> np.ndarray:
    return model.score(np.array([document_statistics(t) for t in texts.to_pylist()], np.float64).reshape(-1, len(FEATURES)))


def quality_scores(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000, **options) -> DataFrame:
    """Score of every row of ``docs``; higher means that label 1 is likelier."""
    model = fit_quality(docs, labels, max_train_rows, **options)

    def apply(batches):
        memo_of("quality")
        for batch in column_batches(batches, 500):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text_scores(batch.column(1), model))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(apply, "doc_id long, score double")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    model = fit_quality(docs, labels, **options)
    return keep_rows(docs, lambda texts: text_scores(texts, model) >= threshold)


def keep_rows(docs: DataFrame, decide) -> DataFrame:
    """Rows whose text passes ``decide`` (an array of texts to an array of flags), unchanged."""
    place = docs.columns.index("text")

    def filtered(batches):
        memo_of("quality")
        for batch in column_batches(batches, 500):
            yield batch.filter(pa.array(np.asarray(decide(batch.column(place)), bool)))

    return docs.mapInArrow(filtered, docs.schema)
