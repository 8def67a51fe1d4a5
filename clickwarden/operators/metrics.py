"""Exact ranking metrics, thresholds, histograms and latency figures.

Scores are counted per distinct value first. Running counts over the scores are taken over
ranges (ordering.running), so many distinct scores do not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.operators.ordering import quantiles, running


def score_counts(
    df: DataFrame, label: str = "label", score: str = "score", by: list[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score."""
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )


def _cumulative(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    return running(
        score_counts(df, label, score, by), list(by), [F.desc("threshold")],
        {"tp": F.col("pos"), "fp": F.col("neg")},
    )


def ranking_metrics(
    df: DataFrame, label: str = "label", score: str = "score", by: list[str] = ()
) -> DataFrame:
    """ROC AUC and average precision with their class counts, per group.

    Tied scores count half in the AUC. Average precision is the step-wise sum, not the
    trapezoid under the curve. Both are null when a class is missing.
    """
    by = list(by)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    sums = [
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(neg * (tp - pos / 2)).alias("_area"),
        F.sum(pos * F.try_divide(tp, tp + fp)).alias("_steps"),
    ]
    curve = _cumulative(df, label, score, by)
    totals = curve.groupBy(*by).agg(*sums) if by else curve.agg(*sums)
    return totals.select(
        *by, "positives", "negatives",
        F.try_divide(F.col("_area"), F.col("positives").cast("double") * F.col("negatives"))
        .alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("_steps") / F.col("positives")).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("pr_auc")


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall and F1 at every distinct score as threshold."""
    curve = _cumulative(df, label, score, [])
    positives = curve.agg(F.max("tp")).first()[0] or 0  # reads the stored counts only
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.lit(float(positives))),
                        F.lit(0.0))
    out = curve.select("threshold", "tp", "fp", precision.alias("precision"),
                       recall.alias("recall"))
    both = F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12))
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / both)


def best_f1_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold with the highest F1, the lowest one on ties."""
    curve = pr_curve(df, label, score)
    return curve.orderBy(F.desc("f1"), F.asc("threshold")).limit(1).select("threshold", "f1")


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive; reading it fails when a class is missing."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    one_class = (F.col("positives") == 0) | (F.col("negatives") == 0)
    stop = F.raise_error(F.lit("both classes are required")).cast("double")
    ratio = F.when(one_class, stop).otherwise(
        F.try_divide(F.col("negatives").cast("double"), F.col("positives")))
    return counts.withColumn("class_weight", ratio)


def single_feature_auc(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """ROC AUC of every feature on its own, to find leaking columns."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("v"))
        for c in columns
    ])
    stacked = df.select(label, F.inline(pairs))
    return ranking_metrics(stacked, label, "v", ["feature"]).select("feature", "roc_auc")


def walk_forward_metrics(
    scored: DataFrame, fold: str, label: str = "label", score: str = "score"
) -> DataFrame:
    """Mean and sample deviation of the ranking metrics over the folds."""
    per_fold = ranking_metrics(scored, label, score, [fold])
    return per_fold.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("roc_auc").alias("roc_auc_mean"), F.stddev_samp("roc_auc").alias("roc_auc_std"),
        F.avg("pr_auc").alias("pr_auc_mean"), F.stddev_samp("pr_auc").alias("pr_auc_std"),
    )


def apply_threshold(
    df: DataFrame, threshold: float, probability: str = "probability",
    out: str = "fraud_probability", flag: str = "is_flagged",
) -> DataFrame:
    """Flag by the unrounded probability and store it with six digits."""
    p = F.col(probability)
    return df.withColumn(flag, (p >= F.lit(threshold)).cast("int")).withColumn(out, F.round(p, 6))


def score_histogram(df: DataFrame, columns: list[str], bins: int = 50) -> DataFrame:
    """Counts in equal-width bins between each column's smallest and largest value.

    All bins appear, empty ones with zero. The top edge belongs to the last bin.
    """
    ends = [f(F.col(c).cast("double")) for c in columns for f in (F.min, F.max)]
    limits = df.agg(*ends).first()
    entries = []
    for i, name in enumerate(columns):
        low, high = limits[2 * i], limits[2 * i + 1]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        value = F.col(name).cast("double")
        bin_of = F.least(F.floor((value - low) / F.lit((high - low) / bins)), F.lit(bins - 1))
        entries.append(F.struct(
            F.lit(name).alias("layer"), bin_of.cast("int").alias("bin"),
            F.lit(low).alias("low"), F.lit((high - low) / bins).alias("width"),
        ))
    if not entries:
        return df.sparkSession.createDataFrame([], "layer string, bin int, bin_start double, n bigint")
    layers = df.select(F.inline(F.array(*entries)))
    counts = layers.where(F.col("bin").isNotNull()).groupBy("layer", "bin", "low", "width").agg(
        F.count(F.lit(1)).alias("n"))
    # One map per layer, at most `bins` entries, to add the empty bins.
    filled = counts.groupBy("layer", "low", "width").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_m"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    return filled.select("layer", "low", "width", "_m", every).select(
        "layer", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce(F.try_element_at("_m", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
    )


def latency_report(df: DataFrame, column: str = "latency_ms") -> DataFrame:
    """Count, min, p50, p95, p99, max and mean over the rows with a latency."""
    known = df.where(F.col(column).isNotNull()).select(column)
    names = {0.5: "p50", 0.95: "p95", 0.99: "p99"}
    cuts = {names[r["p"]]: r["value"] for r in quantiles(known, column, list(names)).collect()}
    value = F.col(column).cast("double")
    return known.agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("min"),
        *[F.lit(cuts[n]).cast("double").alias(n) for n in names.values()],
        F.max(value).alias("max"), F.avg(value).alias("mean"),
    )
