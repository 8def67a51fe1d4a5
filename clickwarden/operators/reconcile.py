"""Comparison of streaming scores with batch scores."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwarden.operators.metrics import ranking_metrics

LAYERS = ("speed", "batch")


def reconcile(
    speed: DataFrame, batch: DataFrame, key: str = "txn_key", label: str = "isFraud",
    count: str | None = "dest_txn_count_so_far",
) -> DataFrame:
    """Inner join of both layers on ``key``, one row per matching pair.

    Only the needed columns reach the shuffle. Without a count column (``count=None``)
    the two count columns are left out.
    """
    left = speed.select(
        F.col(key), F.col("fraud_probability").alias("speed_probability"),
        F.col("is_flagged").alias("speed_flagged"),
        *([F.col(count).alias("speed_dest_count")] if count else []),
    )
    right = batch.select(
        F.col(key), F.col(label).alias("true_label"),
        F.col("batch_fraud_probability").alias("batch_probability"),
        F.col("batch_is_flagged").alias("batch_flagged"),
        *([F.col(count).alias("batch_dest_count")] if count else []),
    )
    counts = ["speed_dest_count", "batch_dest_count"] if count else []
    return left.join(right, key, "inner").select(
        key, "true_label", "speed_probability", "speed_flagged", "batch_probability",
        "batch_flagged", *counts,
    )


def _agree() -> Column:
    return F.col("speed_flagged") == F.col("batch_flagged")


def agreement_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(_agree().cast("int")).alias("agreement_rate"))


def flag_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("speed_flagged", "batch_flagged").agg(
        F.count(F.lit(1)).alias("count")).orderBy("speed_flagged", "batch_flagged")


def disagreements(df: DataFrame, side: str = "speed") -> DataFrame:
    """Rows only the given layer flags."""
    other = LAYERS[1 - LAYERS.index(side)]
    return df.where((F.col(f"{side}_flagged") == 1) & (F.col(f"{other}_flagged") == 0))


def false_negatives(df: DataFrame, layer: str = "speed") -> DataFrame:
    return df.where((F.col("true_label") == 1) & (F.col(f"{layer}_flagged") == 0))


def reconcile_classes(df: DataFrame) -> DataFrame:
    """Class of each pair, whether the layers disagree, and the gap of their counts."""
    disagrees = F.col("speed_flagged") != F.col("batch_flagged")
    out = df.withColumn(
        "pair_class",
        F.when(F.col("true_label") == 1, "fraud").when(disagrees, "disagree").otherwise("agree"),
    ).withColumn("disagrees", disagrees.cast("int"))
    if "batch_dest_count" in df.columns:
        gap = F.col("batch_dest_count") - F.col("speed_dest_count")
        out = out.withColumn("dest_count_gap", gap)
    return out


def layer_metrics(df: DataFrame) -> DataFrame:
    """Ranking metrics of both layers in one pass."""
    pairs = F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.col(f"{layer}_probability").alias("score"))
        for layer in LAYERS
    ])
    stacked = df.select(F.col("true_label").alias("label"), F.inline(pairs))
    return ranking_metrics(stacked, by=["layer"]).select(
        "layer", "positives", "negatives", "roc_auc", "pr_auc")


def reconcile_summary(
    speed: DataFrame, batch: DataFrame, joined: DataFrame, warn: bool = True
) -> DataFrame:
    """Row counts of both layers, matches and fraud among them.

    Warns when nothing matches, which points at differing key formats.
    """
    matched = joined.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("true_label") == 1).alias("fraud"))
    if warn:
        matched = joined.sparkSession.createDataFrame(matched.collect(), matched.schema)
        if matched.first()["n"] == 0:
            warnings.warn("no rows match; compare the key formats of both layers")
    parts = [
        speed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("speed_rows").alias("k"), "n"),
        batch.agg(F.count(F.lit(1)).alias("n")).select(F.lit("batch_rows").alias("k"), "n"),
        matched.select(F.lit("matched_rows").alias("k"), "n"),
        matched.select(F.lit("matched_fraud").alias("k"), F.col("fraud").alias("n")),
    ]
    rows = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    value = {
        k: F.max(F.when(F.col("k") == k, F.col("n")))
        for k in ("speed_rows", "batch_rows", "matched_rows", "matched_fraud")
    }
    return rows.agg(*[v.alias(k) for k, v in value.items()])


def attach_labels(
    scored: DataFrame, labels: DataFrame, key: str = "click_id", label: str = "is_fraud"
) -> DataFrame:
    """Late labels onto scored rows; rows without a label keep null."""
    late = labels.select(key, F.col(label).alias("_late"))
    return scored.drop(label).join(late, key, "left").withColumnRenamed("_late", label)


def drift_over_time(df: DataFrame, bucket: Column | str) -> DataFrame:
    """Precision and recall of both layers per time bucket."""
    bucket = F.col(bucket) if isinstance(bucket, str) else bucket
    fraud = F.col("true_label") == 1
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(fraud).alias("fraud")]
    for layer in LAYERS:
        hit = F.col(f"{layer}_flagged") == 1
        sums += [F.count_if(hit).alias(f"_{layer}_hits"),
                 F.count_if(hit & fraud).alias(f"_{layer}_tp")]
    out = df.groupBy(bucket.alias("bucket")).agg(*sums)
    zero = F.lit(0.0)
    return out.select("bucket", "n", "fraud", *[
        F.coalesce(F.try_divide(f"_{layer}_tp", base), zero).alias(f"{layer}_{name}")
        for layer in LAYERS
        for name, base in (("precision", f"_{layer}_hits"), ("recall", "fraud"))
    ])
