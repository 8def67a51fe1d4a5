"""Whole jobs: prepare a labelled sample, summarise, train, retrain, store, reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.operators import (
    eda, features, ingest, metrics, models, reconcile, transactions,
)
from clickwarden.runtime import spill
from clickwarden.sources import readers, writers

ORDER = ["timestamp", "click_id"]


def prepare_sample(
    spark: SparkSession, source: str, target: str, rows: int = 1_000_000, start: int = 0,
    percentile: float = 0.999, max_rate: float = 0.001, validate_order: bool = False,
) -> DataFrame:
    """Raw log to labelled clicks: number, check order, slice, map, label, write.

    Writes ``clicks``, ``clicks_1k`` and ``metadata`` below ``target`` and returns the
    metadata row.
    """
    raw = readers.read_raw_clicks(spark, source, "source_row")
    at = F.col("source_row")
    inside = raw.where((at >= start) & (at < start + rows))
    found = inside.count()
    if rows < 1 or start < 0 or found != rows:
        raise ValueError(f"asked for {rows} rows from {start}, found {found}")
    checked = raw if validate_order else inside
    wrong = ingest.order_violations(checked, "source_row", "click_time").orderBy("source_row").first()
    if wrong is not None:
        raise ValueError(
            f"source is not time ordered at row {wrong['source_row']}: {wrong['click_time']} "
            f"follows {wrong['previous_time']}")
    clicks = spill(ingest.map_clicks(inside), "mapped")
    labelled = spill(ingest.bootstrap_labels(clicks, percentile, max_rate), "labelled")
    writers.write_clicks(labelled, f"{target}/clicks")
    writers.write_head(labelled, f"{target}/clicks_1k")
    metadata = ingest.sample_metadata(labelled, percentile, max_rate, start).withColumn(
        "source_order_validated", F.lit(validate_order))
    writers.write_report(metadata, f"{target}/metadata")
    return metadata


def summary_report(clicks: DataFrame) -> dict[str, DataFrame]:
    """The tables of the click summary, by name."""
    return {
        "summary": eda.click_summary(clicks),
        "label_balance": eda.label_balance(clicks),
        "busiest_hour": eda.busiest_hour(clicks),
        "clicks_per_minute": eda.clicks_per_minute(clicks),
        "top_campaigns": eda.top_rates(clicks, "campaign_id"),
        "top_publishers": eda.top_rates(clicks, "publisher_id"),
        "worst_campaigns": eda.top_rates(clicks, "campaign_id", 15, ascending=True),
        "busiest_ips": eda.busiest_ips(clicks),
        "ip_stats": ingest.ip_stats(clicks),
    }


def train_clicks(
    clicks: DataFrame, target: str, test_fraction: float = 0.2, trees: int = 120,
    max_iter: int = 500, depth: int = models.DEPTH, device_scope: str = "global",
) -> DataFrame:
    """Snapshots on the training part, features, all models, artifacts and the report.

    Train with ``device_scope="per_ip"`` for a model that scores a stream keyed by IP.
    """
    spark = clicks.sparkSession
    cutoff = int(clicks.count() * (1 - test_fraction))
    writers.write_snapshots(
        *[features.conversion_snapshots(clicks, f"{side}_id", cutoff, ORDER)
          for side in ("campaign", "publisher")], f"{target}/snapshots")
    snaps = writers.load_snapshots(spark, f"{target}/snapshots")
    enriched = spill(
        features.click_features(clicks, snaps["campaign"], snaps["publisher"], device_scope).select(
            *ORDER, *schemas.CLICK_FEATURES, "is_fraud"), "features")
    report, boosted = models.fit_and_compare(
        enriched, test_fraction=test_fraction, trees=trees, max_iter=max_iter, depth=depth,
        order=ORDER)
    report = spill(report, "report")
    models.save_model(boosted, f"{target}/model", schemas.CLICK_FEATURES, spark)
    writers.write_report(report, f"{target}/metrics")
    return report


def batch_retrain(
    transactions_df: DataFrame, model_path: str, trees: int = 200, depth: int = models.DEPTH,
    order: list[str] = ("step", "nameOrig"), location: str | None = None,
    table: str = schemas.BATCH_TABLE, database: str = schemas.DATABASE,
) -> DataFrame:
    """Features, time split, training, and the newest part scored into the catalog.

    Returns the ranking metrics on the newest part. No rows pass through the driver.
    """
    names = schemas.TRANSACTION_FEATURES
    feats = transactions.transaction_features(transactions_df, list(order))
    ready = spill(models.assemble(feats, names, "isFraud"), "training")
    train, test = transactions.split_by_quantile(ready)
    model = models.retrain(train, trees, depth)
    models.save_model(model, model_path, names, transactions_df.sparkSession)
    scored = spill(models.score(model, test), "scored")
    flagged = metrics.apply_threshold(
        scored, schemas.TRANSACTION_FLAG_THRESHOLD, "score", "_rounded", "batch_is_flagged")
    writers.publish_batch_table(
        flagged.select(*names, "isFraud", "step", "nameDest", "txn_key",
                       F.col("score").alias("batch_fraud_probability"), "batch_is_flagged"),
        table, database, location)
    return metrics.ranking_metrics(scored)


def staging_to_table(
    spark: SparkSession, staging: str, path: str, keys: list[str] = ("click_id",), schema=None
) -> int:
    """Commit staged JSON files into the scored table; running it again adds nothing."""
    return writers.upsert_insert_only(readers.read_staging(spark, staging, schema), path, list(keys))


def reconcile_layers(
    speed: DataFrame, batch: DataFrame, key: str = "txn_key", label: str = "isFraud",
    count: str | None = "dest_txn_count_so_far",
) -> dict[str, DataFrame]:
    """Every table of the reconciliation from one stored join."""
    joined = spill(reconcile.reconcile(speed, batch, key, label, count), "reconciled")
    return {
        "joined": joined,
        "summary": reconcile.reconcile_summary(speed, batch, joined),
        "agreement": reconcile.agreement_rate(joined),
        "breakdown": reconcile.flag_breakdown(joined),
        "metrics": reconcile.layer_metrics(joined),
        "speed_only": reconcile.disagreements(joined, "speed"),
        "batch_only": reconcile.disagreements(joined, "batch"),
        "speed_misses": reconcile.false_negatives(joined, "speed"),
        "batch_misses": reconcile.false_negatives(joined, "batch"),
        "classes": reconcile.reconcile_classes(joined),
        "histogram": metrics.score_histogram(joined, ["speed_probability", "batch_probability"]),
    }
