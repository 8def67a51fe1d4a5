from __future__ import annotations

import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwarden.operators import eda, metrics, reconcile, transactions

random.seed(3)
SCORED = [(random.random() < 0.2, round(random.random(), 1)) for _ in range(400)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame([(int(y), s) for y, s in SCORED], "label int, score double")


def test_roc_auc_counts_ties_half(scored):
    pos = [s for y, s in SCORED if y]
    neg = [s for y, s in SCORED if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(scored).first()["roc_auc"] == pytest.approx(want)


def curve():
    positives = sum(y for y, _ in SCORED)
    out = []
    for t in sorted({s for _, s in SCORED}):
        tp = sum(y for y, s in SCORED if s >= t)
        n = sum(s >= t for _, s in SCORED)
        p, r = tp / n, tp / positives
        out.append((t, p, r, 2 * p * r / max(p + r, 1e-12)))
    return out


def test_average_precision_is_stepwise(scored):
    points = [(r, p) for _, p, r, _ in reversed(curve())]
    want, last = 0.0, 0.0
    for r, p in points:
        want += (r - last) * p
        last = r
    assert metrics.average_precision(scored).first()["pr_auc"] == pytest.approx(want)


def test_pr_curve_and_best_threshold(scored):
    got = [tuple(r[c] for c in ("threshold", "precision", "recall", "f1"))
           for r in metrics.pr_curve(scored).orderBy("threshold").collect()]
    assert np.allclose(got, curve())
    best = max(curve(), key=lambda c: c[3])
    row = metrics.best_f1_threshold(scored).first()
    assert (row["threshold"], row["f1"]) == pytest.approx((best[0], best[3]))


def test_lowest_threshold_wins_ties(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2), (0, 0.9)], "label int, score double")
    assert metrics.best_f1_threshold(df).first()["threshold"] == 0.1


def test_class_weight(spark, scored):
    positives = sum(y for y, _ in SCORED)
    assert metrics.class_weight(scored).first()["class_weight"] == (400 - positives) / positives
    with pytest.raises(Exception, match="both classes"):
        metrics.class_weight(spark.createDataFrame([(1,)], "label int")).collect()


def test_metrics_are_null_without_a_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    row = metrics.ranking_metrics(df).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None


def test_histogram(spark):
    values = [0.0, 0.05, 0.1, 0.95, 1.0, 1.0]
    df = spark.createDataFrame([(v, 0.5) for v in values], "a double, b double")
    rows = metrics.score_histogram(df, ["a", "b"], 10).collect()
    got = {(r["layer"], r["bin"]): r["n"] for r in rows}
    want, _ = np.histogram(values, 10)
    assert [got[("a", i)] for i in range(10)] == list(want)
    flat, _ = np.histogram([0.5] * 6, 10)
    assert [got[("b", i)] for i in range(10)] == list(flat)


def test_latency_report(spark):
    values = [random.random() * 100 for _ in range(101)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "latency_ms double")
    row = metrics.latency_report(df).first()
    assert row["n"] == 101
    for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        assert row[name] == pytest.approx(np.quantile(values, p))
    assert row["min"] == min(values) and row["mean"] == pytest.approx(np.mean(values))


def test_threshold_uses_unrounded_probability(spark):
    df = spark.createDataFrame([(0.8599679999,), (0.859968,)], "p double")
    rows = metrics.apply_threshold(df, 0.859968, "p").collect()
    assert [r["is_flagged"] for r in rows] == [0, 1]
    assert {r["fraud_probability"] for r in rows} == {0.859968}


@pytest.fixture()
def pair(spark):
    speed = spark.createDataFrame(
        [("a", .9, 1, 3), ("b", .1, 0, 0), ("c", .8, 1, 1), ("x", .5, 1, 0)],
        "txn_key string, fraud_probability double, is_flagged int, dest_txn_count_so_far long")
    batch = spark.createDataFrame(
        [("a", .7, 1, 1, 5), ("b", .6, 1, 1, 0), ("c", .2, 0, 0, 1), ("y", .5, 1, 0, 0)],
        "txn_key string, batch_fraud_probability double, batch_is_flagged int, isFraud int, "
        "dest_txn_count_so_far long")
    return speed, batch


def test_reconcile(pair):
    joined = reconcile.reconcile(*pair)
    assert {r["txn_key"] for r in joined.collect()} == set("abc")
    assert reconcile.agreement_rate(joined).first()[0] == pytest.approx(1 / 3)
    assert [tuple(r) for r in reconcile.flag_breakdown(joined).collect()] == [
        (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    assert [r["txn_key"] for r in reconcile.disagreements(joined, "speed").collect()] == ["c"]
    assert [r["txn_key"] for r in reconcile.disagreements(joined, "batch").collect()] == ["b"]
    assert [r["txn_key"] for r in reconcile.false_negatives(joined, "speed").collect()] == ["b"]
    assert reconcile.false_negatives(joined, "batch").count() == 0
    classes = {r["txn_key"]: (r["pair_class"], r["dest_count_gap"])
               for r in reconcile.reconcile_classes(joined).collect()}
    assert classes == {"a": ("fraud", 2), "b": ("fraud", 0), "c": ("disagree", 0)}
    summary = reconcile.reconcile_summary(*pair, joined).first()
    assert tuple(summary[c] for c in (
        "speed_rows", "batch_rows", "matched_rows", "matched_fraud")) == (4, 4, 3, 2)


def test_zero_matches_warn(pair):
    speed, batch = pair
    joined = reconcile.reconcile(speed, batch.withColumn("txn_key", F.lit("none")))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        reconcile.reconcile_summary(speed, batch, joined).collect()
    assert any("no rows match" in str(w.message) for w in caught)


def test_transaction_features(spark):
    df = spark.createDataFrame([
        (1, "TRANSFER", 1.0e7, "C1", 99.0, "M1", 1), (1, "CASH_OUT", 10.0, "C2", 0.0, "M1", 0),
        (2, "CASH_OUT", 5.5, "C3", 10.0, "M1", 0), (2, "PAYMENT", 5.5, "C3", 10.0, "M1", 0)],
        "step int, type string, amount double, nameOrig string, oldbalanceOrg double, "
        "nameDest string, isFraud int")
    rows = {r["txn_key"]: r for r in transactions.transaction_features(df).collect()}
    assert set(rows) == {"C1|M1|1|10000000.00", "C2|M1|1|10.00", "C3|M1|2|5.50"}
    assert [rows[k]["dest_txn_count_so_far"] for k in sorted(rows)] == [0, 1, 2]
    assert rows["C1|M1|1|10000000.00"]["amount_to_balance_ratio"] == 1.0e5
    impact = transactions.filter_impact(df).first()
    assert (impact["removed_share"], impact["fraud_recall"]) == (0.25, 1.0)


def test_minutes_without_clicks_count_zero(spark):
    df = spark.createDataFrame([("2024-01-01 10:58:30",), ("2024-01-01 11:01:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("click_time"))
    rows = eda.clicks_per_minute(df).orderBy("minute").collect()
    assert [r["clicks"] for r in rows] == [1, 0, 0, 1]


def test_summary_and_top_lists(spark):
    rows = [("x", "c1", 1, 0)] * 120 + [("y", "c2", 0, 1)] * 110 + [("z", "c3", 1, 0)] * 5
    df = spark.createDataFrame(rows, "ip string, campaign_id string, is_fraud int, is_attributed int")
    df = df.withColumn("click_time", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    s = eda.click_summary(df).first()
    assert (s["clicks"], s["fraud"], s["attributed"], s["unique_ips"]) == (235, 125, 110, 3)
    assert [r["id"] for r in eda.top_rates(df, "campaign_id").collect()] == ["c1", "c2"]
    assert [r["id"] for r in eda.top_rates(df, "campaign_id", ascending=True).collect()] == ["c2", "c1"]
    assert [r["ip"] for r in eda.busiest_ips(df, 2).collect()] == ["x", "y"]
    assert eda.busiest_hour(df).first()["hour"] == "2024-01-01 10"
    empty = eda.click_summary(df.limit(0)).first()
    assert (empty["clicks"], empty["fraud_rate"]) == (0, 0.0)
