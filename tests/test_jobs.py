from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.plans import jobs
from clickwarden.sources import readers


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """A time-ordered raw log in several files, with one busy IP that never installs."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        ip = "farm" if i % 4 == 0 else f"ip{rng.randrange(40)}"
        bought = ip != "farm" and rng.random() < 0.1
        time = f"2022-09-18 10:{i // 60:02d}:{i % 60:02d}"
        rows.append((ip, "3", str(rng.randrange(3)), "13", str(rng.randrange(4)), time,
                     "2022-09-18 11:00:00" if bought else "", str(int(bought))))
    path = str(tmp_path_factory.mktemp("log") / "raw")
    spark.createDataFrame(rows, schemas.RAW_CLICK).orderBy("click_time").write.option(
        "header", True).option("emptyValue", "").csv(path)
    return path


def test_prepare_summarise_train(spark, log, tmp_path):
    target = str(tmp_path / "out")
    meta = jobs.prepare_sample(spark, log, target, rows=300, start=50, percentile=0.99,
                               validate_order=True).first()
    assert (meta["sample_rows"], meta["sample_start_row"], meta["flagged_ips"]) == (300, 50, 1)
    assert meta["click_time_start"].isoformat() == "2022-09-18T10:00:50"
    clicks = readers.read_clicks(spark, f"{target}/clicks")
    assert clicks.where("is_fraud = 1").select("ip").distinct().first()["ip"] == "farm"
    tables = jobs.summary_report(clicks)
    assert tables["summary"].first()["clicks"] == 300
    assert all(t.count() >= 0 for t in tables.values())
    report = jobs.train_clicks(clicks, f"{target}/models", trees=2, max_iter=5, depth=2)
    assert report.count() == 4 and all(r["roc_auc"] > 0.5 for r in report.collect())


def test_unordered_source_is_refused(spark, log, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.read.option("header", True).csv(log)
    rows.orderBy(F.desc("click_time")).write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="not time ordered"):
        jobs.prepare_sample(spark, path, str(tmp_path / "out"), rows=300)
    with pytest.raises(ValueError, match="found 400"):
        jobs.prepare_sample(spark, log, str(tmp_path / "out"), rows=500)


def test_retrain_store_reconcile(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i // 10, rng.choice(["TRANSFER", "CASH_OUT", "PAYMENT"]), 10.0 + i, f"C{i}",
             rng.random() * 100, f"M{i % 7}", int(i % 9 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, schemas.TRANSACTION)
    result = jobs.batch_retrain(df, str(tmp_path / "model"), trees=2, depth=2,
                                location=str(tmp_path / "table"), table="jobs_scored")
    assert result.first()["positives"] > 0
    batch = readers.read_table(spark, "jobs_scored")
    assert batch.columns == schemas.SCORED_TRANSACTION.fieldNames()
    staging, table = str(tmp_path / "staging"), str(tmp_path / "scored")
    batch.select("txn_key", "dest_txn_count_so_far",
                 F.col("batch_fraud_probability").alias("fraud_probability"),
                 F.col("batch_is_flagged").alias("is_flagged")).write.json(f"{staging}/2024-01-01--00")
    assert jobs.staging_to_table(spark, staging, table, ["txn_key"]) == batch.count()
    assert jobs.staging_to_table(spark, staging, table, ["txn_key"]) == 0
    tables = jobs.reconcile_layers(readers.read_scored(spark, table), batch)
    assert tables["agreement"].first()[0] == 1.0
    assert tables["joined"].count() == batch.count()
    assert tables["histogram"].count() == 100
