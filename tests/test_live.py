from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickwarden.plans import live_queries  # noqa: F401  (registers)
from clickwarden.streaming import labels, scoring, sketches

SCORED = [("a", 0, 1), ("b", 5, 0), ("c", 10, 1), ("d", 20, 1), (None, 25, 0), ("e", 30, 1)]
# in time, twice in time with two labels, too late, before its click, without a key
CAME = [("a", 30, 1), ("b", 10, 0), ("b", 40, 1), ("c", 71, 1), ("d", 19, 1), (None, 26, 1)]
WANT = [("a", 1), ("b", 0), ("b", 1), ("c", None), ("d", None), ("e", None), (None, None)]


def minutes(spark, rows, time, value):
    df = spark.createDataFrame(rows, f"click_id string, m long, {value} int")
    return df.select("click_id", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("m") * 60).alias(time), value)


def found(df):
    return sorted(((r["click_id"], r["is_fraud"]) for r in df.collect() if r["click_id"] != "end"), key=repr)


def test_late_labels_of_a_batch(spark):
    scored = minutes(spark, SCORED, "timestamp", "is_flagged").withColumn("is_fraud", F.lit(9))
    came = minutes(spark, CAME + CAME, "label_time", "is_fraud").withColumn("is_flagged", F.lit(7))
    out = labels.late_labels(scored, came, wait="1 hour")
    assert found(out) == sorted(WANT, key=repr)
    assert sorted(out.columns) == ["click_id", "is_flagged", "is_fraud", "label_time", "timestamp"]
    assert labels.late_labels(scored.limit(0), came).count() == 0
    assert found(labels.late_labels(scored, came.limit(0))) == sorted(((c, None) for c, _, _ in SCORED), key=repr)


def test_late_labels_of_streams_and_their_state(spark, tmp_path):
    """Each row once for each label, in whatever order the two streams come; nothing is held for longer than the wait."""
    scored, came = minutes(spark, SCORED, "timestamp", "is_flagged"), minutes(spark, CAME, "label_time", "is_fraud")
    end = [("end", 600, 0)]
    last = minutes(spark, end, "timestamp", "is_flagged"), minutes(spark, end, "label_time", "is_fraud")
    rows, labels_at, sink, checkpoint = (str(tmp_path / n) for n in ("rows", "labels", "sink", "checkpoint"))
    parts = [(scored.where("click_id < 'c'"), came.where("click_id > 'z'")),
             (scored.where("click_id >= 'c' or click_id is null"), came), (scored.limit(0), came), last]
    for a, b in parts:
        a.write.mode("append").parquet(rows)
        b.write.mode("append").parquet(labels_at)
        joined = labels.late_labels(
            scoring.read_file_stream(spark, rows, scored.schema, files_per_batch=100),
            scoring.read_file_stream(spark, labels_at, came.schema, files_per_batch=100), wait="1 hour", delay="2 hours")
        query = scoring.to_files(joined, sink, checkpoint, "parquet")
        scoring.drain(query)
    assert found(spark.read.parquet(sink)) == sorted(WANT, key=repr)
    held = sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"])
    assert held <= 6  # the last row of each stream only: join sides with their keys, and copies


def test_a_stream_join_stores_changes_in_one_store_a_partition(spark, tmp_path):
    scored, came = minutes(spark, SCORED, "timestamp", "is_flagged"), minutes(spark, CAME, "label_time", "is_fraud")
    rows, labels_at, sink, checkpoint = (tmp_path / n for n in ("rows", "labels", "sink", "checkpoint"))
    scored.write.parquet(str(rows))
    came.write.parquet(str(labels_at))
    joined = labels.late_labels(scoring.read_file_stream(spark, str(rows), scored.schema, files_per_batch=100),
                                scoring.read_file_stream(spark, str(labels_at), came.schema, files_per_batch=100))
    scoring.drain(scoring.to_files(joined, str(sink), str(checkpoint), "parquet"))
    assert not list((checkpoint / "state").glob("*/*/left-*"))
    assert len(list((checkpoint / "state").glob("*/*/*.changelog"))) >= 8  # of both operators, in four partitions


def test_live_drift_counts_only_labelled_rows(spark):
    rows = minutes(spark, SCORED, "timestamp", "is_flagged")
    out = labels.live_drift(labels.late_labels(rows, minutes(spark, CAME, "label_time", "is_fraud")), "1 hour").first()
    assert (out["n"], out["labelled"], out["fraud"]) == (7, 3, 2)
    assert (out["precision"], out["recall"]) == (1.0, 0.5)
    none = labels.live_drift(rows.withColumn("is_fraud", F.lit(None).cast("int")), "1 hour").first()
    assert (none["labelled"], none["precision"], none["recall"]) == (0, 0.0, 0.0)


def timed(spark, values):
    df = spark.createDataFrame(values, "m long, ip string, latency_ms double")
    return df.select(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("m") * 60).alias("timestamp"), "ip", "latency_ms")


def test_merged_sketches_equal_counts_and_keep_the_error(spark, tmp_path):
    rng = random.Random(5)
    values = [(rng.randrange(60), str(rng.randrange(500)), float(round(rng.expovariate(0.01), 3))) for _ in range(20_000)]
    df = timed(spark, values)
    write = sketches.sketch_sink(str(tmp_path / "s"))
    for part in range(3):
        for _ in range(2):  # a replay overwrites its own folder
            write(df.where(F.pmod(F.hash("latency_ms", "ip"), F.lit(3)) == part), part)
    stored = sketches.read_sketches(spark, str(tmp_path / "s"))
    hourly = sketches.merge_sketches(stored, "1 hour")
    out = sketches.sketched_report(hourly).first()
    ordered = sorted(v for _, _, v in values)
    assert (out["rows"], out["n"], out["min"], out["max"]) == (20_000, 20_000, ordered[0], ordered[-1])
    assert out["mean"] == pytest.approx(sum(ordered) / 20_000)
    for name, p in sketches.QUANTILES.items():
        rank = sum(v <= out[name] for v in ordered) / 20_000
        assert abs(rank - p) <= 2 * sketches.RANK_ERROR
    assert abs(out["keys"] - len({ip for _, ip, _ in values})) <= 25
    edges = [0.0, 50.0, 100.0, 200.0, ordered[-1]]
    bins = {r["bin"]: r["n"] for r in sketches.sketched_histogram(hourly, edges).collect()}
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        exact = sum(low <= v < high or (i == 3 and v == high) for v in ordered)
        assert abs(bins[i] - exact) <= 4 * sketches.RANK_ERROR * 20_000
    assert sum(bins.values()) == pytest.approx(20_000)


def test_sketches_of_odd_values(spark):
    df = timed(spark, [(0, "x", None), (0, None, float("nan")), (20, "y", 0.0), (20, "y", 0.0), (20, None, 2.0)])
    rows = {r["bucket"].minute: r for r in sketches.sketched_report(sketches.sketch(df)).collect()}
    assert (rows[0]["rows"], rows[0]["n"], rows[0]["p50"], rows[0]["mean"], rows[0]["keys"]) == (2, 0, None, None, 1)
    assert (rows[20]["n"], rows[20]["p50"], rows[20]["max"], rows[20]["keys"]) == (3, 0.0, 2.0, 1)
    whole = sketches.merge_sketches(sketches.sketch(df))
    assert [r["n"] for r in sketches.sketched_histogram(whole, [0.0, 1.0, 2.0]).orderBy("bin").collect()] == [2.0, 1.0]
    assert sketches.sketched_report(sketches.sketch(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        sketches.sketched_histogram(whole, [1.0, 1.0])


def test_totals_count_each_batch_once():
    totals = scoring.RunningTotals("contract", enough=10)
    totals.add("q", 0, {"valid": 3, "invalid": 1})
    totals.add("q", 1, {"valid": 2, "invalid": 0})
    totals.add("q", 1, {"valid": 1, "invalid": 1})  # told again after a restart
    totals.add("q", 0, {"valid": 3, "invalid": 1})
    assert (totals.totals["valid"], totals.totals["invalid"], totals.batches) == (4, 2, 2)
    assert not totals.full.is_set()
    totals.add("other", 0, {"valid": 4})
    assert totals.full.is_set() and totals.batches == 3


def test_monitor_stops_at_its_number_and_raises_failures(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(40).selectExpr("'{broken' as value").repartition(4).write.text(source)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    out = scoring.monitor_totals(stream, str(tmp_path / "a"), str(tmp_path / "ca"), 15, trigger={"processingTime": "2 seconds"}).first()
    assert out["malformed_json"] == out["total"] and 20 <= out["total"] < 40 and out["batches"] == out["total"] // 10
    bad = stream.select(F.raise_error(F.col("value")).cast("string").alias("value"))
    with pytest.raises(Exception, match="broken"):
        scoring.monitor_totals(bad, str(tmp_path / "b"), str(tmp_path / "cb"))
