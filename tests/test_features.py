from __future__ import annotations

import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.operators import features, windows
from clickwarden.plans import feature_queries, store_queries
from clickwarden.runtime import spill


def by_id(df, key="click_id"):
    return {row[key]: row for row in df.collect()}


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "id string, clicks long, attributed long")


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_ties_edges_and_a_shared_device(spark, make_clicks, hot_rows):
    snap = snapshot(spark, [("spring", 40, 3)])
    rows = by_id(features.click_features(make_clicks(), snap, snap, hot_rows=hot_rows))
    ids = ["k1", "k2", "k3", "k4", "k5"]

    def column(name):
        return [rows[i][name] for i in ids]

    assert column("ip_clicks_1m") == [1, 2, 1, 3, 1]  # k1 lies on the closed edge
    assert column("ip_clicks_5m") == [1, 2, 1, 3, 2]
    assert column("device_clicks_1h") == [1, 2, 3, 1, 1]
    assert column("ip_inter_click_gap_seconds") == [0, 60, 0, 0, 300]
    assert column("ip_fingerprint_entropy_5m") == pytest.approx([0, 1, 0, math.log2(3), 1])
    assert set(column("campaign_conversion_rate")) == {0.075}


def test_repeated_snapshot_ids_add_up(spark, make_clicks):
    snap = snapshot(spark, [("spring", 10, 1), ("spring", 30, 2), (None, 5, 5)])
    out = features.attach_rates(make_clicks(), snap, "campaign_id", "rate").collect()
    assert len(out) == 5 and {r["rate"] for r in out} == {0.075}


def test_click_time_stands_in_for_a_missing_time(make_clicks):
    rows = by_id(features.click_features(make_clicks().drop("timestamp")))
    assert rows["k4"]["ip_clicks_1m"] == 3


def test_window_edge_is_closed(make_clicks):
    rows = by_id(features.click_features(make_clicks([
        ("a", "2022-09-18 10:00:00", "x", "d", "1"),
        ("b", "2022-09-18 10:01:00", "x", "d", "1"),
        ("c", "2022-09-18 10:02:00.000001", "x", "d", "1")])))
    assert rows["b"]["ip_clicks_1m"] == 2
    assert rows["c"]["ip_clicks_1m"] == 1


def test_device_scope(make_clicks):
    clicks = make_clicks([
        ("a", "2022-09-18 10:00:00", "x", "shared", "1"),
        ("b", "2022-09-18 10:00:05", "y", "shared", "1")])
    everywhere = by_id(features.click_features(clicks))
    within = by_id(features.click_features(clicks, device_scope="per_ip"))
    assert everywhere["b"]["device_clicks_1m"] == 2
    assert within["b"]["device_clicks_1m"] == 1


def test_null_keys_form_one_group(make_clicks):
    clicks = make_clicks([
        ("a", "2022-09-18 10:00:00", None, None, "1"),
        ("b", "2022-09-18 10:00:05", None, None, "1")])
    for hot_rows in (None, 1):
        rows = by_id(features.click_features(clicks, hot_rows=hot_rows))
        assert rows["b"]["ip_clicks_1m"] == 2
        assert rows["b"]["device_clicks_1m"] == 2
        assert rows["b"]["ip_inter_click_gap_seconds"] == 5


def test_duplicate_ids_keep_all_rows(make_clicks):
    clicks = make_clicks([("a", "2022-09-18 10:00:00", "x", "d", "1")] * 5)
    for hot_rows in (None, 1):
        out = features.click_features(clicks, hot_rows=hot_rows).collect()
        assert sorted(r["ip_clicks_1m"] for r in out) == [1, 2, 3, 4, 5]


def test_rates_and_install_delta(spark, make_clicks):
    clicks = make_clicks().withColumn(
        "campaign_id", F.when(F.col("click_id") == "k1", "none").when(
            F.col("click_id") == "k2", "idle").otherwise("spring"))
    clicks = clicks.withColumn("click_to_install_delta", F.when(F.col("click_id") == "k3", -3.0))
    clicks = clicks.withColumn("attributed_time", F.when(
        F.col("click_id") == "k4", F.col("timestamp") + F.expr("interval 9 seconds")).when(
        F.col("click_id") == "k5", F.col("timestamp") - F.expr("interval 9 seconds")))
    rows = by_id(features.click_features(
        clicks, snapshot(spark, [("spring", 4, 1), ("idle", 0, 0)]), None))
    assert [rows[i]["campaign_conversion_rate"] for i in ("k1", "k2", "k3")] == [0.0, 0.0, 0.25]
    assert rows["k1"]["publisher_conversion_rate"] == 0.0
    assert [rows[i]["click_to_install_delta_seconds"] for i in ("k3", "k4", "k5", "k1")] == [-3.0, 9.0, 0.0, 0.0]


def test_vector_order_and_nulls(spark):
    row = spark.createDataFrame(
        [tuple(float(i) for i in range(11))], schemas.CLICK_FEATURES)
    assert features.vectorize(row).first()["vector"] == [float(i) for i in range(11)]
    odd = spark.createDataFrame([("", None)], "ip_clicks_1m string, ip_clicks_5m double")
    assert features.vectorize(odd).first()["vector"] == [0.0] * 11


def brute(rows, widths):
    """Expected values by (time, seq) order within the ip."""
    seen, out = defaultdict(list), {}
    for seq, us, ip, value in sorted(rows, key=lambda r: (r[1], r[0])):
        before = list(seen[ip])
        seen[ip].append((us, value))
        inside = {w: [v for t, v in seen[ip] if t >= us - w * 1_000_000] for w in widths}
        bag = Counter(inside[300])
        n = sum(bag.values())
        out[seq] = (
            [len(inside[w]) for w in widths],
            -sum(c / n * math.log2(c / n) for c in bag.values()),
            (us - before[-1][0]) / 1e6 if before else 0.0, len(before))
    return out


def computed(df, hot_rows):
    widths = {"w60": 60, "w300": 300, "w3600": 3600}
    df = windows.rolling_counts(df, "ip", widths, "us", "seq", hot_rows)
    df = windows.rolling_entropy(df, "ip", ["v"], 300, "entropy", "us", "seq", hot_rows)
    df = windows.inter_click_gap(df, "ip", "gap", "us", "seq", hot_rows)
    df = windows.count_so_far(df, "ip", ["us", "seq"], "before", hot_rows)
    return {r["seq"]: ([r[w] for w in widths], r["entropy"], r["gap"], r["before"])
            for r in df.collect()}


def assert_matches(spark, rows, hot_rows):
    df = spill(spark.createDataFrame(rows, "seq long, us long, ip string, v string"))
    got, want = computed(df, hot_rows), brute(rows, [60, 300, 3600])
    assert got.keys() == want.keys()
    for seq in want:
        assert got[seq][0] == want[seq][0]
        assert got[seq][1] == pytest.approx(want[seq][1], abs=1e-7)
        assert got[seq][2:] == want[seq][2:]


# Times in steps of 20 s: many ties and exact window edges.
click = st.tuples(st.integers(0, 60), st.sampled_from("ab"), st.sampled_from("xyz"))


@settings(max_examples=4, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(st.lists(click, min_size=1, max_size=60))
def test_windows_match_brute_force(spark, clicks):
    rows = [(i, t * 20_000_000, ip, v) for i, (t, ip, v) in enumerate(clicks)]
    assert_matches(spark, rows, None)


def test_one_key_spread_over_chunks(spark):
    """One IP holds nearly all rows and one moment a third of them."""
    rows = [(i, (i % 97) * 20_000_000 if i % 3 else 40_000_000, "hot" if i % 10 else "cold",
             "xyz"[i % 3]) for i in range(900)]
    assert_matches(spark, rows, 100)


def test_shannon_entropy(spark):
    df = spark.createDataFrame(
        [("g", "a"), ("g", "a"), ("g", "b"), ("g", "c"), ("h", "a")], "g string, v string")
    rows = by_id(features.shannon_entropy(df, ["g"], ["v"]), "g")
    assert rows["g"]["entropy"] == pytest.approx(1.5)
    assert rows["h"]["entropy"] == 0.0


def test_snapshot_on_first_rows(make_clicks):
    clicks = make_clicks().withColumn("is_attributed", F.lit(1))
    snap = features.conversion_snapshots(clicks, "campaign_id", 3).collect()
    assert [(r["id"], r["clicks"], r["attributed"]) for r in snap] == [("spring", 3, 3)]


def test_ip_windows_share_one_exchange(spark, make_clicks):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = spill(make_clicks())
        plan = features.click_features(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Python" not in plan


def test_training_carries_only_what_its_features_read(spark, tmp_path, monkeypatch):
    """The same features as of whole clicks, also where devices are hot and the rows are stored on the way."""
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=7 * (i % 90)), i % 5, ("view", "purchase")[i % 2], i % 3 + 0.5,
             None if i % 13 == 0 else f'{{"k": {i % 30}}}') for i in range(120)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    stored, plain = [], features.spill

    def noted(df, *args):
        stored.append(df.columns)
        return plain(df, *args)

    monkeypatch.setattr(features, "spill", noted)
    spark.conf.set("clickwarden.hotKeyRows", "10")
    try:
        got = store_queries._training(spark, str(tmp_path)).drop("is_fraud").collect()
        assert stored and not {"click_id", "ad_id", "click_time"} & {c for columns in stored for c in columns}
        want = feature_queries.all_features(spark, str(tmp_path)).select("seq", "us", *schemas.CLICK_FEATURES).collect()
    finally:
        spark.conf.unset("clickwarden.hotKeyRows")
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 120
