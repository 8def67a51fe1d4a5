from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwarden.operators import ingest, ordering, split


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, rng.choice([7, 7, rng.randrange(1000)]), rng.random()) for i in range(2000)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id long, t long, x double").repartition(5)


def test_global_index(table, rows):
    got = {r["id"]: r["row_index"] for r in ordering.global_index(table, ["t", "id"]).collect()}
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == want


def test_running_sums_cross_chunks(table, rows):
    out = ordering.running(table, ["t"], ["id"], {"n": F.lit(1).cast("bigint"), "s": F.col("id")}, 7)
    seen = {}
    want = {}
    for i, t, _ in sorted(rows):
        n, s = seen.get(t, (0, 0))
        seen[t] = want[i] = (n + 1, s + i)
    assert {r["id"]: (r["n"], r["s"]) for r in out.collect()} == want


def test_hot_keys_and_split(table, rows):
    hot = ordering.hot_keys(table, ["t"], 100)
    cold, large = hot.split(table, ["t"])
    assert {r["t"] for r in large.select("t").distinct().collect()} == {7}
    assert hot.rows == large.count() == sum(r[1] == 7 for r in rows)
    assert cold.count() + large.count() == len(rows)
    assert ordering.hot_keys(table, ["t"], 5000) is None


@pytest.mark.parametrize("position", [0, 1, 999, 1000, 1999])
def test_split_at(table, rows, position):
    early, late = split.split_at(table, ["t", "id"], position)
    ordered = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert {r["id"] for r in early.collect()} == set(ordered[:position])
    assert {r["id"] for r in late.collect()} == set(ordered[position:])


def test_split_by_text_and_nulls(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), (None, 4)], "k string, id int")
    early, late = split.split_at(df, ["k", "id"], 2)
    assert {r["id"] for r in early.collect()} == {2, 4}
    assert {r["id"] for r in late.collect()} == {1, 3}
    numbers = spark.createDataFrame([(5, 1), (None, 2), (3, 3)], "k long, id int")
    early, late = split.split_at(numbers, ["k", "id"], 1)
    assert {r["id"] for r in early.collect()} == {2}


def test_split_at_the_edge_of_a_narrow_type(spark):
    df = spark.createDataFrame([(2**31 - 1, 1), (-(2**31), 2), (0, 3)], "k int, id int")
    early, late = split.split_at(df, ["k", "id"], 2)
    assert {r["id"] for r in early.collect()} == {2, 3}
    assert {r["id"] for r in late.collect()} == {1}


def test_split_filters_are_pushed_down(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    early, _ = split.split_at(spark.read.parquet(str(tmp_path / "t")), ["t", "id"], 900)
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(t" in plan


def test_chronological_split_bounds(table):
    train, test = split.chronological_split(table, 0.2, ["t", "id"])
    assert (train.count(), test.count()) == (1600, 400)
    with pytest.raises(ValueError):
        split.chronological_split(table, 0.5, ["t", "id"])


def test_folds_are_even_and_ordered(table):
    blocks = split.walk_forward_folds(table, 5, ["t", "id"])
    sizes = {r["block"]: r["count"] for r in blocks.groupBy("block").count().collect()}
    assert sorted(sizes) == list(range(6)) and max(sizes.values()) - min(sizes.values()) <= 1
    train, test = split.fold(blocks, 2)
    assert train.agg(F.max("block")).first()[0] == 1
    assert test.agg(F.min("block")).first()[0] == 2


def test_slice_with_ties_is_exact(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 5, "t long")
    out = ingest.contiguous_slice(df, ["t"], 3, 4)
    assert sorted(r["t"] for r in out.collect()) == [1, 1, 2, 2]
    with pytest.raises(ValueError):
        ingest.contiguous_slice(df, ["t"], 8, 4)


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.8, 0.999, 1.0])
def test_quantiles(table, rows, p):
    x = [r[2] for r in rows]
    assert ordering.quantiles(table, "x", [p]).first()["value"] == pytest.approx(np.quantile(x, p))
    rank = max(0, int(np.ceil(p * len(x))) - 1)
    assert ordering.quantiles(table, "x", [p], nearest_rank=True).first()["value"] == sorted(x)[rank]


def test_order_violations(spark):
    times = [1, 2, 2, 1, 5, 4, 9]
    df = spark.createDataFrame(list(enumerate(times)), "seq long, t long").repartition(3)
    out = ingest.order_violations(df, "seq", "t").orderBy("seq").collect()
    assert [(r["seq"], r["t"], r["previous_time"]) for r in out] == [(3, 1, 2), (5, 4, 5)]


def test_stages_live_in_the_shared_folder(spark):
    from clickwarden import runtime

    assert runtime.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    before, runtime._stored[:] = list(runtime._stored), []
    stored = runtime.spill(spark.range(3))
    assert stored.count() == 3
    path = stored.inputFiles()[0]
    assert path.removeprefix("file:").lstrip("/").startswith(
        runtime.scratch_root(spark).lstrip("/"))
    assert runtime.release(spark) == 1
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    runtime._stored[:] = before


def test_broadcast_only_when_small(spark):
    """Side tables carry no hint: Spark broadcasts them by its own size threshold."""
    from clickwarden.operators.features import attach_rates

    side = spark.createDataFrame([("a", 4, 1)], "id string, clicks long, attributed long")
    joined = attach_rates(spark.range(5).selectExpr("cast(id AS string) AS campaign_id"), side, "campaign_id", "rate")
    assert "hint" not in joined._jdf.queryExecution().logical().toString().lower()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = attach_rates(spark.range(5).selectExpr("cast(id AS string) AS campaign_id"), side, "campaign_id", "rate")
        assert "Broadcast" not in again._jdf.queryExecution().executedPlan().toString()
        assert again.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def wide(spark, rows):
    return spark.createDataFrame([(v, n) for n, v in enumerate(rows)], "v long, seq long")


def test_positions_on_full_range_longs(spark):
    rng = random.Random(8)
    values = [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(3000)] + [-2 ** 63, 2 ** 63 - 1, 0, 0, 0]
    df = wide(spark, values)
    expected = sorted((v, n) for n, v in enumerate(values))
    positions = [0, 1, 700, 1500, 2999, len(values) - 1]
    found = ordering.rows_at(df, ["v", "seq"], positions)
    assert found == {p: expected[p] for p in positions}
    assert ordering.rows_at(df, ["v", "seq"], [len(values)]) == {}


def test_split_with_sentinel_dates(spark):
    df = spark.range(2000).selectExpr("timestamp_seconds(1600000000 + id) AS at", "id").union(
        spark.sql("SELECT timestamp'0001-01-01', -1L UNION ALL SELECT timestamp'9999-12-31', -2L"))
    for share in (0.1, 0.33):
        train, test = split.chronological_split(df, share, ["at", "id"])
        assert (train.count(), test.count()) == (int(2002 * (1 - share)), 2002 - int(2002 * (1 - share)))


def test_count_so_far_reads_its_input_once(spark):
    """The plans for ordinary and hot keys read stored rows, not the input's plan over again."""
    from clickwarden.operators import windows

    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, "hot" if i % 2 else f"k{i % 10}") for i in range(400)]
    source = spark.createDataFrame(rows, "i long, k string").mapInArrow(noted, "i long, k string")
    out = windows.count_so_far(source, "k", ["i"], "n", hot_rows=100).collect()
    so_far = {}
    for i, k in rows:
        so_far[k, i] = sum(1 for j, other in rows[:i] if other == k)
    assert {(r["k"], r["i"]): r["n"] for r in out} == so_far
    assert seen.value == 400
