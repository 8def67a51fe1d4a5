from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clickwarden import runtime
from clickwarden.sources import readers, writers
from clickwarden.streaming import scoring


def table(spark, ids, extra=None):
    df = spark.createDataFrame([(i, i * 0.1) for i in ids], "click_id long, p double")
    return df.withColumn("note", F.lit(extra)) if extra else df


def test_upsert_adds_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "scored")
    assert writers.upsert_insert_only(table(spark, range(5)), path, ["click_id"]) == 5
    assert writers.upsert_insert_only(table(spark, range(5)), path, ["click_id"]) == 0
    twice = table(spark, range(3, 8), "new").unionByName(table(spark, range(3, 8), "new"))
    assert writers.upsert_insert_only(twice, path, ["click_id"]) == 3
    rows = {r["click_id"]: r["note"] for r in readers.read_scored(spark, path).collect()}
    assert rows == {i: "new" if i > 4 else None for i in range(8)}
    history = writers.commit_history(spark, path).collect()
    assert [(r["version"], r["operation"], r["rows"]) for r in history] == [
        (2, "MERGE", 3), (1, "MERGE", 0), (0, "CREATE", 5)]


def test_upsert_of_missing_columns_and_partitions(spark, tmp_path):
    path = str(tmp_path / "scored")
    first = table(spark, range(4), "x").withColumn("day", F.lit("d1"))
    writers.upsert_insert_only(first, path, ["click_id"], ["day"])
    second = table(spark, range(2, 6)).withColumn("day", F.lit("d2"))
    assert writers.upsert_insert_only(second, path, ["click_id"], ["day"]) == 2
    assert readers.read_scored(spark, path).where("day = 'd2'").count() == 2


def test_duplicate_choice_repeats(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    for parts in (1, 3):
        rows = writers.distinct_on(df.repartition(parts), ["k"]).collect()
        assert {(r["k"], r["v"]) for r in rows} == {(1, "a"), (2, "c")}


def test_catalog_table(spark, tmp_path):
    df = table(spark, range(3))
    name = writers.publish_batch_table(df, "t1", "ad_fraud_test")
    writers.publish_batch_table(table(spark, range(2)), "t1", "ad_fraud_test")
    assert spark.table(name).count() == 2
    assert readers.read_table(spark, "t1", "ad_fraud_test").count() == 2


def test_snapshot_json(spark, tmp_path):
    path = tmp_path / "stats.json"
    path.write_text(json.dumps({
        "campaign": {"7": {"clicks": 100, "attributed": 2}, "8": 0.5}, "publisher": {}}, indent=2))
    tables = readers.read_snapshots(spark, str(path))
    rows = {r["id"]: (r["clicks"], r["attributed"], r["rate"]) for r in tables["campaign"].collect()}
    assert rows == {"7": (100, 2, None), "8": (0, 0, 0.5)}
    assert tables["publisher"].count() == 0


def test_snapshot_table(spark, tmp_path):
    snap = spark.createDataFrame([("7", 100, 2)], "id string, clicks long, attributed long")
    writers.write_snapshots(snap, snap.limit(0), str(tmp_path / "s"))
    loaded = writers.load_snapshots(spark, str(tmp_path / "s"))
    assert loaded["campaign"].first()["clicks"] == 100
    assert loaded["publisher"].count() == 0


def test_staging_is_read_recursively(spark, tmp_path):
    for hour in ("2024-01-01--10", "2024-01-01--11"):
        table(spark, range(2)).write.json(str(tmp_path / "staging" / hour))
    assert readers.read_staging(spark, str(tmp_path / "staging")).count() == 4
    typed = readers.read_staging(spark, str(tmp_path / "staging"), "click_id long")
    assert typed.columns == ["click_id"]


def test_transactions_from_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,isFraud\n"
                    "1,TRANSFER,181.0,C1,181.0,0.0,M2,1\n")
    row = readers.read_transactions(spark, str(path)).first()
    assert (row["step"], row["amount"], row["nameDest"], row["isFraud"]) == (1, 181.0, "M2", 1)
    assert readers.read_transactions(spark, str(path), infer=True).first()["amount"] == 181.0


def test_messages_are_keyed_and_keep_nulls(spark):
    df = spark.createDataFrame([("9", None)], "ip string, os string")
    row = writers.click_messages(df).first()
    assert row["key"] == "9" and json.loads(row["value"]) == {"ip": "9", "os": None}


def test_head_and_report(spark, make_clicks, tmp_path):
    writers.write_head(make_clicks(), str(tmp_path / "head"), 2)
    assert readers.read_clicks(spark, str(tmp_path / "head")).count() == 2
    writers.write_report(spark.createDataFrame([(1,)], "rows int"), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["rows"] == 1


def test_kafka_source_is_named_in_the_plan_only(spark):
    """The connector is not installed here; the reader must fail on that, not before."""
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.read_click_stream(
            spark, "kafka", **{"kafka.bootstrap.servers": "none:1", "subscribe": "clicks"})


def test_null_keys_are_added_once(spark, tmp_path):
    rows = spark.createDataFrame([(None, "x"), (None, "x"), ("k", "y"), (None, "z")], "id string, v string")
    path = str(tmp_path / "nulls")
    assert [writers.upsert_insert_only(rows, path, ["id", "v"]) for _ in range(3)] == [3, 0, 0]
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        writers.upsert_insert_only(rows, str(tmp_path / "broken"), ["id"])


def test_a_sink_leaves_no_stages(spark, tmp_path):
    from clickwarden import runtime
    from clickwarden.streaming import scoring

    before = len(runtime._stored)
    with runtime.stages(spark):
        kept = runtime.spill(spark.range(3), "stage")
        path = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
    rows = spark.createDataFrame([("a", 1), ("b", 0)], "click_id string, is_flagged int")
    scoring.table_sink(str(tmp_path / "t"), ["click_id"], scoring.file_alerts(str(tmp_path / "a")))(rows, 0)
    assert len(runtime._stored) == before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert spark.read.json(str(tmp_path / "a")).count() == 1


def test_only_the_partitions_of_the_batch_are_read(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = spark.createDataFrame([(i, f"2021-03-{10 + i % 4}") for i in range(40)] + [(99, None)], "id long, day string")
    assert writers.upsert_insert_only(rows, path, ["id"], ["day"], prune=True) == 41
    again = rows.where("day = '2021-03-11' or day is null").unionByName(
        spark.createDataFrame([(100, "2021-03-11"), (101, "2021-04-01")], "id long, day string"))
    assert writers.upsert_insert_only(again, path, ["id"], ["day"], prune=True) == 2
    assert writers.upsert_insert_only(again, path, ["id"], ["day"], prune=True) == 0
    assert readers.read_scored(spark, path).count() == 43


def test_schema_is_kept_beside_the_table(spark, tmp_path):
    """Widened with the table; without the file the footers are merged."""
    path = str(tmp_path / "table")
    writers.upsert_insert_only(spark.createDataFrame([(1, "a")], "id long, v string"), path, ["id"])
    assert readers.stored_schema(spark, path).fieldNames() == ["id", "v"]
    writers.upsert_insert_only(spark.createDataFrame([(2, "b", 0.5)], "id long, v string, p double"), path, ["id"])
    writers.upsert_insert_only(spark.createDataFrame([(3, "c")], "id long, v string"), path, ["id"])
    want = [(1, "a", None), (2, "b", 0.5), (3, "c", None)]
    assert sorted(map(tuple, readers.read_scored(spark, path).collect())) == want
    import shutil
    shutil.rmtree(readers.schema_path(path))
    assert sorted(map(tuple, readers.read_scored(spark, path).select("id", "v", "p").collect())) == want
    writers.upsert_insert_only(spark.createDataFrame([(4, "d")], "id long, v string"), path, ["id"])
    assert set(readers.stored_schema(spark, path).fieldNames()) == {"id", "v", "p"}


def test_backfills_are_pruned_by_range(spark, tmp_path, monkeypatch):
    """Beyond the bound on partition values the range of the batch is looked at; replays and nulls stay single."""
    monkeypatch.setattr(writers, "PARTITION_VALUES", 2)
    path = str(tmp_path / "backfill")
    rows = spark.createDataFrame([(n, n % 5 if n % 6 else None) for n in range(24)], "id long, day int")
    assert writers.upsert_insert_only(rows.where("id < 12"), path, ["id"], ["day"], prune=True) == 12
    assert writers.upsert_insert_only(rows, path, ["id"], ["day"], prune=True) == 12
    assert writers.upsert_insert_only(rows.unionByName(rows), path, ["id"], ["day"], prune=True) == 0
    assert spark.read.parquet(path).groupBy("id").count().where("count > 1").isEmpty()


def test_distinct_rows_carry_each_column_once(spark):
    from clickwarden.sources.writers import distinct_on

    rows = [(k, i % 3, float(-i % 7), None if i % 4 else "t") for k in ("a", None) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, n long, x double, t string")
    found = distinct_on(df, ["k", "n"])
    want = {}
    for row in rows:
        order = (row[2], row[3] is not None, row[3] or "")
        if (row[0], row[1]) not in want or order < want[row[0], row[1]][0]:
            want[row[0], row[1]] = order, row
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted((r for _, r in want.values()), key=str)
    # the aggregate holds the other columns once, and no copy of the keys
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "struct(x" in plan and "struct(k" not in plan
    zeros = spark.createDataFrame([(-0.0, 1), (0.0, 2)], "x double, v long")
    assert [r["v"] for r in distinct_on(zeros, ["x"]).collect()] == [1]


def test_a_stored_stage_leaves_no_shuffle_files(spark, tmp_path):
    """They fill the disk until the driver's memory is cleared, which may be never in a long job."""
    def files():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before, setting = files(), spark.conf.get(runtime.CLEANUP, None)
    stored = runtime.spill(spark.range(20000).repartition(7, "id").groupBy((F.col("id") % 5000).alias("k")).count(), "shuffled")
    deadline = time.monotonic() + 20
    while files() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not files() - before
    assert stored.count() == 5000
    assert spark.conf.get(runtime.CLEANUP, None) == setting


def test_a_batch_without_known_keys_is_stored_once(spark, tmp_path):
    path, names, plain = str(tmp_path / "table"), [], runtime.spill

    def noted(df, name="stage", codec="zstd"):
        names.append(name)
        return plain(df, name, codec)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writers, "spill", noted)
        for keys, added in (((0, 3), 3), ((3, 6), 3), ((4, 8), 2), ((0, 8), 0)):
            assert writers.upsert_insert_only(spark.range(*keys).withColumn("v", F.lit("x")), path, ["id"]) == added
    assert names == ["batch", "known", "batch", "known", "insert", "batch", "known", "insert"]
    assert sorted(r["id"] for r in readers.read_scored(spark, path).collect()) == list(range(8))


def test_alert_files_can_be_compressed(spark, tmp_path):
    rows = spark.range(3000).withColumn("text", F.lit("x" * 100))
    for codec in ("none", "gzip"):
        scoring.file_alerts(str(tmp_path / codec), codec)(rows, 0)
        assert spark.read.json(str(tmp_path / codec)).select("id", "text").exceptAll(rows).isEmpty()
    size = {c: sum(f.stat().st_size for f in (tmp_path / c).rglob("part-*")) for c in ("none", "gzip")}
    assert size["gzip"] < size["none"] / 5
