from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.functions import parse_timestamp, safe_ratio
from clickwarden.operators import contract, ingest
from clickwarden.sources import readers, writers

RAW = [("810", "77", "6", "ios", "205", "2021-03-14 09:00:30", "", "0"),
       ("811", "78", "6", "tvos", "205", "2021-03-14 09:00:33", "2021-03-14 09:00:30", "1")]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW, schemas.RAW_CLICK)


def test_map_clicks(raw):
    rows = ingest.map_clicks(raw).orderBy("ip").collect()
    assert list(rows[0].asDict()) == schemas.CLICK_COLUMNS
    assert rows[0]["campaign_id"] == rows[0]["publisher_id"] == "205"
    assert rows[0]["click_to_install_delta"] is None and rows[0]["attributed_time"] is None
    assert rows[1]["click_to_install_delta"] == -3.0
    assert len(rows[0]["click_id"]) == 32 and rows[0]["click_id"] != rows[1]["click_id"]


def test_normalized_raw_row_is_valid(raw):
    row = ingest.normalize_clicks(raw, "keep").orderBy("ip").first()
    assert row["errors"] == [] and row["ip"] == "810" and row["campaign_id"] == "205"
    again = ingest.normalize_clicks(ingest.map_clicks(raw)).orderBy("ip").first()
    assert again["click_id"] == row["click_id"]


def test_normalize_fails_on_bad_rows(raw):
    bad = raw.withColumn("is_attributed", F.lit("2"))
    kept = ingest.normalize_clicks(ingest.map_clicks(bad), "keep").first()
    assert kept["errors"] == ["is_attributed must be 0 or 1"]
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="must be 0 or 1"):
            getattr(ingest.normalize_clicks(ingest.map_clicks(bad)).select("ip"), action)()


VALID = {"click_id": "c", "ad_id": "1", "campaign_id": "2", "publisher_id": "3", "device_id": "4",
         "ip": "i", "os": "5", "timestamp": "2022-09-18 10:00:00",
         "click_time": "2022-09-18 10:00:00", "is_attributed": 0, "is_synthetic": "1",
         "event_timestamp": "2022-09-18T10:00:00+00:00"}


def changed(**fields):
    return json.dumps({k: v for k, v in {**VALID, **fields}.items() if v != "DROP"})


CASES = [
    (changed(), []),
    (changed(ip="DROP", ad_id="DROP"),
     ["missing required key: ad_id", "missing required key: ip"]),
    (changed(ip=None), ["empty required value: ip"]),
    (changed(click_id="", event_timestamp=None),
     ["empty required value: click_id", "empty required value: event_timestamp"]),
    (changed(is_attributed=2), ["is_attributed must be 0 or 1"]),
    (changed(is_attributed="x"), ["is_attributed must be integer-like"]),
    (changed(is_attributed=None), ["is_attributed must be integer-like"]),
    (changed(is_synthetic=" +1 "), []),
    (changed(is_synthetic=-1, ip="DROP"),
     ["missing required key: ip", "is_synthetic must be 0 or 1"]),
    (changed(extra={"a": 1}), []),
    ("no json", None), ("[1]", None), ("7", None), ("", None), ("null", None),
    (changed() + " x", None), (changed() + changed(), None), (changed() + "," + changed(), None),
]


def test_contract_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, value string")
    rows = contract.validate_clicks(df).orderBy("i").collect()
    for row, (text, errors) in zip(rows, CASES):
        assert row["is_malformed"] == (errors is None), text
        assert row["errors"] == errors, text
    report = contract.contract_report(contract.validate_clicks(df), seconds=2.0).first()
    assert (report["valid"], report["invalid"], report["malformed_json"]) == (3, 7, 8)
    assert report["messages_per_second"] == 9.0
    assert contract.check_contract_batch(df, 4).first()["total"] == 4


def test_parse_and_quarantine(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "value string")
    good = contract.parse_clicks(df)
    assert good.count() == 10
    assert good.schema.fieldNames() == schemas.CLICK_EVENT.fieldNames()
    kept = contract.parse_clicks(df, quarantine=True)
    assert kept.count() == len(CASES)
    assert kept.where("parse_error is not null").count() == 8
    row = good.where("click_id = 'c' and ip = 'i'").first()
    assert row["timestamp"].isoformat() == "2022-09-18T10:00:00"
    assert row["is_synthetic"] == 1 and "parse_error" not in good.columns


def test_parse_timestamp_forms(spark):
    df = spark.createDataFrame([
        ("2022-09-18 10:00:00",), ("2022-09-18T10:00:00Z",), ("2022-09-18T12:00:00+02:00",),
        ("junk",), ("",)], "t string")
    got = [r[0] for r in df.select(F.unix_seconds(parse_timestamp("t"))).collect()]
    assert got == [1663495200] * 3 + [None, None]
    numbers = spark.createDataFrame([(1663495200.5,)], "t double")
    kind = numbers.schema["t"].dataType
    assert numbers.select(F.unix_micros(parse_timestamp("t", kind))).first()[0] == 1663495200500000


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 1)], "a int, b int")
    got = [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, 0.0, 0.0]


def test_bootstrap_labels(spark):
    rows = [("busy", 0)] * 9 + [("buyer", 1)] * 9 + [(f"ip{i}", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "ip string, is_attributed int")
    out = ingest.bootstrap_labels(df, 0.95, 0.001)
    assert out.count() == len(rows)
    assert {(r["ip"], r["is_fraud"]) for r in out.collect() if r["is_fraud"]} == {("busy", 1)}


def test_bursts_reuse_fingerprints(make_clicks):
    clicks = make_clicks([(f"n{i}", f"2021-03-14 09:0{i}:00", f"ip{i}", "tablet", "alpha") for i in range(5)])
    out = ingest.labelled_bursts(clicks, 2, 4, 1).collect()
    assert len(out) == 2 * 4
    assert all(r["is_synthetic"] == r["is_fraud"] == 1 for r in out)
    assert {r["device_id"] for r in out} == {"farm-device-00", "farm-device-01"}
    assert {r["ip"] for r in out} == {"farm-00", "farm-01", "farm-02"}
    assert len({r["click_id"] for r in out}) == 8
    named = ingest.labelled_bursts(clicks, 2, 3, 1, prefix="bot", ips=1).select("ip", "ad_id").distinct()
    assert [tuple(r) for r in named.collect()] == [("bot-00", "bot-ad-001")]
    assert ingest.union_clicks(clicks, ingest.labelled_bursts(clicks, 2, 4, 1)).count() == 13
    with pytest.raises(ValueError):
        ingest.labelled_bursts(clicks, 0, 4, 1)


def test_csv_round_trip(spark, raw, tmp_path):
    raw.write.option("header", True).option("emptyValue", "").csv(str(tmp_path / "raw"))
    mapped = ingest.map_clicks(readers.read_raw_clicks(spark, str(tmp_path / "raw")))
    writers.write_clicks(mapped, str(tmp_path / "clicks"))
    back = readers.read_clicks(spark, str(tmp_path / "clicks"))
    assert back.schema.simpleString() == schemas.CLICK.simpleString()
    assert sorted(back.collect()) == sorted(mapped.collect())
    raw.drop("os").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="os"):
        readers.read_raw_clicks(spark, str(tmp_path / "short"))


def test_from_time_is_inclusive(make_clicks):
    out = ingest.from_time(make_clicks(), "2021-03-14 09:00:30")
    assert {r["click_id"] for r in out.collect()} == {"k2", "k3", "k4", "k5"}
