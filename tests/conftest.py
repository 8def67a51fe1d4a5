from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickwarden.runtime import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = configure(
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Two IPs on one tablet, three clicks at one moment, gaps of exactly one and five minutes.
CLICK_ROWS = [
    ("k1", "2021-03-14 08:59:30", "10.0.0.1", "tablet", "alpha"),
    ("k2", "2021-03-14 09:00:30", "10.0.0.1", "tablet", "beta"),
    ("k3", "2021-03-14 09:00:30", "10.0.0.2", "tablet", "alpha"),
    ("k4", "2021-03-14 09:00:30", "10.0.0.1", "phone", "beta"),
    ("k5", "2021-03-14 09:05:30", "10.0.0.2", "tv", "gamma"),
]


@pytest.fixture()
def make_clicks(spark):
    """Canonical clicks from (click_id, time, ip, device, os) rows."""
    def make(rows=CLICK_ROWS, campaign="spring"):
        schema = "click_id string, t string, ip string, device_id string, os string"
        return spark.createDataFrame(rows, schema).selectExpr(
            "click_id", "cast(t as timestamp) as timestamp", "cast(t as timestamp) as click_time",
            "ip", "device_id", "os", f"'{campaign}' as campaign_id",
            f"'{campaign}' as publisher_id", "cast(null as timestamp) as attributed_time",
            "cast(null as double) as click_to_install_delta", "'1' as ad_id",
            "0 as is_attributed", "0 as is_synthetic", "0 as is_fraud")
    return make
