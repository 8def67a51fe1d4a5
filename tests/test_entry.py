from __future__ import annotations

import re

import __spark_entry__ as entry
from clickwarden.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
QUICK = ["rolling_counts_ip", "validate_clicks", "reconcile", "transaction_features", "roc_auc"]


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fraud_probability" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_oracle_names_the_columns(spark):
    for name in QUICK:
        df, sql = entry.queries()[name](spark, SF), entry.oracle_sql()[name]
        assert df.count() > 0
        for column in df.columns:
            assert re.search(rf"\b{column}\b", sql), (name, column)
