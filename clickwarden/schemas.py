"""Table schemas and fixed orders."""

from __future__ import annotations

from pyspark.sql import types as T

# Column sets, their order and thresholds that results depend on.
RAW_CLICK_COLUMNS = [
    "ip", "app", "device", "os", "channel", "click_time", "attributed_time", "is_attributed",
]
CLICK_COLUMNS = [
    "click_id", "ad_id", "campaign_id", "publisher_id", "device_id", "ip", "os",
    "timestamp", "click_time", "attributed_time", "is_attributed",
    "click_to_install_delta", "is_synthetic", "is_fraud",
]
REQUIRED_EVENT_FIELDS = [
    "ad_id", "campaign_id", "click_id", "click_time", "device_id", "event_timestamp",
    "ip", "is_attributed", "is_synthetic", "os", "publisher_id", "timestamp",
]
NON_EMPTY_EVENT_FIELDS = ["click_id", "ip", "click_time", "event_timestamp"]
FLAG_EVENT_FIELDS = ["is_attributed", "is_synthetic"]
CLICK_FEATURES = [
    "ip_clicks_1m", "ip_clicks_5m", "ip_clicks_1h",
    "device_clicks_1m", "device_clicks_5m", "device_clicks_1h",
    "ip_fingerprint_entropy_5m", "ip_inter_click_gap_seconds",
    "click_to_install_delta_seconds",
    "campaign_conversion_rate", "publisher_conversion_rate",
]
TRANSACTION_FEATURES = [
    "is_transfer_type", "amount_to_balance_ratio", "dest_txn_count_so_far", "amount",
]
WINDOW_SECONDS = {"1m": 60, "5m": 300, "1h": 3600}
ENTROPY_SECONDS = 300
SCORABLE_TYPES = ["TRANSFER", "CASH_OUT"]
CLICK_FLAG_THRESHOLD = 0.859968
TRANSACTION_FLAG_THRESHOLD = 0.5
STATE_TTL_MS = 7_200_000
DATABASE = "ad_fraud"
BATCH_TABLE = "batch_scored_clicks"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_s, _t, _i, _l, _d = (
    T.StringType(), T.TimestampType(), T.IntegerType(), T.LongType(), T.DoubleType(),
)

RAW_CLICK = _struct(**{name: _s for name in RAW_CLICK_COLUMNS})

CLICK = _struct(
    click_id=_s, ad_id=_s, campaign_id=_s, publisher_id=_s, device_id=_s, ip=_s, os=_s,
    timestamp=_t, click_time=_t, attributed_time=_t, is_attributed=_i,
    click_to_install_delta=_d, is_synthetic=_i, is_fraud=_i,
)

CLICK_EVENT = T.StructType(CLICK.fields + [T.StructField("event_timestamp", _t, True)])

TRANSACTION = _struct(
    step=_i, type=_s, amount=_d, nameOrig=_s, oldbalanceOrg=_d, nameDest=_s, isFraud=_i,
)

SCORED_CLICK = T.StructType(
    CLICK_EVENT.fields
    + [T.StructField(name, _d, True) for name in CLICK_FEATURES]
    + _struct(fraud_probability=_d, is_flagged=_i, scored_at=_t, latency_ms=_d).fields
)

SCORED_TRANSACTION = _struct(
    is_transfer_type=_i, amount_to_balance_ratio=_d, dest_txn_count_so_far=_l, amount=_d,
    isFraud=_i, step=_i, nameDest=_s, txn_key=_s,
    batch_fraud_probability=_d, batch_is_flagged=_i,
)

RECONCILED_COLUMNS = [
    "true_label", "speed_probability", "speed_flagged", "batch_probability",
    "batch_flagged", "speed_dest_count", "batch_dest_count",
]
