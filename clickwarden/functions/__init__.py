from clickwarden.functions.scalars import (
    click_id, is_integer_like, is_zero_or_one, padded_id, safe_ratio, stable_id, txn_key,
)
from clickwarden.functions.times import (
    blank_to_null, clamped_seconds, click_to_install_seconds, hour_prefix, install_delta,
    is_blank, latency_ms, micros, parse_timestamp, parse_times, plus_seconds,
    seconds_between,
)

__all__ = [
    "blank_to_null", "clamped_seconds", "click_id", "click_to_install_seconds",
    "hour_prefix", "install_delta", "is_blank", "is_integer_like", "is_zero_or_one",
    "latency_ms", "micros", "padded_id", "parse_timestamp", "parse_times", "plus_seconds",
    "safe_ratio", "seconds_between", "stable_id", "txn_key",
]
