"""The click event contract, on columns and on raw JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwarden import schemas
from clickwarden.functions import is_blank, is_integer_like, is_zero_or_one, parse_timestamp

_RECORDS = "array<map<string,string>>"


def read_record(value: Column | str) -> Column:
    """JSON object text as a map of texts; null when the text is no single object.

    The text is read as the only element of an array, so that anything after the object
    spoils it. Values stay text: one badly typed field does not spoil the others.
    """
    value = F.col(value) if isinstance(value, str) else value
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    return F.from_json(wrapped, _RECORDS, {"allowSingleQuotes": "false"})


def _single(records: Column) -> Column:
    return F.when(F.size(records) == 1, F.try_element_at(records, F.lit(1)))


def violations(present: Column | list[str], values: dict[str, Column]) -> Column:
    """Array of contract violations, empty when the record is valid.

    ``present`` holds the names of the record's keys (an array column or a fixed list) and
    ``values`` the checked values as text. Missing keys come first, sorted, then empty
    values, then bad flags. All parts are plain expressions, which keeps them in
    generated code.
    """
    # The texts of the violations.
    nothing = F.lit(None).cast("string")

    def has(name: str) -> Column:
        if isinstance(present, list):
            return F.lit(name in present)
        return F.array_contains(present, name)

    found = [
        F.when(~has(name), F.lit(f"missing required key: {name}")).otherwise(nothing)
        for name in sorted(schemas.REQUIRED_EVENT_FIELDS)
    ]
    for name in schemas.NON_EMPTY_EVENT_FIELDS:
        if name in values:
            bad = has(name) & is_blank(values[name])
            found.append(F.when(bad, F.lit(f"empty required value: {name}")).otherwise(nothing))
    for name in schemas.FLAG_EVENT_FIELDS:
        if name in values:
            value = values[name]
            found.append(
                F.when(~has(name) | F.coalesce(value.isin("0", "1"), F.lit(False)), nothing)
                .when(~is_integer_like(value), F.lit(f"{name} must be integer-like"))
                .when(~is_zero_or_one(value), F.lit(f"{name} must be 0 or 1"))
                .otherwise(nothing)
            )
    return F.array_except(F.array(*found), F.array(nothing))


def validate_clicks(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``is_malformed`` and ``errors`` to rows of raw JSON text.

    Text that is no JSON object is malformed and has no ``errors``.
    """
    staged = df.withColumn("_records", read_record(value))
    staged = staged.withColumn("_fields", _single(F.col("_records")))
    staged = staged.withColumn("_keys", F.map_keys("_fields"))
    checked = (*schemas.NON_EMPTY_EVENT_FIELDS, *schemas.FLAG_EVENT_FIELDS)
    values = {name: F.col("_fields").getItem(name) for name in checked}
    malformed = F.col("_fields").isNull()
    return staged.withColumns({
        "is_malformed": malformed,
        "errors": F.when(~malformed, violations(F.col("_keys"), values)),
    }).drop("_records", "_keys", "_fields")


def parse_clicks(df: DataFrame, value: str = "value", quarantine: bool = False) -> DataFrame:
    """JSON text to typed click events.

    Text that is no JSON object is dropped. With ``quarantine`` it is kept instead, with
    null fields and the text in ``parse_error``; a record with a time that can't be read is
    kept with a null time and its text in ``parse_error`` too.
    """
    staged = df.select(F.col(value).alias("_raw"), read_record(value).alias("_records"))
    if quarantine:
        staged = staged.select("_raw", _single(F.col("_records")).alias("_f"))
    else:
        # Exploding drops malformed rows without a filter that would read the text twice.
        one = F.when(F.size("_records") == 1, F.col("_records"))
        staged = staged.select(F.explode(one).alias("_f")).where(F.col("_f").isNotNull())
    typed, unread = [], F.lit(False)
    for field in schemas.CLICK_EVENT.fields:
        text = F.col("_f").getItem(field.name)
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            typed.append(parse_timestamp(text).alias(field.name))
            unread = unread | ((F.trim(text) != "") & parse_timestamp(text).isNull())
        elif kind == "string":
            typed.append(text.alias(field.name))
        else:
            typed.append(F.trim(text).try_cast(kind).alias(field.name))
    if quarantine:
        bad = F.col("_f").isNull() | F.coalesce(unread, F.lit(False))
        typed.append(F.when(bad, F.col("_raw")).alias("parse_error"))
    return staged.select(*typed)


def contract_report(checked: DataFrame, seconds: float | None = None) -> DataFrame:
    """Totals of valid, invalid and malformed rows; with ``seconds`` also the rate."""
    valid = (~F.col("is_malformed")) & (F.size("errors") == 0)
    invalid = (~F.col("is_malformed")) & (F.size("errors") > 0)
    out = checked.agg(
        F.count_if(valid).alias("valid"),
        F.count_if(invalid).alias("invalid"),
        F.count_if(F.col("is_malformed")).alias("malformed_json"),
        F.count(F.lit(1)).alias("total"),
    )
    if seconds is not None:
        rate = F.round(F.col("total") / F.lit(max(seconds, 1e-9)), 2)
        out = out.withColumn("messages_per_second", rate)
    return out


def check_contract_batch(df: DataFrame, max_rows: int, value: str = "value") -> DataFrame:
    """Contract totals over the first ``max_rows`` rows that arrive."""
    return contract_report(validate_clicks(df.limit(max_rows), value))
