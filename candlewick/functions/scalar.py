"""Scalar Column expressions: returns, scores, classification, epochs and display text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from candlewick.contracts import SENTIMENT_RANGES, UNKNOWN_SENTIMENT


def pct_change(current: Column, previous: Column) -> Column:
    """Change in percent; null when the previous value is null or 0."""
    return F.lit(100.0) * (F.try_divide(current, previous) - F.lit(1.0))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in standard deviations; null when ``std`` is null or 0."""
    return F.try_divide(value - mean, std)


def upper_anomaly(z: Column, std: Column, threshold: float = 2.0) -> Column:
    """True from ``threshold`` deviations above the mean on (inclusive); otherwise false, never null."""
    return F.coalesce((std > 0) & (z >= F.lit(threshold)), F.lit(False))


def latest_of(primary: Column, *others: Column) -> Column:
    """The latest of several timestamps, where a missing one counts as the primary."""
    return F.greatest(primary, *(F.coalesce(other, primary) for other in others))


def bucket_case(value: str) -> str:
    """SQL text of the sentiment ranges over an SQL expression; outside all of them ``Unknown``."""
    cases = " ".join(
        f"WHEN {value} >= {low} AND {value} < {high} THEN '{label}'"
        for low, high, label in SENTIMENT_RANGES
    )
    return f"CASE {cases} ELSE '{UNKNOWN_SENTIMENT}' END"


def sentiment_bucket(value: str) -> Column:
    """Label of the range that holds a column's value."""
    return F.expr(bucket_case(f"`{value}`"))


def millis_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def seconds_to_date(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds.cast("bigint")))


def date_to_millis(day: Column) -> Column:
    """``YYYY-MM-DD`` text or a date to epoch milliseconds (UTC session)."""
    return F.unix_millis(F.to_timestamp(day))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with ``+00:00``; the fraction has six digits and is left out when it is 0."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    precise = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(precise)


def or_na(text: Column) -> Column:
    return F.coalesce(text, F.lit("n/a"))


def usd_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 0))


def percent_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.2f%%", value))


def seconds_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` (19 characters)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
