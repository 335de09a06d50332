"""Silver models: typed, filtered and deduplicated to their grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.operators.dedup import latest_by


def _cast(types: dict[str, str]) -> list[Column]:
    return [F.col(name).cast(kind).alias(name) for name, kind in types.items()]


def _run_partitions() -> list[Column]:
    return [
        F.col(part).cast("int").alias(f"partition_{part}") for part in ("year", "month", "day")
    ]


def union_intervals(*candles: DataFrame) -> DataFrame:
    """All rows of several candle datasets, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, candles)


def typed_klines(bronze: DataFrame) -> DataFrame:
    doubles = (
        "open", "high", "low", "close", "volume", "quote_volume",
    )
    return bronze.filter(F.col("symbol").isNotNull()).select(
        *_cast({"open_time": "timestamp", "close_time": "timestamp"}),
        *_cast({"symbol": "string", "interval": "string"}),
        *_cast(dict.fromkeys(doubles, "double")),
        *_cast({"num_trades": "int"}),
        *_cast({"taker_buy_base_vol": "double", "taker_buy_quote_vol": "double"}),
        *_cast({"ingested_at": "timestamp"}),
        *_run_partitions(),
    )


def latest_klines(typed: DataFrame) -> DataFrame:
    """One row per (symbol, interval, open_time), latest ingest wins."""
    return latest_by(typed, ["symbol", "interval", "open_time"], ["ingested_at"])


def silver_klines(*bronze: DataFrame) -> DataFrame:
    """Candles of all intervals, one row per (symbol, interval, open_time), latest ingest wins."""
    return latest_klines(typed_klines(union_intervals(*bronze)))


def typed_market_chart(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("price_usd").isNotNull()).select(
        F.to_date("date").alias("date_day"),
        F.col("date").cast("timestamp").alias("observed_at"),
        F.col("coin_id").cast("string").alias("coin_id"),
        *_cast(dict.fromkeys(("price_usd", "market_cap_usd", "volume_usd"), "double")),
        *_cast({"ingested_at": "timestamp"}),
        *_run_partitions(),
    )


def latest_market_chart(typed: DataFrame) -> DataFrame:
    """One row per (coin, day), with the time of its point: what later points are compared with."""
    return latest_by(typed, ["coin_id", "date_day"], ["observed_at", "ingested_at"])


def silver_market_chart(bronze: DataFrame) -> DataFrame:
    """One row per (coin, day): the latest point observed in the day, then the latest ingest."""
    return latest_market_chart(typed_market_chart(bronze)).select(
        "date_day", "coin_id", "price_usd", "market_cap_usd", "volume_usd", "ingested_at",
        "partition_year", "partition_month", "partition_day",
    )


def typed_sentiment(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("fear_greed_value").isNotNull()).select(
        F.to_date("date").alias("date_day"),
        *_cast({"fear_greed_value": "int", "sentiment_label": "string"}),
        *_cast({"sentiment_bucket": "string", "ingested_at": "timestamp"}),
        *_run_partitions(),
    )


def latest_sentiment_day(typed: DataFrame) -> DataFrame:
    return latest_by(typed, ["date_day"], ["ingested_at"])


def silver_sentiment(bronze: DataFrame) -> DataFrame:
    """One row per day, latest ingest wins."""
    return latest_sentiment_day(typed_sentiment(bronze))
