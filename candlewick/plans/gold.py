"""Gold marts over the daily enriched table.

Each mart needs one shuffle (by entity) and one sort; all its windows share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.rolling import (
    change,
    rolling_corr,
    rolling_mean,
    rolling_std,
    series,
)
from candlewick.functions.scalar import pct_change, upper_anomaly, zscore


def price_analysis(
    enriched: DataFrame, entity: str = "symbol", short: int = 7, long: int = 30
) -> DataFrame:
    """Daily change and return, moving averages and volatility of the close."""
    window = series(entity, "date_day")
    returns = enriched.select(
        "date_day", entity, "open", "high", "low", "close", "volume", "quote_volume", "num_trades",
        "market_cap_usd", "coingecko_volume_usd",
        "fear_greed_value", "sentiment_label", "sentiment_bucket",
        change("close", window).alias("price_change_usd"),
        pct_change(F.col("close"), F.lag("close").over(window)).alias("daily_return_pct"),
        "latest_ingested_at",
    )
    return returns.select(
        "*",
        rolling_mean("close", window, short).alias(f"ma{short}_close"),
        rolling_mean("close", window, long).alias(f"ma{long}_close"),
        rolling_std("daily_return_pct", window, long).alias(f"volatility_{long}d_pct"),
    )


def sentiment_correlation(price: DataFrame, entity: str = "symbol", long: int = 30) -> DataFrame:
    """Sentiment change, next-day return and rolling sentiment/return correlation.

    Days without sentiment are dropped first: "previous" and "next" mean rows that have one.
    """
    window = series(entity, "date_day")
    return price.filter(F.col("fear_greed_value").isNotNull()).select(
        "date_day", entity, "close", "daily_return_pct", "fear_greed_value", "sentiment_label",
        "sentiment_bucket",
        change("fear_greed_value", window).alias("sentiment_change"),
        F.lead("daily_return_pct").over(window).alias("next_day_return_pct"),
        rolling_corr("fear_greed_value", "daily_return_pct", window, long)
        .alias(f"rolling_{long}d_sentiment_return_corr"),
        "latest_ingested_at",
    )


def volume_anomalies(
    price: DataFrame, entity: str = "symbol", long: int = 30, threshold: float = 2.0
) -> DataFrame:
    """Volume against its trailing mean (the current day included), with an upper-tail flag."""
    window = series(entity, "date_day")
    mean, std = f"volume_ma{long}", f"volume_std{long}"
    scored = price.select(
        "date_day", entity, "close", "volume", "quote_volume", "num_trades", "daily_return_pct",
        "fear_greed_value", "sentiment_label",
        rolling_mean("volume", window, long).alias(mean),
        rolling_std("volume", window, long).alias(std),
        "latest_ingested_at",
    ).withColumn("volume_z_score", zscore(F.col("volume"), F.col(mean), F.col(std)))
    return scored.withColumn(
        "is_volume_anomaly", upper_anomaly(F.col("volume_z_score"), F.col(std), threshold)
    )
