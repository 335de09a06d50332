"""Joining candles, market data and sentiment to one row per symbol and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.scalar import latest_of

ENRICHED_COLUMNS = (
    "date_day", "symbol", "open", "high", "low", "close", "volume", "quote_volume", "num_trades",
    "coingecko_price_usd", "market_cap_usd", "coingecko_volume_usd",
    "fear_greed_value", "sentiment_label", "sentiment_bucket", "latest_ingested_at",
)


def daily_enriched(
    klines: DataFrame,
    market_chart: DataFrame,
    sentiment: DataFrame,
    coin_of_symbol: DataFrame | None = None,
) -> DataFrame:
    """Daily candles, left-joined with market data and sentiment; candles drive the row count.

    The joins match on the day.  With several coins pass ``coin_of_symbol`` (symbol, coin_id):
    then market data also has to match the symbol's coin and cannot fan out.

    No broadcast hint: the sides come from aggregations, so their size is known only at run time.
    Adaptive execution broadcasts a side when its measured shuffle output is below the threshold
    and otherwise keeps the sort-merge join (with skew splitting).
    """
    price = klines.filter(F.col("interval") == "1d").select(
        F.to_date("open_time").alias("date_day"),
        "symbol", "open", "high", "low", "close", "volume", "quote_volume", "num_trades",
        F.col("ingested_at").alias("price_ingested_at"),
    )
    chart = market_chart.select(
        "date_day",
        "coin_id",
        F.col("price_usd").alias("coingecko_price_usd"),
        "market_cap_usd",
        F.col("volume_usd").alias("coingecko_volume_usd"),
        F.col("ingested_at").alias("chart_ingested_at"),
    )
    mood = sentiment.select(
        "date_day", "fear_greed_value", "sentiment_label", "sentiment_bucket",
        F.col("ingested_at").alias("sentiment_ingested_at"),
    )
    if coin_of_symbol is None:
        with_chart = price.join(chart.drop("coin_id"), "date_day", "left")
    else:
        mapped = price.join(coin_of_symbol.select("symbol", "coin_id"), "symbol", "left")
        with_chart = mapped.join(chart, ["coin_id", "date_day"], "left").drop("coin_id")
    return (
        with_chart.join(mood, "date_day", "left")
        .withColumn(
            "latest_ingested_at",
            latest_of(
                F.col("price_ingested_at"),
                F.col("chart_ingested_at"),
                F.col("sentiment_ingested_at"),
            ),
        )
        .select(*ENRICHED_COLUMNS)
    )
