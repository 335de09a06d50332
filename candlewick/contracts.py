"""Dataset contracts: schemas, grains, required columns and fixed domain values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------------------------
# These must equal what the upstream APIs and existing Bronze trees use.
# ---------------------------------------------------------------------------------------------

# Half-open integer ranges [low, high) of the sentiment index and their labels.
SENTIMENT_RANGES = (
    (0, 25, "Extreme Fear"),
    (25, 50, "Fear"),
    (50, 51, "Neutral"),
    (51, 75, "Greed"),
    (75, 101, "Extreme Greed"),
)
UNKNOWN_SENTIMENT = "Unknown"
SENTIMENT_BUCKETS = tuple(label for _, _, label in SENTIMENT_RANGES)

# Candle intervals the exchange API accepts.
VALID_INTERVALS = (
    "1m", "3m", "5m", "15m", "30m",
    "1h", "2h", "4h", "6h", "12h",
    "1d", "3d", "1w", "1M",
)
# Intervals that are persisted.
STORED_INTERVALS = ("1d", "1h")
KLINE_PAGE_SIZE = 1000

DEFAULT_SYMBOLS = ("BTCUSDT",)
DEFAULT_COINS = ("bitcoin",)

# ---------------------------------------------------------------------------------------------
# Schemas (timestamps are UTC)
# ---------------------------------------------------------------------------------------------

_TYPES = {
    "string": StringType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


LANDING = _schema(
    payload_id="string", source="string", dataset="string", entity="string", interval="string",
    fetched_at="timestamp", body="string",
)
MARKET_CHART = _schema(
    date="timestamp", coin_id="string", price_usd="double", market_cap_usd="double",
    volume_usd="double", ingested_at="timestamp",
)
KLINES = _schema(
    open_time="timestamp", close_time="timestamp", symbol="string", interval="string",
    open="double", high="double", low="double", close="double", volume="double",
    quote_volume="double", num_trades="bigint", taker_buy_base_vol="double",
    taker_buy_quote_vol="double", ingested_at="timestamp",
)
SENTIMENT_INDEX = _schema(
    date="timestamp", fear_greed_value="bigint", sentiment_label="string",
    sentiment_bucket="string", ingested_at="timestamp",
)
TICK = _schema(
    symbol="string", price="double", quantity="double", event_time="timestamp",
    trade_id="bigint", is_buyer_maker="boolean",
)
RUN_PARTITIONS = ("year", "month", "day")


@dataclass(frozen=True)
class DatasetSpec:
    """What a Bronze dataset must look like before it may be written."""

    source: str
    dataset: str
    schema: StructType
    required: tuple[str, ...]
    non_null: tuple[str, ...]
    time_col: str


_KLINE_REQUIRED = (
    "open_time", "close_time", "symbol", "interval", "open", "high", "low", "close",
    "volume", "quote_volume", "num_trades", "ingested_at",
)
_KLINE_NON_NULL = ("open_time", "close_time", "symbol", "open", "close", "ingested_at")

DATASETS = (
    DatasetSpec(
        "coingecko", "market_chart", MARKET_CHART,
        required=tuple(MARKET_CHART.names),
        non_null=("date", "coin_id", "price_usd", "ingested_at"),
        time_col="date",
    ),
    DatasetSpec("binance", "klines_1d", KLINES, _KLINE_REQUIRED, _KLINE_NON_NULL, "open_time"),
    DatasetSpec("binance", "klines_1h", KLINES, _KLINE_REQUIRED, _KLINE_NON_NULL, "open_time"),
    DatasetSpec(
        "feargreed", "index", SENTIMENT_INDEX,
        required=tuple(SENTIMENT_INDEX.names),
        non_null=("date", "fear_greed_value", "sentiment_label", "ingested_at"),
        time_col="date",
    ),
)


def dataset_spec(dataset: str) -> DatasetSpec:
    """Return the spec of a dataset; unknown names raise ``KeyError``."""
    for spec in DATASETS:
        if spec.dataset == dataset:
            return spec
    raise KeyError(f"Unknown dataset '{dataset}'; there are {[s.dataset for s in DATASETS]}")


# Grain of each modelled table.
GRAINS = {
    "silver_klines": ("symbol", "interval", "open_time"),
    "silver_market_chart": ("coin_id", "date_day"),
    "silver_sentiment": ("date_day",),
    "daily_enriched": ("symbol", "date_day"),
    "mart_price_analysis": ("symbol", "date_day"),
    "mart_sentiment_correlation": ("symbol", "date_day"),
    "mart_volume_anomalies": ("symbol", "date_day"),
}


@dataclass(frozen=True)
class Layout:
    """How a versioned table is stored: its layer, partition keys, and the column that holds its day.

    ``period`` among the keys is the day's year.  ``hidden`` columns are needed to merge the table with
    later rows and are not shown.
    """

    layer: str
    day: str
    keys: tuple[str, ...] = ("period",)
    hidden: tuple[str, ...] = ()


# ``series_periods`` counts the rows of each symbol and period; it says how far frames reach.
LAYOUTS = {
    "silver_klines": Layout("silver", "open_time", ("interval", "period")),
    "silver_market_chart": Layout("silver", "date_day", hidden=("observed_at",)),
    "silver_sentiment": Layout("silver", "date_day"),
    "daily_enriched": Layout("silver", "date_day"),
    "series_periods": Layout("silver", "first_day"),
    "mart_price_analysis": Layout("gold", "date_day"),
    "mart_sentiment_correlation": Layout("gold", "date_day"),
    "mart_volume_anomalies": Layout("gold", "date_day"),
}
MARTS = ("mart_price_analysis", "mart_volume_anomalies", "mart_sentiment_correlation")
