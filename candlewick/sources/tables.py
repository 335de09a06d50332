"""Candles, market charts, sentiment and payloads derived from the benchmark tables.

Prices are taken in whole units (cents for events), so sums are exact in any order of rows.
Everything aggregates to (symbol, day) or (symbol, hour) first.  The aggregates keep fixed-width
buffers, so Spark uses hash aggregation with map-side partial results: a symbol or day that holds
a third of all rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.contracts import KLINES, LANDING
from candlewick.functions.scalar import bucket_case

BASKET = "basket"

# Schemas of the tables used here: reading with a schema needs no inference job, and as UTC
# timestamps the times need no per-row conversion.
SCHEMAS = {
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
}

# A line item's discount as an index value from 0 to 100.
DISCOUNT_INDEX = "floor(l_discount * 1000 + 0.5)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def index_label(value: str) -> str:
    """The 'API' label of an index value: our bucket, but with a name of its own at the top."""
    return f"CASE WHEN {value} = 100 THEN 'Euphoria' ELSE {bucket_case(value)} END"


def _candles(
    rows: DataFrame, symbol: str, ts: str, price: str, order: str, bought: str, interval: str
) -> DataFrame:
    """OHLCV of raw rows; ``order`` must be unique, it decides which row opens and closes a bar."""
    hour = f"hour({ts})" if interval == "1h" else "0"
    span = "INTERVAL 1 HOUR" if interval == "1h" else "INTERVAL 1 DAY"
    trades = rows.selectExpr(
        f"CAST({symbol} AS STRING) AS symbol",
        f"to_date({ts}) AS day",
        f"{hour} AS hour",
        f"CAST(floor({price} + 0.5) AS DOUBLE) AS price",
        f"{order} AS seq",
        f"{bought} AS bought",
    )
    keys = ["symbol", "day", "hour"] if interval == "1h" else ["symbol", "day"]
    bars = trades.groupBy(*keys).agg(
        F.expr("min_by(price, seq) AS open"),
        F.expr("max(price) AS high"),
        F.expr("min(price) AS low"),
        F.expr("max_by(price, seq) AS close"),
        F.expr("sum(price) AS quote_volume"),
        F.expr("count(*) AS num_trades"),
        F.expr("sum(if(bought, price, 0D)) AS taker_buy_quote_vol"),
    )
    opened = "CAST(day AS TIMESTAMP)"
    if interval == "1h":
        opened = f"{opened} + make_dt_interval(0, hour)"
    return bars.selectExpr("*", f"{opened} AS open_time").selectExpr(
        "open_time",
        f"open_time + {span} - INTERVAL 1 MILLISECOND AS close_time",
        "symbol",
        f"'{interval}' AS interval",
        "open", "high", "low", "close",
        "quote_volume / 4 AS volume",
        "quote_volume",
        "num_trades",
        "taker_buy_quote_vol / 4 AS taker_buy_base_vol",
        "taker_buy_quote_vol",
        f"open_time + {span} AS ingested_at",
    ).select(*KLINES.names)


def order_candles(
    spark: SparkSession, sf_dir: str, symbol: str = "o_orderstatus", interval: str = "1d"
) -> DataFrame:
    """Candles of order prices: few symbols with a long history, or one symbol per customer."""
    return _candles(
        table(spark, sf_dir, "orders"), symbol, "o_orderdate", "o_totalprice", "o_orderkey",
        "o_orderpriority IN ('1-URGENT', '2-HIGH')", interval,
    )


def event_candles(spark: SparkSession, sf_dir: str, interval: str) -> DataFrame:
    """Candles of event values per event type, daily or hourly."""
    return _candles(
        table(spark, sf_dir, "events"), "event_type", "ts", "value * 100", "event_id",
        "user_id % 2 = 0", interval,
    )


def lineitem_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per ship day: turnover, quantity and the discount index of the last line item; one scan.

    Order, then line number, then the value itself decide which item is last; they are compared as
    they are, whatever their sizes.
    """
    last = f"struct(l_orderkey, l_linenumber, {DISCOUNT_INDEX} AS value)"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.expr("to_date(l_shipdate) AS date_day"))
        .agg(
            F.expr("sum(CAST(floor(l_extendedprice + 0.5) AS DOUBLE)) AS market_cap_usd"),
            F.expr("sum(l_quantity) AS volume_usd"),
            F.expr(f"max({last}).value AS fear_greed_value"),
        )
    )


def market_chart(days: DataFrame) -> DataFrame:
    """Daily market chart of all line items: average unit price, turnover, quantity.

    ``date_day`` is the grouping key itself, so the optimizer knows that it is unique.
    """
    return days.selectExpr(
        "date_day",
        "CAST(date_day AS TIMESTAMP) AS date",
        f"'{BASKET}' AS coin_id",
        "CAST(floor(try_divide(market_cap_usd, volume_usd)) AS DOUBLE) AS price_usd",
        "market_cap_usd",
        "volume_usd",
        "CAST(date_day AS TIMESTAMP) + INTERVAL 26 HOURS AS ingested_at",
    )


def coin_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily market charts of several coins: the line items of each return flag."""
    days = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.expr("to_date(l_shipdate) AS date_day"), F.expr("l_returnflag AS coin_id"))
        .agg(
            F.expr("sum(CAST(floor(l_extendedprice + 0.5) AS DOUBLE)) AS market_cap_usd"),
            F.expr("sum(l_quantity) AS volume_usd"),
        )
    )
    return days.selectExpr(
        "date_day",
        "coin_id",
        "CAST(floor(try_divide(market_cap_usd, volume_usd)) AS DOUBLE) AS price_usd",
        "market_cap_usd",
        "volume_usd",
        "CAST(date_day AS TIMESTAMP) + INTERVAL 26 HOURS AS ingested_at",
    )


def sentiment_index(days: DataFrame) -> DataFrame:
    """Daily sentiment index with the API's label and our bucket."""
    return days.selectExpr(
        "date_day",
        "CAST(date_day AS TIMESTAMP) AS date",
        "fear_greed_value",
        f"{index_label('fear_greed_value')} AS sentiment_label",
        f"{bucket_case('fear_greed_value')} AS sentiment_bucket",
        "CAST(date_day AS TIMESTAMP) + INTERVAL 30 HOURS AS ingested_at",
    )


def with_run_date(rows: DataFrame) -> DataFrame:
    """Add the partition columns a Bronze scan would bring (the ingestion date)."""
    return rows.selectExpr(
        "*", "year(ingested_at) AS year", "month(ingested_at) AS month", "day(ingested_at) AS day"
    )


def candle_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeatedly ingested candles: many keys, duplicates with and without ties."""
    opened = "TIMESTAMP '1995-01-01' + make_dt_interval(l_linenumber)"
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        f"{opened} AS open_time",
        f"{opened} + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS close_time",
        "CAST(l_orderkey AS STRING) AS symbol",
        "'1d' AS interval",
        "l_extendedprice AS open",
        "l_extendedprice + l_quantity AS high",
        "l_extendedprice - l_quantity AS low",
        "l_extendedprice + l_tax AS close",
        "l_quantity AS volume",
        "l_extendedprice * l_quantity AS quote_volume",
        "l_partkey AS num_trades",
        "l_quantity / 2 AS taker_buy_base_vol",
        "l_extendedprice / 2 AS taker_buy_quote_vol",
        "l_shipdate AS ingested_at",
    )
    return with_run_date(rows.select(*KLINES.names))


def event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intraday market-chart points: few (coin, day) groups with very many copies."""
    return with_run_date(
        table(spark, sf_dir, "events").selectExpr(
            "date_trunc('hour', ts) AS date",
            "event_type AS coin_id",
            "value AS price_usd",
            "value * user_id AS market_cap_usd",
            "CAST(user_id AS DOUBLE) AS volume_usd",
            "ts AS ingested_at",
        )
    )


def sentiment_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as repeatedly ingested index values; most ingests of a day tie in time."""
    return with_run_date(
        table(spark, sf_dir, "lineitem").selectExpr(
            "l_shipdate AS date",
            f"{DISCOUNT_INDEX} AS fear_greed_value",
            f"{index_label(DISCOUNT_INDEX)} AS sentiment_label",
            f"{bucket_case(DISCOUNT_INDEX)} AS sentiment_bucket",
            "l_shipdate + make_dt_interval(0, l_linenumber) AS ingested_at",
        )
    )


# ---------------------------------------------------------------------------------------------
# Payload documents.  Each one covers a symbol's month (or day, for hourly bars) of bars that were
# aggregated before, so a document is bounded by the calendar, not by the data.
# ---------------------------------------------------------------------------------------------


def _ms(column: str) -> Column:
    return F.unix_millis(F.col(column)).cast("string")


def _quoted(column: str) -> Column:
    return F.concat(F.lit('"'), F.col(column).cast("string"), F.lit('"'))


def _array(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _landing(docs: DataFrame, source: str, dataset: str, interval: Column) -> DataFrame:
    return docs.select(
        F.concat_ws("/", F.lit(dataset), "entity", F.col("page").cast("string")).alias("payload_id"),
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset"),
        "entity",
        interval.alias("interval"),
        "fetched_at",
        "body",
    ).select(*LANDING.names)


def kline_payloads(candles: DataFrame, interval: str, page_unit: str) -> DataFrame:
    """Candle pages in the exchange's 12-position format, numbers partly as text."""
    bar = _array(
        F.array(
            _ms("open_time"), _quoted("open"), _quoted("high"), _quoted("low"), _quoted("close"),
            _quoted("volume"), _ms("close_time"), _quoted("quote_volume"),
            F.col("num_trades").cast("string"), _quoted("taker_buy_base_vol"),
            _quoted("taker_buy_quote_vol"), F.lit('"0"'),
        )
    )
    docs = candles.groupBy(
        F.col("symbol").alias("entity"), F.date_trunc(page_unit, "open_time").alias("page")
    ).agg(
        F.max("ingested_at").alias("fetched_at"),
        F.array_sort(F.collect_list(F.struct("open_time", bar.alias("text")))).alias("bars"),
    )
    return _landing(
        docs.withColumn("body", _array(F.col("bars.text"))),
        "binance", f"klines_{interval}", F.lit(interval),
    )


def chart_payloads(chart: DataFrame, repeat_month: int | None = None) -> DataFrame:
    """Market-chart documents per coin and month.

    Documents of odd months lack the first day's market cap, so those lists do not line up.  Those of
    ``repeat_month`` end with the first day's price again, one unit higher.
    """

    def points(value: str) -> Column:
        return _array(F.array(_ms("date"), F.expr(value).cast("string")))

    month = F.date_trunc("month", "date")
    docs = chart.groupBy(F.col("coin_id").alias("entity"), month.alias("page")).agg(
        F.max("ingested_at").alias("fetched_at"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "date",
                    points("price_usd").alias("price"),
                    points("price_usd + 1").alias("price_again"),
                    points("market_cap_usd").alias("cap"),
                    points("volume_usd").alias("volume"),
                )
            )
        ).alias("points"),
    )
    caps = F.when(
        F.month("page") % 2 == 1, F.filter(F.col("points"), lambda p: F.dayofmonth(p["date"]) != 1)
    ).otherwise(F.col("points"))
    again = F.filter(
        F.col("points"), lambda p: (F.dayofmonth(p["date"]) == 1) & F.lit(repeat_month).eqNullSafe(F.month("page"))
    )
    prices = F.concat(F.col("points.price"), F.transform(again, lambda p: p["price_again"]))
    body = F.concat(
        F.lit('{"prices":'), _array(prices),
        F.lit(',"market_caps":'), _array(F.transform(caps, lambda p: p["cap"])),
        F.lit(',"total_volumes":'), _array(F.col("points.volume")),
        F.lit("}"),
    )
    return _landing(
        docs.withColumn("body", body), "coingecko", "market_chart", F.lit(None).cast("string")
    )


def ohlc_payloads(candles: DataFrame) -> DataFrame:
    """``[[ts, open, high, low, close], ...]`` documents per symbol and month."""
    candle = F.array(
        F.unix_millis("open_time").cast("double"), F.col("open"), F.col("high"), F.col("low"),
        F.col("close"),
    )
    docs = candles.groupBy(
        F.col("symbol").alias("entity"), F.date_trunc("month", "open_time").alias("page")
    ).agg(
        F.max("ingested_at").alias("fetched_at"),
        F.to_json(F.collect_list(candle)).alias("body"),
    )
    return _landing(docs, "coingecko", "ohlc", F.lit(None).cast("string"))


def index_payloads(sentiment: DataFrame) -> DataFrame:
    """Index documents per month, newest entry first, all values as text."""
    entry = F.struct(
        F.unix_seconds("date").cast("string").alias("timestamp"),
        F.col("fear_greed_value").cast("string").alias("value"),
        F.col("sentiment_label").alias("value_classification"),
    )
    docs = sentiment.groupBy(F.date_trunc("month", "date").alias("page")).agg(
        F.max("ingested_at").alias("fetched_at"),
        F.reverse(
            F.array_sort(F.collect_list(F.struct(F.col("date").alias("at"), entry.alias("entry"))))
        ).alias("entries"),
    )
    body = F.to_json(F.struct(F.col("entries.entry").alias("data")))
    return _landing(
        docs.select(F.lit("index").alias("entity"), "page", "fetched_at", body.alias("body")),
        "feargreed", "index", F.lit(None).cast("string"),
    )


def metadata_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as coin documents; the optional keys are missing from some of them."""
    size = F.col("p_size")
    body = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("symbol"),
            F.when(size % 3 != 0, F.format_string("2009-01-%02d", size % 28 + 1)).alias("genesis_date"),
            F.when(size % 2 == 0, F.col("p_type")).alias("hashing_algorithm"),
            F.struct(F.when(size % 5 != 0, size).alias("market_cap_rank")).alias("market_data"),
        )
    )
    docs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("entity"),
        F.lit("profile").alias("page"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"),
        body.alias("body"),
    )
    return _landing(docs, "coingecko", "coin", F.lit(None).cast("string"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream (a pattern, as a stream's plain path must be a directory)."""
    return (
        spark.readStream.schema(SCHEMAS["events"])
        .option("maxFilesPerTrigger", 1000)
        .parquet(f"{sf_dir}/events.parque[t]")
    )


def trade_messages(events: DataFrame) -> DataFrame:
    """Events (batch or stream) as raw trade messages; keys ``T``/``t`` differ only in case."""
    return events.selectExpr(
        """concat('{"e":"trade","s":"', upper(event_type), '","p":"', value,
                  '","q":"', user_id / 8, '","T":', unix_millis(ts), ',"t":', event_id,
                  ',"m":', user_id % 2 = 0, '}') AS value"""
    )


# Faults planted into model tables, by day of the month: the table's day column, columns with their day and
# wrong value (SQL), the day whose rows are repeated, and the day whose rows are left out.
FAULTS: dict[str, tuple[str, dict[str, tuple[int, str]], int | None, int | None]] = {
    "silver_market_chart": (
        "date_day",
        {"coin_id": (2, "NULL"), "price_usd": (3, "NULL"), "volume_usd": (4, "NULL"), "date_day": (1, "NULL")}, 5, None,
    ),
    "silver_klines": (
        "open_time",
        {"symbol": (2, "NULL"), "interval": (3, "NULL"), "close": (6, "NULL"), "volume": (8, "-1D"),
         "quote_volume": (9, "-1D"), "open_time": (1, "NULL")}, 10, None,
    ),
    "silver_sentiment": (
        "date_day",
        {"fear_greed_value": (2, "NULL"), "sentiment_label": (4, "NULL"), "sentiment_bucket": (5, "NULL"),
         "date_day": (1, "NULL")}, 7, None,
    ),
    "daily_enriched": (
        "date_day", {"symbol": (2, "NULL"), "close": (3, "NULL"), "date_day": (1, "NULL")}, 4, 5,
    ),
    "mart_price_analysis": (
        "date_day", {"symbol": (2, "NULL"), "close": (3, "NULL"), "date_day": (1, "NULL")}, 4, 6,
    ),
    "mart_sentiment_correlation": ("date_day", {"symbol": (2, "NULL"), "date_day": (1, "NULL")}, None, None),
    "mart_volume_anomalies": (
        "date_day", {"symbol": (2, "NULL"), "is_volume_anomaly": (3, "NULL"), "date_day": (1, "NULL")}, None, None,
    ),
}


def faulty(name: str, rows: DataFrame) -> DataFrame:
    """A model table with its planted faults."""
    day, wrong, repeated, removed = FAULTS[name]
    if name == "silver_sentiment":  # a value off the scale and a label of its own, too
        rows = rows.withColumns({
            "fear_greed_value": F.expr(f"if(day({day}) = 3, 150, fear_greed_value)"),
            "sentiment_bucket": F.expr(f"if(day({day}) = 6, 'Odd', sentiment_bucket)"),
        })
    if name == "silver_klines":
        rows = rows.withColumn("interval", F.expr(f"if(day({day}) = 4, '9x', interval)"))
        rows = rows.withColumn("volume", F.expr(f"if(day({day}) = 7, NULL, volume)"))
    if removed is not None:
        rows = rows.filter(f"day({day}) != {removed}")
    if repeated is not None:
        rows = rows.unionByName(rows.filter(f"day({day}) = {repeated}"))
    return rows.withColumns({c: F.expr(f"if(day({day}) = {n}, {value}, {c})") for c, (n, value) in wrong.items()})


def faulty_payloads(landing: DataFrame) -> DataFrame:
    """Payload documents of which those of some months cannot be used, each month in its own way."""
    month = "month(to_timestamp(element_at(split(payload_id, '/'), 3)))"
    return landing.withColumns({
        "interval": F.expr(f"if(dataset = 'klines_1d' AND {month} = 5, '7d', interval)"),
        "body": F.expr(f"""CASE
            WHEN dataset = 'klines_1d' AND {month} = 4 THEN left(body, length(body) - 5)
            WHEN dataset = 'klines_1d' AND {month} = 6 THEN regexp_replace(body, ',"[^"]*","0".', ']')
            WHEN dataset = 'market_chart' AND {month} = 2 THEN replace(body, 'market_caps', 'caps')
            WHEN dataset = 'index' AND {month} = 7 THEN regexp_replace(body, '"value":"[0-9]+"', '"value":"n/a"')
            WHEN dataset = 'index' AND {month} = 8 THEN NULL
            ELSE body END"""),
    })
