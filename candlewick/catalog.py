"""The registered queries: one per operator, each over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from candlewick.config import LakeConfig, prepare_session, run_uri, shared_scratch
from candlewick.contracts import dataset_spec
from candlewick.functions.scalar import date_to_millis, sentiment_bucket
from candlewick.operators import grain, quality
from candlewick.operators.enrich import daily_enriched
from candlewick.plans import gold, models, runs, serving, silver
from candlewick.sources import bronze, drift, payloads, tables
from candlewick.streaming import ticks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2001, 12, 31)
SLICE_DAY = date(1998, 3, 9)
CORR = "rolling_30d_sentiment_return_corr"
# Only deviations and what is derived from them depend on the order of summation; all other
# doubles are exact or the result of the same few IEEE operations in any engine.
DIGITS = {"volatility_30d_pct": 4, "volume_std30": 4, "volume_z_score": 4, CORR: 6}


def query(build: Query) -> Query:
    """Register a query under its function's name; its output is comparable across engines."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(prepare_session(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Inexact doubles rounded, timestamps without zone, an undefined correlation as a flag."""

    def show(name: str, kind) -> str:
        value = f"if(isnan({name}), NULL, {name})" if name == CORR else f"`{name}`"
        if name in DIGITS:
            return f"round({value}, {DIGITS[name]}) AS `{name}`"
        if isinstance(kind, TimestampType):
            return f"CAST({value} AS TIMESTAMP_NTZ) AS `{name}`"
        return value

    fields = df.schema.fields
    columns = [show(field.name, field.dataType) for field in fields]
    if any(field.name == CORR for field in fields):
        columns.append(f"coalesce(isnan({CORR}), false) AS corr_is_nan")
    return df.selectExpr(*columns)


# ---------------------------------------------------------------------------------------------
# Model inputs from the benchmark tables (already at Silver grain)
# ---------------------------------------------------------------------------------------------


def _stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day table behind market chart and sentiment, stored as a real run would store Silver.

    Line items are scanned once for both, and the planner knows the stored size: it broadcasts the
    day tables while they are small and shuffles them otherwise.
    """
    return runs.materialise(
        tables.lineitem_days(spark, sf_dir), shared_scratch(spark, "line-item-days")
    )


def _enrich(days: DataFrame, candles: DataFrame) -> DataFrame:
    return daily_enriched(candles, tables.market_chart(days), tables.sentiment_index(days))


def _enriched(spark: SparkSession, sf_dir: str, symbol: str = "o_orderstatus") -> DataFrame:
    return _enrich(_stored_days(spark, sf_dir), tables.order_candles(spark, sf_dir, symbol))


def _price(spark: SparkSession, sf_dir: str, symbol: str = "o_orderstatus") -> DataFrame:
    return gold.price_analysis(_enriched(spark, sf_dir, symbol))


def _price_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price mart for queries that need only its price columns.

    Both joins are left joins on the unique key of an aggregation, so the optimizer drops them
    (and the scan of the line items) when nothing from their side is used.
    """
    days = tables.lineitem_days(spark, sf_dir)
    return gold.price_analysis(_enrich(days, tables.order_candles(spark, sf_dir)))


def _correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sentiment_correlation(_price(spark, sf_dir))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.volume_anomalies(_price(spark, sf_dir))


def _shared_marts(spark: SparkSession, sf_dir: str, purpose: str) -> dict[str, DataFrame]:
    """The three marts; the price mart is stored once because the other two read it."""
    price = runs.materialise(_price(spark, sf_dir), shared_scratch(spark, purpose))
    return {
        "mart_price_analysis": price,
        "mart_sentiment_correlation": gold.sentiment_correlation(price),
        "mart_volume_anomalies": gold.volume_anomalies(price),
    }


# ---------------------------------------------------------------------------------------------
# Marts and their single measures
# ---------------------------------------------------------------------------------------------


@query
def price_analysis(spark, sf_dir):
    return _price(spark, sf_dir)


@query
def price_analysis_many_symbols(spark, sf_dir):
    return _price(spark, sf_dir, "o_custkey")


@query
def sentiment_correlation(spark, sf_dir):
    return _correlation(spark, sf_dir)


@query
def volume_anomalies(spark, sf_dir):
    return _anomalies(spark, sf_dir)


@query
def daily_enriched_table(spark, sf_dir):
    return _enriched(spark, sf_dir)


QUERIES["daily_enriched"] = QUERIES.pop("daily_enriched_table")


@query
def daily_enriched_by_coin(spark, sf_dir):
    """Several coins: each symbol joins the market data of its own coin."""
    coin_of_symbol = spark.createDataFrame(
        [("F", "A"), ("O", "N"), ("P", "R")], "symbol STRING, coin_id STRING"
    )
    return daily_enriched(
        tables.order_candles(spark, sf_dir),
        tables.coin_charts(spark, sf_dir),
        tables.sentiment_index(_stored_days(spark, sf_dir)),
        coin_of_symbol,
    )


@query
def day_over_day_change(spark, sf_dir):
    return _price_measures(spark, sf_dir).select("date_day", "symbol", "price_change_usd")


@query
def daily_return_pct(spark, sf_dir):
    return _price_measures(spark, sf_dir).select("date_day", "symbol", "daily_return_pct")


@query
def moving_average_7(spark, sf_dir):
    return _price_measures(spark, sf_dir).select("date_day", "symbol", "ma7_close")


@query
def moving_average_30(spark, sf_dir):
    return _price_measures(spark, sf_dir).select("date_day", "symbol", "ma30_close")


@query
def volatility_30(spark, sf_dir):
    return _price_measures(spark, sf_dir).select("date_day", "symbol", "volatility_30d_pct")


@query
def sentiment_change(spark, sf_dir):
    return _correlation(spark, sf_dir).select("date_day", "symbol", "sentiment_change")


@query
def next_day_return(spark, sf_dir):
    return _correlation(spark, sf_dir).select("date_day", "symbol", "next_day_return_pct")


@query
def rolling_corr_30(spark, sf_dir):
    return _correlation(spark, sf_dir).select("date_day", "symbol", CORR)


@query
def volume_zscore(spark, sf_dir):
    return gold.volume_anomalies(_price_measures(spark, sf_dir)).select(
        "date_day", "symbol", "volume_z_score", "is_volume_anomaly"
    )


# ---------------------------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------------------------


@query
def dedup_klines(spark, sf_dir):
    return silver.silver_klines(tables.candle_ingests(spark, sf_dir))


@query
def dedup_latest_in_day(spark, sf_dir):
    return silver.silver_market_chart(tables.event_snapshots(spark, sf_dir))


@query
def dedup_sentiment(spark, sf_dir):
    return silver.silver_sentiment(tables.sentiment_ingests(spark, sf_dir))


@query
def union_intervals(spark, sf_dir):
    return silver.union_intervals(
        tables.event_candles(spark, sf_dir, "1d"), tables.event_candles(spark, sf_dir, "1h")
    )


@query
def typed_projection(spark, sf_dir):
    return silver.typed_klines(tables.candle_ingests(spark, sf_dir))


@query
def sentiment_bucket_counts(spark, sf_dir):
    """Index values moved by up to 100 either way, so that some leave the scale."""
    shifted = F.expr(f"{tables.DISCOUNT_INDEX} + (l_linenumber - 2) * 20 AS value")
    return (
        tables.table(spark, sf_dir, "lineitem")
        .groupBy(shifted)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select("value", sentiment_bucket("value").alias("bucket"), "n_rows")
    )


QUERIES["sentiment_bucket"] = QUERIES.pop("sentiment_bucket_counts")


@query
def json_field_access(spark, sf_dir):
    props = F.from_json("props", "k BIGINT")
    return tables.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(props["k"]).alias("sum_k")
    )


@query
def epoch_millis(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return tables.table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("day"), date_to_millis(day).alias("millis")
    )


# ---------------------------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------------------------


def _hourly_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.kline_payloads(tables.event_candles(spark, sf_dir, "1h"), "1h", "day")


@query
def parse_klines_payload(spark, sf_dir):
    return payloads.parse_klines(_hourly_pages(spark, sf_dir))


@query
def kline_page_coverage(spark, sf_dir):
    pages = runs.materialise(
        payloads.kline_pages(_hourly_pages(spark, sf_dir)), shared_scratch(spark, "pages")
    )
    end = F.lit("2024-01-30").cast("timestamp")
    return payloads.page_coverage(pages, end, page_size=24)


@query
def parse_market_chart_payload(spark, sf_dir):
    """Documents with missing timestamps, and (in June) with the first day's price twice."""
    docs = tables.chart_payloads(tables.market_chart(tables.lineitem_days(spark, sf_dir)), 6)
    return payloads.parse_market_chart(docs)


@query
def parse_ohlc_payload(spark, sf_dir):
    return payloads.parse_ohlc(tables.ohlc_payloads(tables.order_candles(spark, sf_dir)))


def _index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.index_payloads(tables.sentiment_index(tables.lineitem_days(spark, sf_dir)))


@query
def parse_index_payload(spark, sf_dir):
    return payloads.oldest_first(payloads.parse_sentiment_index(_index_docs(spark, sf_dir)))


@query
def latest_index_entry(spark, sf_dir):
    return payloads.latest_sentiment(_index_docs(spark, sf_dir))


@query
def parse_metadata_payload(spark, sf_dir):
    return payloads.parse_metadata(tables.metadata_payloads(spark, sf_dir))


@query
def logical_date_slice(spark, sf_dir):
    return bronze.logical_date_slice(
        tables.table(spark, sf_dir, "lineitem"), SLICE_DAY, "l_shipdate"
    )


@query
def kline_run_window(spark, sf_dir):
    return bronze.kline_run_window(tables.event_candles(spark, sf_dir, "1h"), date(2024, 1, 15))


# ---------------------------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------------------------


def _candle_days(spark: SparkSession, sf_dir: str, symbol: str = "o_orderstatus") -> DataFrame:
    return tables.order_candles(spark, sf_dir, symbol).select(
        "symbol", F.to_date("open_time").alias("date_day")
    )


@query
def gap_detection(spark, sf_dir):
    return grain.missing_days(_candle_days(spark, sf_dir))


@query
def series_coverage(spark, sf_dir):
    return grain.series_coverage(_candle_days(spark, sf_dir, "o_custkey"))


@query
def grain_check(spark, sf_dir):
    return grain.duplicate_keys(
        tables.candle_ingests(spark, sf_dir), ["symbol", "interval", "open_time"]
    )


@query
def relationships_check(spark, sf_dir):
    return grain.orphan_values(
        _candle_days(spark, sf_dir), "date_day", tables.lineitem_days(spark, sf_dir)
    )


@query
def null_counts(spark, sf_dir):
    """Null counts of a dataset's non-null columns; cheap line items have no close or open."""
    candles = tables.candle_ingests(spark, sf_dir).selectExpr(
        "* EXCEPT (open, close)",
        "if(volume < 5, NULL, close) AS close",
        "if(volume < 3, double('NaN'), open) AS open",
    )
    return quality.null_counts(candles, dataset_spec("klines_1d").non_null)


@query
def freshness_check(spark, sf_dir):
    return quality.stale_days(_price_measures(spark, sf_dir), AS_OF)


def _shifted_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = tables.sentiment_ingests(spark, sf_dir).withColumn(
        "fear_greed_value", F.expr("fear_greed_value + (hour(ingested_at) - 2) * 20")
    )
    return moved.withColumn("sentiment_bucket", sentiment_bucket("fear_greed_value"))


@query
def range_check(spark, sf_dir):
    return quality.out_of_range_sentiment(_shifted_sentiment(spark, sf_dir)).select(
        F.to_date("date").alias("date_day"), "fear_greed_value", "sentiment_bucket", "ingested_at"
    )


@query
def positive_check(spark, sf_dir):
    candles = tables.candle_ingests(spark, sf_dir).withColumns(
        {"close": F.col("close") - 20000, "volume": F.col("volume") - 5}
    )
    return quality.implausible_candles(candles).select(
        "symbol", "interval", "open_time", "close", "quote_volume", "volume", "ingested_at"
    )


def _suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = [
        (
            tables.order_candles(spark, sf_dir), quality.klines_suite(symbols=("F", "O")),
            "klines_1d",
        ),
        (
            tables.market_chart(tables.lineitem_days(spark, sf_dir)),
            quality.market_chart_suite(coins=(tables.BASKET,)), "market_chart",
        ),
        (_shifted_sentiment(spark, sf_dir), quality.sentiment_suite(), "index"),
    ]
    # these rows come from no stored run, so they have no path
    first, *others = [quality.evaluate(*parts).drop("path") for parts in checked]
    for other in others:
        first = first.unionByName(other)
    return first


@query
def suite_results(spark, sf_dir):
    return _suite_results(spark, sf_dir)


@query
def gate_outcomes(spark, sf_dir):
    return quality.outcomes(_suite_results(spark, sf_dir))


@query
def gate_failures(spark, sf_dir):
    """What the gate keeps of a run whose hourly candles alone are faulty."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "gate"))
    run_ts = datetime(2024, 3, 9, 8, 30)
    hourly = tables.order_candles(spark, sf_dir, interval="1h").withColumns({
        "close": F.col("close") - 100000,
        "high": F.expr("if(num_trades > 1, low - 1, high)"),
        "volume": F.expr("if(volume > 100, NULL, volume)"),
    })
    faulty = {"klines_1d": tables.order_candles(spark, sf_dir), "klines_1h": hourly}
    written = {
        name: bronze.write_bronze(rows, cfg, dataset_spec(name), run_ts).path
        for name, rows in faulty.items()
    }
    suites = {
        name: quality.klines_suite(("F", "O", "P"), (name.removeprefix("klines_"),))
        for name in written
    }
    uri = f"{cfg.root}/results"
    try:
        quality.gate(spark, written, suites, uri, run_ts)
    except quality.QualityGateError:
        pass  # the results are kept all the same, and they are what this query shows
    kept = spark.read.parquet(uri).drop("run", "run_ts")
    return kept.withColumn("path", F.regexp_extract("path", "bronze/.*", 0))


def _model_tables(spark: SparkSession, sf_dir: str, purpose: str) -> dict[str, DataFrame]:
    """Silver, enriched and mart tables, stored, as the output tests read each of them often."""
    scratch = shared_scratch(spark, purpose)

    def stored(**frames: DataFrame) -> list[DataFrame]:
        return list(
            runs.materialise_all({f"{scratch}/{k}": rows for k, rows in frames.items()}).values()
        )

    days = _stored_days(spark, sf_dir)
    candles = tables.with_run_date(tables.order_candles(spark, sf_dir))
    hourly = tables.with_run_date(tables.event_candles(spark, sf_dir, "1h"))
    klines, chart, mood = stored(
        klines=silver.silver_klines(candles, hourly),
        chart=silver.silver_market_chart(tables.with_run_date(tables.market_chart(days))),
        mood=silver.silver_sentiment(tables.with_run_date(tables.sentiment_index(days))),
    )
    [enriched] = stored(enriched=daily_enriched(klines, chart, mood))
    [price] = stored(price=gold.price_analysis(enriched))
    correlation, anomalies = stored(
        correlation=gold.sentiment_correlation(price), anomalies=gold.volume_anomalies(price)
    )
    return {
        "silver_klines": klines,
        "silver_market_chart": chart,
        "silver_sentiment": mood,
        "daily_enriched": enriched,
        "mart_price_analysis": price,
        "mart_sentiment_correlation": correlation,
        "mart_volume_anomalies": anomalies,
    }


@query
def output_test_results(spark, sf_dir):
    """All 38 output tests over sound tables."""
    return quality.output_tests(_model_tables(spark, sf_dir, "output-tests"), AS_OF)


@query
def output_test_failures(spark, sf_dir):
    """All 38 output tests over tables in which each of them finds something."""
    sound = _model_tables(spark, sf_dir, "faulty-tables")
    return quality.output_tests({name: tables.faulty(name, rows) for name, rows in sound.items()}, AS_OF)


@query
def suite_lookup(spark, sf_dir):
    """The input suites by the name of their source, over the tables that they are made for."""
    checked = {
        "binance": (tables.candle_ingests(spark, sf_dir), {"symbols": ("1", "2", "3")}),
        "coingecko": (tables.coin_charts(spark, sf_dir), {"coins": ("A", "N")}),
        "feargreed": (_shifted_sentiment(spark, sf_dir), {}),
    }
    # charts by day have the day alone
    checked["coingecko"] = (checked["coingecko"][0].withColumn("date", F.col("date_day")), checked["coingecko"][1])
    first, *others = [
        quality.evaluate(rows, quality.suite_for(source, **parameters)).drop("dataset", "path")
        for source, (rows, parameters) in checked.items()
    ]
    for other in others:
        first = first.unionByName(other)
    return first


# ---------------------------------------------------------------------------------------------
# Dashboard
# ---------------------------------------------------------------------------------------------


@query
def kpi_latest(spark, sf_dir):
    return serving.kpi_latest(_price(spark, sf_dir))


@query
def kpi_by_symbol(spark, sf_dir):
    return serving.kpi_by_symbol(_price(spark, sf_dir, "o_custkey"))


@query
def close_vs_ma_series(spark, sf_dir):
    return serving.close_vs_averages(_price_measures(spark, sf_dir))


@query
def sentiment_vs_return_series(spark, sf_dir):
    return serving.sentiment_vs_return(_price(spark, sf_dir))


@query
def volume_anomaly_series(spark, sf_dir):
    return serving.volume_bars(gold.volume_anomalies(_price_measures(spark, sf_dir)))


@query
def recent_anomalies(spark, sf_dir):
    return serving.recent_anomalies(_anomalies(spark, sf_dir))


@query
def rolling_corr_series(spark, sf_dir):
    return serving.correlation_series(_correlation(spark, sf_dir))


@query
def sentiment_distribution(spark, sf_dir):
    return serving.sentiment_distribution(_price(spark, sf_dir))


@query
def mart_by_day(spark, sf_dir):
    return serving.by_day(_price(spark, sf_dir))


@query
def mart_row_counts(spark, sf_dir):
    return serving.row_counts(_shared_marts(spark, sf_dir, "row-counts"))


# ---------------------------------------------------------------------------------------------
# Storage, runs and streams (these write below the shared checkpoint folder)
# ---------------------------------------------------------------------------------------------


@query
def bronze_roundtrip(spark, sf_dir):
    """Three runs, one of them written twice: it replaces itself, the others stay."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "bronze"))
    spec = dataset_spec("klines_1d")
    candles = tables.order_candles(spark, sf_dir)
    for run_ts in (
        datetime(2024, 3, 9, 14, 30, 5),
        datetime(2024, 3, 9, 14, 30, 5),
        datetime(2024, 3, 9, 20, 0, 0),
        datetime(2024, 12, 31, 0, 0, 0),
    ):
        bronze.write_bronze(candles, cfg, spec, run_ts)
    return bronze.read_bronze(spark, cfg, spec)


@query
def schema_drift_read(spark, sf_dir):
    """Runs whose files store the index differently: extra column, plain date, other names."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "drift"))
    spec = dataset_spec("index")
    mood = tables.sentiment_index(_stored_days(spark, sf_dir)).select(*spec.schema.names)

    def store(rows: DataFrame, day: int) -> None:
        rows.write.mode("overwrite").parquet(
            run_uri(cfg, spec.source, spec.dataset, datetime(2024, 3, day))
        )

    store(mood.withColumn("note", F.lit("extra")), 9)
    store(mood.withColumn("date", F.to_date("date")), 10)
    store(mood.withColumnRenamed("fear_greed_value", "value").drop("sentiment_bucket"), 11)
    return drift.read_drifted(spark, cfg, spec)


@query
def serving_publish(spark, sf_dir):
    """Publish the marts twice to a Parquet serving store, then count what it holds."""
    marts = _shared_marts(spark, sf_dir, "marts")
    uri = shared_scratch(spark, "serving")
    sink = serving.parquet_sink(spark, uri)
    serving.publish(marts, sink)
    serving.publish(marts, sink)
    return serving.row_counts({name: spark.read.parquet(f"{uri}/{name}") for name in marts})


def _landing_table(spark: SparkSession, sf_dir: str, uri: str, faulty: bool = False) -> DataFrame:
    """All datasets' payload documents, stored once, partitioned by dataset and date of fetching."""
    days = _stored_days(spark, sf_dir)
    landing = (
        tables.chart_payloads(tables.market_chart(days))
        .unionByName(
            tables.kline_payloads(tables.order_candles(spark, sf_dir), "1d", "month")
        )
        .unionByName(
            tables.kline_payloads(
                tables.order_candles(spark, sf_dir, interval="1h"), "1h", "month"
            )
        )
        .unionByName(tables.index_payloads(tables.sentiment_index(days)))
    )
    if faulty:
        landing = tables.faulty_payloads(landing)
    dated = landing.withColumn(runs.FETCH_DATE, F.to_date("fetched_at"))
    keys = ["dataset", runs.FETCH_DATE]
    dated.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(uri)
    return spark.read.schema(dated.schema).parquet(uri)


@query
def quarantined_documents(spark, sf_dir):
    """Faulty documents of a backfill by dataset and reason, and what the sound ones gave."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "quarantine"))
    landing = _landing_table(spark, sf_dir, f"{cfg.root}/landing", faulty=True)
    # all of a dataset's documents may be faulty
    report = runs.run_backfill(spark, cfg, landing, datetime(2002, 1, 2, 3, 4, 5), max_rejected=landing.count())
    kept = spark.read.parquet(f"{cfg.root}/quality/quarantine")
    reasons = kept.groupBy("dataset", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return reasons.unionByName(
        report.summary.select("dataset", F.lit("stored").alias("reason"), F.col("row_count").alias("n_rows"))
    )


@query
def run_summary(spark, sf_dir):
    cfg = LakeConfig(data_dir=shared_scratch(spark, "backfill"))
    landing = _landing_table(spark, sf_dir, f"{cfg.root}/landing")
    report = runs.run_backfill(spark, cfg, landing, datetime(2002, 1, 2, 3, 4, 5))
    return report.summary.select(
        "source", "dataset", "status", "row_count", "min_time", "max_time",
        F.regexp_extract("path", "bronze/.*", 0).alias("path"),
        F.size("errors").alias("n_errors"),
    )


@query
def daily_run(spark, sf_dir):
    """Backfill all history, then run one day again from the documents fetched when its month was over: gate,
    merge, test, publish."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "daily-run"))
    landing = _landing_table(spark, sf_dir, f"{cfg.root}/landing")
    runs.run_backfill(spark, cfg, landing, datetime(2002, 1, 2, 3, 4, 5))
    symbols = ("F", "O", "P")
    suites = {
        "market_chart": quality.market_chart_suite(coins=(tables.BASKET,)),
        "klines_1d": quality.klines_suite(symbols, ("1d",)),
        "klines_1h": quality.klines_suite(symbols, ("1h",)),
        "index": quality.sentiment_suite(),
    }
    result = runs.run_daily(
        spark, cfg, landing, datetime(1998, 3, 9, 8, 30), suites,
        sink=serving.parquet_sink(spark, f"{cfg.root}/serving"),
        fetched=(datetime(1998, 3, 10), datetime(1998, 4, 2)),
    )
    return result["mart_price_analysis"]


@query
def tick_parse(spark, sf_dir):
    return ticks.parse_ticks(tables.trade_messages(tables.table(spark, sf_dir, "events")))


@query
def tick_parse_stream(spark, sf_dir):
    scratch = shared_scratch(spark, "tick-parse")
    parsed = ticks.parse_ticks(tables.trade_messages(tables.event_stream(spark, sf_dir)))
    (
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{scratch}/ticks")
        .awaitTermination()
    )
    return spark.read.schema(parsed.schema).parquet(f"{scratch}/ticks")


@query
def tick_publish_stream(spark, sf_dir):
    scratch = shared_scratch(spark, "tick-publish")
    ticks.publish_ticks(
        tables.trade_messages(tables.event_stream(spark, sf_dir)),
        "parquet", f"{scratch}/checkpoint", {"path": f"{scratch}/topic"}, available_now=True,
    ).awaitTermination()
    record = F.from_json(
        "value",
        "symbol STRING, price DOUBLE, quantity DOUBLE, event_time STRING, trade_id BIGINT, "
        "is_buyer_maker BOOLEAN",
    )
    return spark.read.schema("key STRING, value STRING").parquet(f"{scratch}/topic").select(
        "key", F.inline(F.array(record))
    )


# Staged ticks: those before the cut first, the others with repeated ones next, held-back old ones last.
CUT, HELD_BACK = "2024-01-20", "event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-10'"
BAR_WIDTH, BAR_DELAY = "1 hour", "2 hours"


def _run_staged(spark, sf_dir, scratch, start) -> None:
    """Land the events in three steps; after each, run the streams from their checkpoints."""
    events = tables.table(spark, sf_dir, "events")
    early, late = F.expr(f"ts < TIMESTAMP '{CUT}'"), F.expr(HELD_BACK)
    steps = [
        events.filter(early & ~late),
        events.filter(~early).unionByName(events.filter(early & ~late & F.expr("event_id % 7 = 0"))),
        events.filter(late),
    ]
    for step in steps:
        step.write.mode("append").parquet(f"{scratch}/events")
        landed = spark.readStream.schema(events.schema).parquet(f"{scratch}/events")
        for running in start(ticks.parse_ticks(tables.trade_messages(landed))):
            running.awaitTermination()


@query
def unique_ticks_stream(spark, sf_dir):
    """Repeated and late ticks leave the stream."""
    scratch = shared_scratch(spark, "unique-ticks")

    def start(parsed):
        writer = ticks.unique_ticks(ticks.complete_ticks(parsed), BAR_DELAY).writeStream.format("parquet")
        options = {"checkpointLocation": f"{scratch}/checkpoint"}
        return [writer.options(**options).trigger(availableNow=True).start(f"{scratch}/ticks")]

    _run_staged(spark, sf_dir, scratch, start)
    return spark.read.parquet(f"{scratch}/ticks")


def _bars(spark, sf_dir, purpose):
    scratch = shared_scratch(spark, purpose)

    def start(parsed):
        once = ticks.unique_ticks(ticks.complete_ticks(parsed), BAR_DELAY)
        return [
            ticks.write_bars(once, f"{scratch}/bars", f"{scratch}/checkpoint-bars", BAR_WIDTH, None, True),
            ticks.write_seen(parsed, f"{scratch}/seen", f"{scratch}/checkpoint-seen", BAR_WIDTH, True),
        ]

    _run_staged(spark, sf_dir, scratch, start)
    return spark.read.parquet(f"{scratch}/bars"), spark.read.schema(ticks.SEEN).parquet(f"{scratch}/seen")


@query
def tick_bars_stream(spark, sf_dir):
    """Hourly bars of unique ticks, over restarts and with late ticks left out."""
    return _bars(spark, sf_dir, "tick-bars")[0].drop("quote_volume")  # its sum depends on the order


@query
def late_ticks_stream(spark, sf_dir):
    """Ticks per window that are in no bar: late ones and repeated ones."""
    bars, seen = _bars(spark, sf_dir, "late-ticks")
    return ticks.late_ticks(seen, bars, BAR_DELAY)


# Corrections of single days, taken in by later runs.
FIXED_DAYS = ("1995-03-15", "1996-08-02")
FIXED_MOOD = ("1994-05-05", "1994-05-10")
FIXED_CHART = "1993-02-01"
NEW_FROM = "1997-07-01"


@query
def incremental_marts(spark, sf_dir):
    """Marts after four runs: old days, new days with late corrections, more corrections and a stale copy."""
    cfg = LakeConfig(data_dir=shared_scratch(spark, "incremental"))
    days = _stored_days(spark, sf_dir)
    whole = {
        "klines_1d": tables.order_candles(spark, sf_dir),
        "klines_1h": tables.order_candles(spark, sf_dir, interval="1h"),
        "market_chart": tables.market_chart(days),
        "index": tables.sentiment_index(days),
    }
    # stored once, as every run takes some of its rows
    frames = runs.materialise_all({
        f"{cfg.root}/landing/{name}": rows.select(*dataset_spec(name).schema.names) for name, rows in whole.items()
    })
    frames = {uri.rpartition("/")[2]: rows for uri, rows in frames.items()}
    candles, mood, chart = frames["klines_1d"], frames["index"], frames["market_chart"]
    fixed = candles.filter(F.to_date("open_time").cast("string").isin(*FIXED_DAYS))

    def corrected(rows: DataFrame, run_ts: datetime, **columns: str) -> DataFrame:
        return rows.withColumns({name: F.expr(text) for name, text in columns.items()}).withColumn(
            "ingested_at", F.lit(run_ts.isoformat()).cast("timestamp")
        )

    def before(name: str) -> DataFrame:
        return frames[name].filter(F.col(dataset_spec(name).time_col) < F.lit(NEW_FROM).cast("timestamp"))

    def since(name: str) -> DataFrame:
        return frames[name].filter(F.col(dataset_spec(name).time_col) >= F.lit(NEW_FROM).cast("timestamp"))

    stamps = [datetime(2002, 1, day) for day in (2, 3, 4, 5)]
    moody = mood.filter(F.to_date("date").cast("string").between(*FIXED_MOOD))
    steps = [
        {name: before(name) for name in frames},
        {name: since(name) for name in frames},
        {
            "klines_1d": corrected(fixed, stamps[2], close="close + 11", volume="volume * 3"),
            "index": corrected(moody, stamps[2], fear_greed_value="7L"),
        },
        {
            "klines_1d": corrected(fixed, datetime(1990, 1, 1), close="1D"),  # stale: an older ingest
            "market_chart": corrected(
                chart.filter(F.to_date("date").cast("string") == FIXED_CHART), stamps[3], market_cap_usd="1D"
            ),
        },
    ]
    for run_ts, step in zip(stamps, steps):
        receipts = {name: bronze.write_bronze(rows, cfg, dataset_spec(name), run_ts) for name, rows in step.items()}
        runs.log_ingest(spark, cfg, receipts, run_ts)
        marts = models.refresh(spark, cfg, run_ts)
    price, mood_corr, anomalies = (
        marts[name] for name in ("mart_price_analysis", "mart_sentiment_correlation", "mart_volume_anomalies")
    )
    keys = ["date_day", "symbol"]
    return price.join(mood_corr.select(*keys, "sentiment_change", "next_day_return_pct", CORR), keys, "left").join(
        anomalies.select(*keys, "volume_ma30", "volume_z_score", "is_volume_anomaly"), keys, "left"
    )
