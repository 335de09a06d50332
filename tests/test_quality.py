from datetime import date, datetime

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from candlewick.contracts import dataset_spec
from candlewick.operators import quality as q

RUN = datetime(2024, 3, 9, 8, 30)


def chart(spark, **changes):
    rows = [
        dict(date=datetime(2024, 1, 1), coin_id="bitcoin", price_usd=42_000.0, market_cap_usd=8.0e11,
             volume_usd=2.0e10, ingested_at=RUN),
        dict(date=datetime(2024, 1, 2), coin_id="bitcoin", price_usd=43_500.0, market_cap_usd=8.2e11,
             volume_usd=2.5e10, ingested_at=RUN),
    ]
    rows[0].update(changes)
    return spark.createDataFrame(rows, dataset_spec("market_chart").schema)


def klines(spark, **changes):
    rows = [
        dict(symbol="BTCUSDT", interval="1d", open=42_000.0, high=43_000.0, low=41_500.0,
             close=42_800.0, volume=1200.0),
        dict(symbol="BTCUSDT", interval="1d", open=43_000.0, high=44_000.0, low=42_800.0,
             close=43_900.0, volume=1500.0),
    ]
    rows[0].update(changes)
    schema = "symbol string, interval string, open double, high double, low double, close double, volume double"
    return spark.createDataFrame(rows, schema)


def index(spark, **changes):
    rows = [
        dict(date=datetime(2024, 1, 1), fear_greed_value=55, sentiment_label="Greed", sentiment_bucket="Greed"),
        dict(date=datetime(2024, 1, 2), fear_greed_value=72, sentiment_label="Greed", sentiment_bucket="Greed"),
    ]
    rows[0].update(changes)
    schema = "date timestamp, fear_greed_value bigint, sentiment_label string, sentiment_bucket string"
    return spark.createDataFrame(rows, schema)


FRAMES = {"coingecko": chart, "binance": klines, "feargreed": index}


def failed(results):
    return {(r["rule"], r["column"]) for r in results.filter("NOT success").collect()}


def test_number_of_input_rules(spark):
    counts = {s: q.evaluate(FRAMES[s](spark), q.suite_for(s)).count() for s in FRAMES}
    assert counts == {"coingecko": 9, "binance": 12, "feargreed": 6}


@pytest.mark.parametrize("source", sorted(FRAMES))
def test_clean_rows_pass(spark, source):
    results = q.evaluate(FRAMES[source](spark), q.suite_for(source))
    assert failed(results) == set()
    assert {r["n_rows"] for r in results.collect()} == {2}


@pytest.mark.parametrize(
    "source,change,rule",
    [
        ("coingecko", dict(price_usd=-1.0), ("positive", "price_usd")),
        ("coingecko", dict(price_usd=0.0), ("positive", "price_usd")),
        ("coingecko", dict(price_usd=None), ("not_null", "price_usd")),
        ("coingecko", dict(price_usd=float("nan")), ("not_null", "price_usd")),
        ("coingecko", dict(coin_id="dogecoin"), ("in_set", "coin_id")),
        ("coingecko", dict(coin_id=None), ("not_null", "coin_id")),
        ("coingecko", dict(volume_usd=-0.5), ("between", "volume_usd")),
        ("coingecko", dict(market_cap_usd=-1.0), ("between", "market_cap_usd")),
        ("coingecko", dict(date=None), ("not_null", "date")),
        ("binance", dict(high=40_000.0), ("at_least", "high,low")),
        ("binance", dict(high=None), ("at_least", "high,low")),
        ("binance", dict(symbol="ETHUSDT"), ("in_set", "symbol")),
        ("binance", dict(interval="1h"), ("in_set", "interval")),
        ("binance", dict(open=0.0), ("positive", "open")),
        ("binance", dict(close=None), ("not_null", "close")),
        ("binance", dict(volume=-1.0), ("between", "volume")),
        ("feargreed", dict(fear_greed_value=150), ("between", "fear_greed_value")),
        ("feargreed", dict(fear_greed_value=-1), ("between", "fear_greed_value")),
        ("feargreed", dict(sentiment_bucket="Euphoria"), ("in_set", "sentiment_bucket")),
        ("feargreed", dict(sentiment_label=None), ("not_null", "sentiment_label")),
    ],
)
def test_one_broken_rule(spark, source, change, rule):
    results = q.evaluate(FRAMES[source](spark, **change), q.suite_for(source))
    assert failed(results) == {rule}
    with pytest.raises(q.QualityGateError, match=source):
        q.enforce(results)


@pytest.mark.parametrize(
    "source,change",
    [
        ("feargreed", dict(sentiment_bucket=None)),
        ("feargreed", dict(sentiment_label="Euphoria")),
        ("feargreed", dict(fear_greed_value=0)),
        ("feargreed", dict(fear_greed_value=100)),
        ("coingecko", dict(market_cap_usd=None)),
        ("coingecko", dict(volume_usd=0.0)),
        ("binance", dict(high=None, low=None)),
    ],
)
def test_values_that_pass(spark, source, change):
    assert failed(q.evaluate(FRAMES[source](spark, **change), q.suite_for(source))) == set()


def test_empty_rows_fail_only_the_row_count(spark):
    results = q.evaluate(chart(spark).limit(0), q.market_chart_suite())
    assert failed(results) == {("row_count", "*")}


def test_unknown_source():
    with pytest.raises(KeyError, match="\\['binance', 'coingecko', 'feargreed'\\]"):
        q.suite_for("other")


def test_a_suite_is_one_aggregation(spark, tmp_path):
    klines(spark).write.parquet(str(tmp_path / "k"))
    plan = plan_of(q.evaluate(spark.read.parquet(str(tmp_path / "k")), q.klines_suite()))
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1


def test_warnings_do_not_fail_a_source(spark):
    suite = q.Suite("s", (q.in_set("sentiment_label", ["Fear"], severity=q.WARN),))
    results = q.evaluate(index(spark), suite)
    [row] = q.outcomes(results).collect()
    assert (row["success"], row["n_failed"], row["n_warned"]) == (True, 0, 1)
    q.enforce(results)


def test_gate_stops_on_missing_paths_before_reading(spark):
    suites = {"index": q.sentiment_suite(), "market_chart": q.market_chart_suite()}
    with pytest.raises(q.QualityGateError) as stop:
        q.gate(spark, {"index": "/nowhere", "market_chart": ""}, suites)
    assert stop.value.sources == ["market_chart"]


def test_gate_keeps_results_of_a_failed_run(spark, tmp_path):
    chart(spark, price_usd=-1.0).write.parquet(str(tmp_path / "c"))
    index(spark).write.parquet(str(tmp_path / "i"))
    written = {"market_chart": str(tmp_path / "c"), "index": str(tmp_path / "i")}
    suites = {"market_chart": q.market_chart_suite(), "index": q.sentiment_suite()}
    uri = str(tmp_path / "results")
    with pytest.raises(q.QualityGateError) as stop:
        q.gate(spark, written, suites, uri, RUN)
    assert stop.value.sources == ["coingecko"] and "coingecko/market_chart" in str(stop.value)
    kept = spark.read.parquet(f"{uri}/run=20240309_083000")
    named = {(r["dataset"], r["path"]) for r in kept.select("dataset", "path").distinct().collect()}
    assert named == set(written.items())
    assert kept.count() == 15 and {r["run_ts"] for r in kept.select("run_ts").distinct().collect()} == {RUN}


def test_profile(spark):
    spec = dataset_spec("market_chart")
    good = q.profile(chart(spark), spec)
    assert (good.status, good.row_count, good.min_time) == ("PASS", 2, datetime(2024, 1, 1))
    [empty] = q.profile(chart(spark).limit(0).drop("volume_usd"), spec).errors
    assert empty == q.Failure("coingecko", "market_chart", "row_count", "*", 1)
    bad = chart(spark, price_usd=None).drop("volume_usd").withColumn("date", F.col("date").cast("string"))
    found = q.profile(bad, spec)
    assert [(e.rule, e.column, e.n_bad) for e in found.errors] == [
        ("required", "volume_usd", 2), ("not_null", "price_usd", 1), ("timestamp", "date", 2),
    ]
    assert (found.status, found.row_count, found.min_time) == ("FAIL", 2, None)


def test_profile_is_one_aggregation_without_the_time_column(spark):
    found = q.profile(chart(spark).drop("date"), dataset_spec("market_chart"))
    assert [(e.rule, e.column, e.n_bad) for e in found.errors] == [("required", "date", 2)]


def test_freshness(spark):
    rows = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 5),)], "date_day date")
    assert q.stale_days(rows, date(2024, 1, 8)).isEmpty()
    [stale] = q.stale_days(rows, date(2024, 1, 9)).collect()
    assert (stale["latest_day"], stale["today"]) == (date(2024, 1, 5), date(2024, 1, 9))


def test_row_level_output_checks(spark):
    assert q.out_of_range_sentiment(index(spark, fear_greed_value=101)).count() == 1
    candles = klines(spark, close=0.0).withColumn("quote_volume", F.lit(1.0))
    assert q.implausible_candles(candles).count() == 1
