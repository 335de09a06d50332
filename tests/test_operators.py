import random
from datetime import date, datetime, timedelta

from helpers import plan_of
from pyspark.sql import functions as F

from candlewick.operators import grain
from candlewick.operators.dedup import latest_by
from candlewick.operators.enrich import daily_enriched
from candlewick.plans import silver


def test_latest_by_matches_brute_force_on_ties_and_nulls(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice("abc"), rng.choice([None, 1, 2, 3]), rng.choice([None, 1.0, 2.0]), rng.randint(0, 3))
        for _ in range(400)
    ]
    low = float("-inf")

    def rank(row):
        return tuple(low if v is None else v for v in (row[1], row[2], row[3]))

    expected = {}
    for row in rows:
        if row[0] not in expected or rank(row) > rank(expected[row[0]]):
            expected[row[0]] = row
    df = spark.createDataFrame(rows, "k string, at int, a double, b int")
    for partitions in (1, 7):
        found = latest_by(df.repartition(partitions), ["k"], ["at"]).collect()
        assert {r["k"]: tuple(r) for r in found} == expected


def test_latest_by_limits_ranks_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("at"), F.hash("id").alias("payload"),
    )
    result = latest_by(df, ["k"], ["at"])
    plan = plan_of(result)
    before_shuffle = plan[plan.index("Exchange"):]
    assert plan.count("WindowGroupLimit") == 2 and "WindowGroupLimit" in before_shuffle
    expected = df.groupBy("k").agg(F.max("at").alias("at"))
    assert result.select("k", "at").exceptAll(expected).isEmpty()
    assert result.count() == expected.count()


def klines(spark, *rows):
    """(symbol, interval, open_time, close, ingested_at)"""
    schema = "symbol string, interval string, open_time timestamp, close double, ingested_at timestamp"
    df = spark.createDataFrame(list(rows), schema)
    other = "open high low volume quote_volume taker_buy_base_vol taker_buy_quote_vol".split()
    return df.select(
        "*", F.col("open_time").alias("close_time"), F.lit(1).cast("bigint").alias("num_trades"),
        *(F.lit(1.0).alias(name) for name in other),
        F.lit("2024").alias("year"), F.lit("03").alias("month"), F.lit("09").alias("day"),
    )


def test_silver_klines_union_type_filter_dedup(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    daily = klines(
        spark, ("S", "1d", t0, 1.0, t0), ("S", "1d", t0, 2.0, t1), (None, "1d", t0, 9.0, t1),
        ("T", "1d", t0, 3.0, t0),
    )
    hourly = klines(spark, ("S", "1h", t0, 4.0, t0)).select(*reversed(daily.columns))
    result = silver.silver_klines(daily, hourly)
    assert {(r["symbol"], r["interval"], r["close"]) for r in result.collect()} == {
        ("S", "1d", 2.0), ("T", "1d", 3.0), ("S", "1h", 4.0),
    }
    types = dict(result.dtypes)
    assert types["num_trades"] == "int" and types["partition_month"] == "int"
    assert result.columns[-3:] == ["partition_year", "partition_month", "partition_day"]
    assert silver.union_intervals(daily, hourly).count() == 5


def test_silver_market_chart_keeps_the_last_point_of_the_day(spark):
    rows = [
        (datetime(2024, 1, 1, 3), "bitcoin", 1.0, datetime(2024, 1, 9)),
        (datetime(2024, 1, 1, 22), "bitcoin", 2.0, datetime(2024, 1, 2)),
        (datetime(2024, 1, 1, 22), "bitcoin", 3.0, datetime(2024, 1, 3)),
        (datetime(2024, 1, 1, 23), "bitcoin", None, datetime(2024, 1, 9)),
        (datetime(2024, 1, 2, 0), "bitcoin", 4.0, datetime(2024, 1, 2)),
        (datetime(2024, 1, 1, 5), "other", 5.0, datetime(2024, 1, 2)),
    ]
    df = spark.createDataFrame(
        rows, "date timestamp, coin_id string, price_usd double, ingested_at timestamp"
    ).select(
        "*", F.lit(1.0).alias("market_cap_usd"), F.lit(1.0).alias("volume_usd"),
        F.lit(2024).alias("year"), F.lit(3).alias("month"), F.lit(9).alias("day"),
    )
    result = silver.silver_market_chart(df)
    assert result.columns == [
        "date_day", "coin_id", "price_usd", "market_cap_usd", "volume_usd", "ingested_at",
        "partition_year", "partition_month", "partition_day",
    ]
    assert {(r["date_day"], r["coin_id"], r["price_usd"]) for r in result.collect()} == {
        (date(2024, 1, 1), "bitcoin", 3.0), (date(2024, 1, 2), "bitcoin", 4.0),
        (date(2024, 1, 1), "other", 5.0),
    }


def test_silver_sentiment_latest_ingest_wins(spark):
    day = datetime(2024, 1, 1)
    rows = [(day, 10, day), (day, 20, day + timedelta(hours=1)), (day, None, day + timedelta(days=9))]
    df = spark.createDataFrame(rows, "date timestamp, fear_greed_value bigint, ingested_at timestamp")
    df = df.select(
        "*", F.lit("Fear").alias("sentiment_label"), F.lit("Fear").alias("sentiment_bucket"),
        F.lit(2024).alias("year"), F.lit(3).alias("month"), F.lit(9).alias("day"),
    )
    [row] = silver.silver_sentiment(df).collect()
    assert row["fear_greed_value"] == 20 and row["date_day"] == date(2024, 1, 1)


def chart(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "date_day date, coin_id string, price_usd double, market_cap_usd double, "
        "volume_usd double, ingested_at timestamp",
    )


def mood(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "date_day date, fear_greed_value int, sentiment_label string, sentiment_bucket string, "
        "ingested_at timestamp",
    )


def test_enrichment_keeps_every_daily_candle_and_the_latest_ingest(spark):
    t = [datetime(2024, 1, d) for d in range(1, 5)]
    candles = klines(
        spark, ("S", "1d", t[0], 1.0, t[1]), ("S", "1d", t[1], 2.0, t[1]), ("S", "1h", t[0], 9.0, t[3]),
        ("T", "1d", t[0], 3.0, t[3]),
    )
    result = daily_enriched(
        candles,
        chart(spark, (t[0].date(), "bitcoin", 5.0, 6.0, 7.0, t[2])),
        mood(spark, (t[1].date(), 50, "Neutral", "Neutral", t[2])),
    )
    rows = {(r["symbol"], r["date_day"].day): r for r in result.collect()}
    assert set(rows) == {("S", 1), ("S", 2), ("T", 1)}
    assert rows["S", 1]["coingecko_price_usd"] == 5.0 and rows["S", 1]["fear_greed_value"] is None
    assert rows["S", 1]["latest_ingested_at"] == t[2]
    assert rows["S", 2]["market_cap_usd"] is None and rows["S", 2]["sentiment_bucket"] == "Neutral"
    assert rows["T", 1]["latest_ingested_at"] == t[3]


def test_enrichment_by_coin_does_not_fan_out(spark):
    t = datetime(2024, 1, 1)
    candles = klines(spark, ("S", "1d", t, 1.0, t), ("T", "1d", t, 2.0, t), ("U", "1d", t, 3.0, t))
    coins = chart(
        spark, (t.date(), "bitcoin", 5.0, 6.0, 7.0, t), (t.date(), "other", 50.0, 60.0, 70.0, t)
    )
    no_mood = mood(spark)
    assert daily_enriched(candles, coins, no_mood).count() == 6
    mapping = spark.createDataFrame([("S", "bitcoin"), ("T", "other")], "symbol string, coin_id string")
    rows = daily_enriched(candles, coins, no_mood, mapping).collect()
    assert {(r["symbol"], r["coingecko_price_usd"]) for r in rows} == {
        ("S", 5.0), ("T", 50.0), ("U", None),
    }


def days(spark, *rows):
    return spark.createDataFrame(
        [(s, date(2024, 1, 1) + timedelta(days=d)) for s, d in rows], "symbol string, date_day date"
    )


def test_missing_days_and_coverage(spark):
    daily = days(spark, ("a", 0), ("a", 1), ("a", 4), ("a", 5), ("b", 40), ("b", 42), ("c", 7))
    missing = {(r["symbol"], r["date_day"]) for r in grain.missing_days(daily).collect()}
    assert missing == {
        ("a", date(2024, 1, 3)), ("a", date(2024, 1, 4)), ("b", date(2024, 2, 11)),
    }
    coverage = {r["symbol"]: r for r in grain.series_coverage(daily).collect()}
    assert [coverage[s]["n_missing"] for s in "abc"] == [2, 1, 0]
    assert coverage["a"]["last_day"] == date(2024, 1, 6)


def test_27_day_gap_is_found(spark):
    daily = days(spark, *(("s", d) for d in range(0, 60) if not 10 <= d < 37))
    assert grain.missing_days(daily).count() == 27


def test_duplicates_and_orphans(spark):
    rows = days(spark, ("a", 0), ("a", 0), ("a", 1), ("b", 0))
    assert [tuple(r) for r in grain.duplicate_keys(rows, ["symbol", "date_day"]).collect()] == [
        ("a", date(2024, 1, 1), 2)
    ]
    parent = days(spark, ("x", 1))
    child = rows.unionByName(
        spark.createDataFrame([("n", None)], "symbol string, date_day date")
    )
    assert [tuple(r) for r in grain.orphan_values(child, "date_day", parent).collect()] == [
        (date(2024, 1, 1), 3)
    ]


def test_spans_merge_with_those_of_new_days(spark):
    """Any split of an entity's days into stored and new ones gives the spans of all of them, with one exchange."""
    first = date(2024, 1, 1)
    offsets = [0, 1, 2, 2, 5, 6, 9, 20, 21, 22, 23]
    rows = [(s, first + timedelta(days=d)) for s in "ab" for d in offsets] + [("a", None), ("c", None)]
    daily = spark.createDataFrame(rows, "symbol string, date_day date")
    whole = grain.day_spans(daily)
    spans = {(r["symbol"], r["first_day"] and (r["first_day"] - first).days, r["n_rows"]) for r in whole.collect()}
    assert spans == {("b", 0, 4), ("b", 5, 2), ("b", 9, 1), ("b", 20, 4), ("a", 0, 4), ("a", 5, 2), ("a", 9, 1), ("a", 20, 5), ("c", None, 1)}
    for cut in (1, 6, 20):
        parts = [grain.day_spans(spark.createDataFrame(part, daily.schema)) for part in (rows[:cut], rows[cut:])]
        merged = grain.merged_spans(parts[0].unionByName(parts[1]))
        assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    gaps = {(r["symbol"], (r["date_day"] - first).days) for r in grain.span_gaps(whole).collect()}
    assert gaps == {(s, d) for s in "ab" for d in (3, 4, 7, 8, *range(10, 20))}
    for made in (grain.series_coverage(daily), grain.missing_days(daily)):
        assert plan_of(made).count("Exchange") == 1
