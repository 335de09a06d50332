"""Marts against a brute-force computation in plain Python."""

import math
import statistics
from datetime import date, timedelta

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from candlewick.functions.rolling import rolling_corr, series
from candlewick.functions.scalar import sentiment_bucket, upper_anomaly, zscore
from candlewick.plans import gold

START = date(2024, 1, 1)


def enriched(spark, *rows):
    """(symbol, day offset, close, volume, sentiment)"""
    data = [
        (START + timedelta(days=d), s, None if c is None else float(c), float(v), m)
        for s, d, c, v, m in rows
    ]
    df = spark.createDataFrame(
        data, "date_day date, symbol string, close double, volume double, fear_greed_value int"
    )
    return df.select(
        "*", *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "quote_volume")),
        F.lit(1).alias("num_trades"), F.lit(1.0).alias("market_cap_usd"),
        F.lit(1.0).alias("coingecko_volume_usd"), F.lit("L").alias("sentiment_label"),
        F.lit("B").alias("sentiment_bucket"), F.lit("2024-01-01").cast("timestamp").alias("latest_ingested_at"),
    )


def ordered(df):
    return df.orderBy("symbol", "date_day").collect()


def close_to(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def brute_returns(closes):
    return [
        None if i == 0 or not closes[i - 1] else 100 * (closes[i] / closes[i - 1] - 1)
        for i in range(len(closes))
    ]


def frame(values, i, n):
    return [v for v in values[max(0, i - n + 1): i + 1] if v is not None]


def std(values):
    return statistics.stdev(values) if len(values) > 1 else None


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 30, 31, 65])
def test_price_mart_frames(spark, n):
    closes = [100 + (i * 37) % 23 + i / 8 for i in range(n)]
    # Rows, not days: leave holes in the calendar. A second symbol must not leak in.
    rows = [("a", i + i // 5, c, 1, 50) for i, c in enumerate(closes)]
    rows += [("b", i, 1 + i, 1, 50) for i in range(4)]
    found = [r for r in ordered(gold.price_analysis(enriched(spark, *rows))) if r["symbol"] == "a"]
    returns = brute_returns(closes)
    for i, row in enumerate(found):
        assert close_to(row["price_change_usd"], None if i == 0 else closes[i] - closes[i - 1])
        assert close_to(row["daily_return_pct"], returns[i])
        assert close_to(row["ma7_close"], statistics.fmean(frame(closes, i, 7)))
        assert close_to(row["ma30_close"], statistics.fmean(frame(closes, i, 30)))
        assert close_to(row["volatility_30d_pct"], std(frame(returns, i, 30)))
    assert found[0]["volatility_30d_pct"] is None
    if n > 2:
        assert found[1]["volatility_30d_pct"] is None and found[2]["volatility_30d_pct"] is not None


def test_previous_close_of_zero_gives_no_return(spark):
    rows = ordered(gold.price_analysis(enriched(spark, ("a", 0, 0, 1, 1), ("a", 1, 5, 1, 1), ("a", 2, 10, 1, 1))))
    assert [r["daily_return_pct"] for r in rows] == [None, None, 100.0]
    assert [r["price_change_usd"] for r in rows] == [None, 5.0, 5.0]


def test_constant_close(spark):
    rows = ordered(gold.price_analysis(enriched(spark, *(("a", d, 7, 1, 1) for d in range(5)))))
    assert [r["volatility_30d_pct"] for r in rows] == [None, None, 0.0, 0.0, 0.0]


def brute_corr(xs, ys):
    pairs = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    if not pairs:
        return None
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    if len(pairs) == 1 or len(set(a)) == 1 or len(set(b)) == 1:
        return math.nan
    return statistics.correlation(a, b)


@pytest.mark.parametrize("n", [1, 2, 3, 31, 64])
def test_sentiment_mart(spark, n):
    closes = [100 + (i * 31) % 17 for i in range(n)]
    moods = [None if i % 6 == 4 else (i * 13) % 101 for i in range(n)]
    rows = [("a", i, closes[i], 1, moods[i]) for i in range(n)]
    found = ordered(gold.sentiment_correlation(gold.price_analysis(enriched(spark, *rows))))
    returns = brute_returns(closes)
    kept = [i for i in range(n) if moods[i] is not None]
    assert len(found) == len(kept)
    xs, ys = [moods[i] for i in kept], [returns[i] for i in kept]
    for k, row in enumerate(found):
        low = max(0, k - 29)
        assert row["sentiment_change"] == (None if k == 0 else xs[k] - xs[k - 1])
        assert close_to(row["next_day_return_pct"], ys[k + 1] if k + 1 < len(ys) else None)
        assert close_to(
            row["rolling_30d_sentiment_return_corr"], brute_corr(xs[low: k + 1], ys[low: k + 1])
        )


@pytest.mark.parametrize(
    "xs,ys",
    [
        ([1, 1, 1], [1, 2, 3]),
        ([1, 2, 3], [5, 5, 5]),
        ([None, None], [1, 2]),
        ([1, None, 3, 4], [None, 2, 5, 9]),
        ([1, 2], [2, 4]),
        ([3], [4]),
    ],
)
def test_rolling_corr_edges_match_duckdb(spark, xs, ys):
    import duckdb

    rows = [("s", i, x, y) for i, (x, y) in enumerate(zip(xs, ys))]
    df = spark.createDataFrame(rows, "k string, t int, x int, y int")
    found = [
        r["c"] for r in df.select("t", rolling_corr("x", "y", series("k", "t"), 30).alias("c")).orderBy("t").collect()
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE v(k VARCHAR, t INT, x INT, y INT)")
    con.executemany("INSERT INTO v VALUES (?, ?, ?, ?)", rows)
    expected = [
        r[0] for r in con.execute(
            "SELECT corr(x, y) OVER (PARTITION BY k ORDER BY t ROWS 29 PRECEDING) FROM v ORDER BY t"
        ).fetchall()
    ]
    assert all(close_to(a, b) for a, b in zip(found, expected)), (found, expected)


def test_volume_mart(spark):
    volumes = [10 + (i * 7) % 5 for i in range(40)] + [60, 11]
    rows = [("a", i, 1, v, None) for i, v in enumerate(volumes)]
    found = ordered(gold.volume_anomalies(gold.price_analysis(enriched(spark, *rows))))
    for i, row in enumerate(found):
        mean, dev = statistics.fmean(frame(volumes, i, 30)), std(frame(volumes, i, 30))
        z = None if not dev else (volumes[i] - mean) / dev
        assert close_to(row["volume_ma30"], mean) and close_to(row["volume_std30"], dev)
        assert close_to(row["volume_z_score"], z)
        assert row["is_volume_anomaly"] is (z is not None and z >= 2)
    assert [i for i, r in enumerate(found) if r["is_volume_anomaly"]] == [40]


def test_constant_volume_has_no_score_and_no_anomaly(spark):
    found = ordered(gold.volume_anomalies(gold.price_analysis(enriched(spark, *(("a", d, 1, 5, 1) for d in range(4))))))
    assert [r["volume_z_score"] for r in found] == [None] * 4
    assert [r["is_volume_anomaly"] for r in found] == [False] * 4


def test_anomaly_threshold_is_inclusive_and_upper_only(spark):
    df = spark.createDataFrame(
        [(14.0, 10.0, 2.0), (13.9, 10.0, 2.0), (6.0, 10.0, 2.0), (14.0, 10.0, 0.0), (14.0, 10.0, None)],
        "v double, m double, s double",
    )
    z = zscore(F.col("v"), F.col("m"), F.col("s"))
    rows = df.select(z.alias("z"), upper_anomaly(z, F.col("s")).alias("flag")).collect()
    assert [r["z"] for r in rows] == [2.0, pytest.approx(1.95), -2.0, None, None]
    assert [r["flag"] for r in rows] == [True, False, False, False, False]


def test_sentiment_ranges(spark):
    expected = {
        -1: "Unknown", 0: "Extreme Fear", 24: "Extreme Fear", 25: "Fear", 49: "Fear",
        50: "Neutral", 51: "Greed", 74: "Greed", 75: "Extreme Greed", 100: "Extreme Greed",
        101: "Unknown",
    }
    df = spark.createDataFrame([(v,) for v in expected], "v int")
    assert {r["v"]: r["b"] for r in df.select("v", sentiment_bucket("v").alias("b")).collect()} == expected


def test_price_mart_shuffles_once_and_never_leaves_the_jvm(spark, tmp_path):
    enriched(spark, ("a", 0, 1, 1, 1)).write.parquet(str(tmp_path / "e"))
    price = gold.price_analysis(spark.read.parquet(str(tmp_path / "e")))
    for mart in (price, gold.sentiment_correlation(price), gold.volume_anomalies(price)):
        plan = plan_of(mart)
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
        assert "Python" not in plan
