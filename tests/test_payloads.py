import random
from collections import Counter
from datetime import date, datetime, timezone

import pytest
from helpers import DAY1, DAY2, FETCHED, chart_doc, kline, landing, plan_of
from pyspark.sql import Observation, functions as F

from candlewick.sources import payloads


def chart_rows(spark, *docs):
    return payloads.parse_market_chart(landing(spark, *docs)).orderBy("date").collect()


def test_market_chart_columns_and_values(spark):
    df = payloads.parse_market_chart(landing(spark, chart_doc()))
    assert df.columns == [
        "date", "coin_id", "price_usd", "market_cap_usd", "volume_usd", "ingested_at",
    ]
    first, second = df.orderBy("date").collect()
    assert first.asDict() == {
        "date": datetime(2024, 1, 1), "coin_id": "bitcoin", "price_usd": 42_000.0,
        "market_cap_usd": 8.0e11, "volume_usd": 2.0e10, "ingested_at": FETCHED,
    }
    assert (second["date"], second["price_usd"]) == (datetime(2024, 1, 2), 43_500.0)


def test_market_chart_drops_unmatched_timestamps(spark):
    rows = chart_rows(spark, chart_doc(caps=[DAY1]))
    assert [r["date"] for r in rows] == [datetime(2024, 1, 1)]


def test_market_chart_lists_in_different_order_are_joined_not_zipped(spark):
    rows = chart_rows(spark, chart_doc(caps=[DAY2, DAY1]))
    assert [(r["price_usd"], r["market_cap_usd"]) for r in rows] == [
        (42_000.0, 8.2e11), (43_500.0, 8.0e11),
    ]


def test_market_chart_repeated_timestamps_multiply_and_documents_stay_apart(spark):
    doubled = chart_doc(days=[DAY1, DAY1, DAY2])
    rows = chart_rows(spark, doubled, chart_doc(), chart_doc(caps=[DAY1]))
    assert [r["date"].day for r in rows].count(1) == 8 + 1 + 1
    assert [r["date"].day for r in rows].count(2) == 1 + 1


def test_market_chart_keeps_null_values_of_matched_timestamps(spark):
    doc = {
        "prices": [[DAY1, 1.0], [DAY2, None]],
        "market_caps": [[DAY2, 5.0], [DAY1, None]],
        "total_volumes": [[DAY1, 7.0], [DAY2, 8.0]],
    }
    rows = chart_rows(spark, doc)
    assert [(r["price_usd"], r["market_cap_usd"], r["volume_usd"]) for r in rows] == [
        (1.0, None, 7.0), (None, 5.0, 8.0),
    ]


def test_market_chart_takes_one_scan_one_parse_and_no_shuffle(spark, tmp_path):
    landing(spark, chart_doc()).write.parquet(str(tmp_path / "l"))
    plan = plan_of(payloads.parse_market_chart(spark.read.parquet(str(tmp_path / "l"))))
    assert (plan.count("from_json"), plan.count("FileScan"), plan.count("Exchange")) == (1, 1, 0)
    assert plan.count("array_sort") == 1


def test_ragged_market_charts_equal_a_plain_join(spark):
    """Missing, repeated, null and unordered timestamps, empty lists; every document by itself."""
    pick = random.Random(4)

    def points():
        days = [pick.choice([None, *range(6)]) for _ in range(pick.randint(0, 7))]
        return [[None if day is None else DAY1 + day * 86_400_000, pick.choice([None, pick.randint(1, 9)])] for day in days]

    docs = [dict(prices=points(), market_caps=points(), total_volumes=points()) for _ in range(150)]
    docs.append(chart_doc(days=[DAY1 + i * 60_000 for i in range(20_000)], caps=[DAY1 + i * 60_000 for i in range(1, 20_001)]))
    want = Counter(
        (datetime.fromtimestamp(t / 1000, timezone.utc).replace(tzinfo=None), p, c, v)
        for doc in docs[:-1]
        for t, p in doc["prices"] if t is not None
        for t2, c in doc["market_caps"] if t2 == t
        for t3, v in doc["total_volumes"] if t3 == t
    )
    columns = ["date", "price_usd", "market_cap_usd", "volume_usd"]
    found = payloads.parse_market_chart(landing(spark, *docs[:-1])).select(*columns).collect()
    assert want.total() > 50 and Counter(map(tuple, found)) == want
    assert payloads.parse_market_chart(landing(spark, docs[-1])).count() == 19_999


def test_faulty_documents_are_set_apart_with_their_reason(spark):
    good = [kline(DAY1), kline(DAY2)]
    bodies = {
        "p0": good, "p1": "not json", "p2": '[["1", "2"', "p3": "", "p4": "null", "p5": {"no": "list"}, "p6": [good[0][:8]],
        "p7": [good[0], ["x", *good[0][1:]]], "p8": [[10**18, *good[0][1:]]], "p9": [[*good[0][:9], "1,5", *good[0][10:]]],
        "p10": [], "p11": [[good[0][0], None, *good[0][2:]]],
    }
    docs = klines(spark, *bodies.values()).unionByName(klines(spark, good, interval="7d", start=20))
    docs = docs.unionByName(klines(spark, good, start=30).withColumn("body", F.lit(None).cast("string")))
    seen = Observation()
    rows = payloads.tolerant_rows(docs, "klines_1d", seen)
    assert rows.columns == payloads.parse_klines(docs).columns and len(rows.collect()) == 2 + 0 + 1
    reasons = {r["payload_id"]: r["reason"] for r in payloads.rejected(docs, "klines_1d").collect()}
    malformed = dict.fromkeys(["p1", "p2", "p3", "p4", "p5", "p30"], "Malformed body")
    assert reasons == malformed | {
        "p6": "Short bar", "p7": "Bad number", "p8": "Bad number", "p9": "Bad number", "p20": "Invalid interval: 7d",
    }
    assert seen.get == {"n_documents": 14, "n_rejected": len(reasons)}
    kept = payloads.rejected(docs, "klines_1d").filter("payload_id = 'p1'").first()
    assert (kept["body"], kept["entity"], kept["interval"], kept["fetched_at"]) == ("not json", "BTCUSDT", "1d", FETCHED)

    charts = landing(
        spark, chart_doc(), {"prices": []}, {**chart_doc(), "prices": [["x", 1]]}, {**chart_doc(), "prices": [[DAY1]]},
        {**chart_doc(), "total_volumes": [[1e18, 2.0]]},
    )
    assert payloads.tolerant_rows(charts, "market_chart", Observation()).count() == 2
    reasons = [r["reason"] for r in payloads.rejected(charts, "market_chart").orderBy("payload_id").collect()]
    assert reasons == ["Missing key 'market_caps'", "Malformed body", "Short point", "Bad time"]

    entry = INDEX["data"][0]
    index = landing(spark, INDEX, {"error": "x"}, {"data": [{**entry, "value": "n/a"}]}, dataset="index")
    assert payloads.tolerant_rows(index, "index", Observation()).count() == 2
    assert [r["reason"] for r in payloads.rejected(index, "index").orderBy("payload_id").collect()] == [
        "Missing key 'data'", "Bad number",
    ]


def test_market_chart_without_a_list_fails(spark):
    with pytest.raises(Exception, match="Missing key 'market_caps' in payload p0"):
        chart_rows(spark, {"prices": [[DAY1, 1.0]], "total_volumes": [[DAY1, 1.0]]})


def test_malformed_json_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        chart_rows(spark, '{"prices": [[1, 2')


def klines(spark, *pages, interval="1d", **kwargs):
    return landing(
        spark, *pages, source="binance", dataset=f"klines_{interval}", entity="BTCUSDT",
        interval=interval, **kwargs,
    )


def test_klines_pages_are_unioned_and_typed(spark):
    pages = klines(spark, [kline(DAY1)], [kline(DAY2, close=50.0)], [])
    df = payloads.parse_klines(pages)
    assert dict(df.dtypes)["num_trades"] == "bigint" and dict(df.dtypes)["open"] == "double"
    first, second = df.orderBy("open_time").collect()
    assert first.asDict() == {
        "open_time": datetime(2024, 1, 1), "close_time": datetime(2024, 1, 1, 23, 59, 59, 999000),
        "symbol": "BTCUSDT", "interval": "1d", "open": 42_000.5, "high": 44_000.0, "low": 41_000.0,
        "close": 43_000.0, "volume": 1200.25, "quote_volume": 5.0e7, "num_trades": 1234,
        "taker_buy_base_vol": 600.5, "taker_buy_quote_vol": 2.5e7, "ingested_at": FETCHED,
    }
    assert second["close"] == 50.0


def test_unknown_interval_fails(spark):
    with pytest.raises(Exception, match="Invalid interval: 7d"):
        payloads.parse_klines(klines(spark, [kline(DAY1)], interval="7d")).collect()
    with pytest.raises(Exception, match="Invalid interval: 7d"):  # also where the column isn't used
        payloads.parse_klines(klines(spark, [kline(DAY1)], interval="7d")).select("close").collect()


def test_page_coverage(spark):
    hour = 3_600_000
    bars = [kline(DAY1 + i * hour, span_ms=hour) for i in range(9)]
    pages = klines(spark, bars[0:2], bars[2:4], bars[6:8], bars[8:9], [], interval="1h")
    end = F.lit("2024-01-02").cast("timestamp")
    rows = {
        r["payload_id"]: r
        for r in payloads.page_coverage(payloads.kline_pages(pages), end, page_size=2).collect()
    }
    assert {k: r["is_broken"] for k, r in rows.items()} == {
        "p0": False, "p1": True, "p2": False, "p3": False, "p4": False,
    }
    assert {k for k, r in rows.items() if r["is_last"]} == {"p3", "p4"}
    reached = payloads.page_coverage(
        payloads.kline_pages(pages), F.lit("2024-01-01 03:00").cast("timestamp"), page_size=2
    )
    assert not reached.filter("is_broken").collect()


def test_ohlc(spark):
    df = payloads.parse_ohlc(landing(spark, [[DAY1, 1.0, 4.0, 0.5, 2.0], [DAY2, 2, 3, 1, 2.5]]))
    first = df.orderBy("date").first()
    assert (first["date"], first["open"], first["high"], first["low"], first["close"]) == (
        datetime(2024, 1, 1), 1.0, 4.0, 0.5, 2.0,
    )
    assert first["coin_id"] == "bitcoin" and df.count() == 2


def test_metadata_optional_and_required_keys(spark):
    full = {
        "name": "Bitcoin", "symbol": "btc", "genesis_date": "2009-01-03",
        "hashing_algorithm": "SHA-256", "market_data": {"market_cap_rank": 1},
    }
    bare = {"name": "X", "symbol": "x", "market_data": {}}
    rows = payloads.parse_metadata(landing(spark, full, bare)).orderBy("name").collect()
    assert (rows[0]["genesis_date"], rows[0]["market_cap_rank"]) == ("2009-01-03", 1)
    assert rows[1]["genesis_date"] is None and rows[1]["market_cap_rank"] is None
    for key in ("name", "symbol", "market_data"):
        broken = {k: v for k, v in full.items() if k != key}
        with pytest.raises(Exception, match=f"Missing key '{key}'"):
            payloads.parse_metadata(landing(spark, broken)).collect()


INDEX = {
    "data": [
        {"value": "72", "value_classification": "Greed", "timestamp": "1704931200"},
        {"value": "20", "value_classification": "Extreme Fear", "timestamp": "1704844800"},
    ]
}


def test_sentiment_index_oldest_first_and_latest(spark):
    docs = landing(spark, INDEX, dataset="index")
    rows = payloads.oldest_first(payloads.parse_sentiment_index(docs)).collect()
    assert [(r["date"], r["fear_greed_value"], r["sentiment_bucket"]) for r in rows] == [
        (datetime(2024, 1, 10), 20, "Extreme Fear"), (datetime(2024, 1, 11), 72, "Greed"),
    ]
    latest = payloads.latest_sentiment(docs)
    assert latest.columns == payloads.parse_sentiment_index(docs).columns
    assert [r["date"].date() for r in latest.collect()] == [date(2024, 1, 11)]


def test_sentiment_index_bad_value_or_missing_data_fails(spark):
    bad = {"data": [{"value": "n/a", "value_classification": "Greed", "timestamp": "1704931200"}]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        payloads.parse_sentiment_index(landing(spark, bad)).collect()
    with pytest.raises(Exception, match="Missing key 'data'"):
        payloads.parse_sentiment_index(landing(spark, {"error": "x"})).collect()
