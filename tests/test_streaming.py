import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from candlewick.contracts import TICK
from candlewick.functions.scalar import iso_utc
from candlewick.streaming import ticks


def message(trade_id, ms=1_704_067_200_123, **changes):
    record = {"e": "trade", "s": "BTCUSDT", "p": "67432.15", "q": "0.002", "T": ms, "t": trade_id,
              "m": True, "M": False}
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def test_parse(spark):
    df = spark.createDataFrame([(message(7),)], "value string")
    [row] = ticks.parse_ticks(df).collect()
    assert row.asDict() == {
        "symbol": "BTCUSDT", "price": 67432.15, "quantity": 0.002,
        "event_time": datetime(2024, 1, 1, 0, 0, 0, 123000), "trade_id": 7, "is_buyer_maker": True,
    }


def test_incomplete_messages_are_set_apart(spark):
    values = [message(1), message(2, p="x"), message(3, m=...), message(4, T=...), "no json"]
    df = ticks.parse_ticks(spark.createDataFrame([(v,) for v in values], "value string"))
    assert [r["trade_id"] for r in ticks.complete_ticks(df).collect()] == [1]
    assert ticks.incomplete_ticks(df).count() == 4


def test_message_format(spark):
    df = spark.createDataFrame([(message(7),), (message(8, ms=1_704_067_200_000, m=False),)], "value string")
    rows = ticks.to_messages(ticks.parse_ticks(df)).collect()
    assert {r["key"] for r in rows} == {"BTCUSDT"}
    assert [json.loads(r["value"]) for r in rows] == [
        {"symbol": "BTCUSDT", "price": 67432.15, "quantity": 0.002, "trade_id": 7,
         "event_time": "2024-01-01T00:00:00.123000+00:00", "is_buyer_maker": True},
        {"symbol": "BTCUSDT", "price": 67432.15, "quantity": 0.002, "trade_id": 8,
         "event_time": "2024-01-01T00:00:00+00:00", "is_buyer_maker": False},
    ]


def test_iso_text_matches_python(spark):
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 2, 3, 4), datetime(1969, 12, 31, 23, 59, 59, 500000)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp")
    assert [r[0] for r in df.select(iso_utc(F.col("t"))).collect()] == [
        s.isoformat() + "+00:00" for s in stamps
    ]


def run_stream(spark, source, target, checkpoint):
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(source)
    ticks.publish_ticks(stream, "parquet", checkpoint, {"path": target}, available_now=True).awaitTermination()


def test_stream_equals_batch_and_resumes_without_repeats(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "check"))
    first = spark.createDataFrame([(message(i),) for i in range(50)], "value string").repartition(3)
    first.write.text(source)
    run_stream(spark, source, target, checkpoint)
    more = spark.createDataFrame([(message(i),) for i in range(50, 60)] + [("broken",)], "value string")
    more.write.mode("append").text(source)
    run_stream(spark, source, target, checkpoint)
    batch = ticks.to_messages(ticks.complete_ticks(ticks.parse_ticks(spark.read.text(source))))
    streamed = spark.read.schema(batch.schema).parquet(target)
    assert streamed.count() == 60
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


# ---------------------------------------------------------------------------------------------
# Unique ticks, bars, late ticks
# ---------------------------------------------------------------------------------------------

NOON = datetime(2024, 1, 5, 12)


def trade(second, price=10.0, number=None, symbol="AAA", quantity=1.0, maker=False):
    at = NOON + timedelta(seconds=second)
    return (symbol, float(price), quantity, at, second if number is None else number, maker)


class Feed:
    """A folder of ticks; ``run`` takes in what came since the last run, as after a restart."""

    def __init__(self, spark, tmp_path, build):
        self.spark, self.root, self.build, self.last = spark, str(tmp_path), build, None

    def send(self, *ticks):
        self.spark.createDataFrame(list(ticks), TICK).coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        source = self.spark.readStream.schema(TICK).parquet(f"{self.root}/in")
        query = (
            self.build(source).writeStream.format("parquet").option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True).start(f"{self.root}/out")
        )
        query.awaitTermination()
        self.last = query.lastProgress
        return self.spark.read.parquet(f"{self.root}/out")


def test_repeated_ticks_leave_and_their_state_is_bounded(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda rows: ticks.unique_ticks(rows, "1 minute"))
    feed.send(trade(0), trade(0), trade(1), trade(0, symbol="BBB"))
    out = feed.send(trade(1), trade(2), trade(2, price=99.0))  # again, in a later run
    assert sorted((r["symbol"], r["trade_id"]) for r in out.collect()) == [("AAA", 0), ("AAA", 1), ("AAA", 2), ("BBB", 0)]
    kept = []
    for step in range(1, 6):  # ten minutes on, one by one: old keys leave
        out = feed.send(*(trade(600 * step + i) for i in range(20)))
        kept.append(feed.last["stateOperators"][0]["numRowsTotal"])
    assert max(kept) <= 20 and out.count() == 4 + 5 * 20
    assert feed.send(trade(5)).count() == 104  # later than the watermark
    batch = spark.createDataFrame([trade(0), trade(0), trade(1)], TICK)
    assert ticks.unique_ticks(batch).count() == 2


def test_bars_of_ticks_in_any_order_over_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda rows: ticks.tick_bars(rows, "1 minute", "2 minutes"))
    feed.send(trade(30, 12.0), trade(5, 10.0, number=9), trade(5, 11.0, number=8), trade(59, 8.0, maker=True))
    feed.send(trade(40, 20.0), trade(3, 9.5, symbol="BBB"))  # the bar is still open: state outlives the run
    out = feed.send(trade(300, 1.0))  # the watermark passes the first minute
    bars = {r["symbol"]: r for r in out.collect()}
    first = bars["AAA"]
    assert (first["open"], first["high"], first["low"], first["close"]) == (11.0, 20.0, 8.0, 8.0)
    assert (first["volume"], first["num_trades"], first["taker_buy_base_vol"]) == (5.0, 5, 4.0)
    assert (first["open_time"], first["close_time"]) == (NOON, NOON + timedelta(minutes=1))
    assert bars["BBB"]["close"] == 9.5 and len(bars) == 2
    assert feed.last["stateOperators"][0]["numRowsTotal"] == 1
    out = feed.send(trade(10, 500.0), trade(310, 2.0))  # a tick of a bar that is out is late
    assert out.count() == 2 and out.agg({"high": "max"}).first()[0] == 20.0
    before = sorted(map(str, out.collect()))
    again = feed.build(spark.readStream.schema(TICK).parquet(f"{feed.root}/in")).writeStream.format("parquet")
    again.option("checkpointLocation", f"{feed.root}/checkpoint").trigger(availableNow=True).start(
        f"{feed.root}/out"
    ).awaitTermination()
    assert sorted(map(str, spark.read.parquet(f"{feed.root}/out").collect())) == before

    batch = ticks.tick_bars(spark.createDataFrame([trade(30, 12.0), trade(5, 10.0)], TICK))
    assert [(r["open"], r["close"]) for r in batch.collect()] == [(10.0, 12.0)]


def test_late_ticks_are_counted_by_window(spark, tmp_path):
    root = str(tmp_path)

    def send(*rows):
        spark.createDataFrame(list(rows), TICK).coalesce(1).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(TICK).parquet(f"{root}/in")
        for query in (
            ticks.write_bars(source, f"{root}/bars", f"{root}/c1", "1 minute", "1 minute", True),
            ticks.write_seen(source, f"{root}/seen", f"{root}/c2", "1 minute", True),
        ):
            query.awaitTermination()

    send(trade(0), trade(1), (None, *trade(2)[1:]))  # the last one is incomplete
    send(trade(300))
    send(trade(2), trade(3), trade(61), trade(299))  # three late ones, of two windows
    seen = spark.read.schema(ticks.SEEN).parquet(f"{root}/seen")
    late = ticks.late_ticks(seen, spark.read.parquet(f"{root}/bars"), "1 minute").collect()
    assert sorted((r["open_time"].minute, r["n_late"]) for r in late) == [(0, 2), (1, 1)]
