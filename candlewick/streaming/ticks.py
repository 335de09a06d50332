"""Trade ticks: raw messages to typed rows, a keyed JSON publish, unique ticks and bars.

Parsing and publishing are stateless projections, so they run the same on batch and streaming DataFrames
and need neither a shuffle nor a watermark.  Unique ticks and bars are stateful, with state that a watermark
bounds.  Source and sink formats are the caller's (Kafka, files, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.contracts import TICK
from candlewick.functions.scalar import iso_utc

# Keys of a trade message and their raw names here; T and t differ only in case, which json_tuple
# keeps apart (it also parses the message once for all six keys).
_KEYS = {
    "s": "symbol", "p": "price", "q": "quantity", "T": "event_ms", "t": "trade_id",
    "m": "is_buyer_maker",
}


def parse_ticks(messages: DataFrame, value: str = "value") -> DataFrame:
    """Typed ticks; fields that are missing or malformed become null (see ``complete_ticks``)."""
    raw = messages.select(
        F.json_tuple(F.col(value).cast("string"), *_KEYS).alias(*_KEYS.values())
    )
    return raw.select(
        "symbol",
        F.col("price").try_cast("double").alias("price"),
        F.col("quantity").try_cast("double").alias("quantity"),
        F.timestamp_millis(F.col("event_ms").try_cast("bigint")).alias("event_time"),
        F.col("trade_id").try_cast("bigint").alias("trade_id"),
        F.col("is_buyer_maker").try_cast("boolean").alias("is_buyer_maker"),
    ).select(*TICK.names)


def complete_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with all six fields; the others cannot be published."""
    return ticks.dropna(how="any", subset=TICK.names)


def incomplete_ticks(ticks: DataFrame) -> DataFrame:
    """The counterpart of ``complete_ticks``, for a dead-letter sink."""
    gone: Column = F.lit(False)
    for name in TICK.names:
        gone = gone | F.col(name).isNull()
    return ticks.filter(gone)


def to_messages(ticks: DataFrame) -> DataFrame:
    """(key, value): the symbol and the tick as JSON, with the event time in ISO-8601."""
    record = F.struct(
        "symbol", "price", "quantity", iso_utc(F.col("event_time")).alias("event_time"),
        "trade_id", "is_buyer_maker",
    )
    return ticks.select(F.col("symbol").alias("key"), F.to_json(record).alias("value"))


def publish_ticks(
    messages: DataFrame,
    sink_format: str,
    checkpoint: str,
    options: dict[str, str],
    available_now: bool = False,
) -> StreamingQuery:
    """Parse a message stream and append it, keyed by symbol, to a sink (e.g. a Kafka topic).

    The checkpoint must be on shared storage: it lets a restarted query go on where it stopped.
    """
    writer = (
        to_messages(complete_ticks(parse_ticks(messages)))
        .writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ---------------------------------------------------------------------------------------------
# Stateful operators: repeated ticks, bars, late ticks
# ---------------------------------------------------------------------------------------------


def unique_ticks(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Ticks without repeated trades (symbol, trade_id), which feeds deliver again after a reconnect.

    A stream keeps a trade's key until the watermark is ``delay`` beyond it, so the state is bounded by
    the ticks of that span; ticks that come later than the watermark are dropped with it.  A batch has no
    watermark and drops all repeated trades.
    """
    trade = ["symbol", "trade_id"]
    if not ticks.isStreaming:
        return ticks.dropDuplicates(trade)
    return ticks.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(trade)


def tick_bars(ticks: DataFrame, width: str = "1 minute", delay: str | None = "10 minutes") -> DataFrame:
    """OHLCV bars of complete ticks per symbol and event-time window.

    Time, then trade id decide which tick opens and closes a bar, in whatever order ticks arrive.  A stream
    in append mode emits a bar once, when the watermark has passed its end; a tick whose bar is out by then
    is late (``late_ticks`` counts them).  Partial bars are built before the shuffle, so a hot symbol sends
    one row per window and map task; state is one fixed-width row per symbol and open window.  Without a
    ``delay`` the ticks have their watermark already (as ``unique_ticks`` gives them).
    """
    timed = ticks if delay is None else ticks.withWatermark("event_time", delay)
    order = F.struct("event_time", "trade_id")
    bought = F.when(F.col("is_buyer_maker"), 0.0).otherwise(F.col("quantity"))
    return (
        timed.groupBy(F.window("event_time", width), "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"),
            F.count(F.lit(1)).alias("num_trades"),
            F.sum(bought).alias("taker_buy_base_vol"),
        )
        .select(
            "symbol", F.col("window.start").alias("open_time"), F.col("window.end").alias("close_time"),
            "open", "high", "low", "close", "volume", "quote_volume", "num_trades", "taker_buy_base_vol",
        )
    )


def write_bars(
    ticks: DataFrame, uri: str, checkpoint: str, width: str = "1 minute", delay: str | None = "10 minutes",
    available_now: bool = False,
) -> StreamingQuery:
    """Append finished bars to a Parquet table, whose log holds each micro-batch once whatever restarts."""
    writer = (
        tick_bars(complete_ticks(ticks), width, delay)
        .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start(uri)


def write_seen(
    ticks: DataFrame, uri: str, checkpoint: str, width: str = "1 minute", available_now: bool = False
) -> StreamingQuery:
    """Store how many complete ticks each micro-batch brought per symbol and window, however late.

    A micro-batch owns its partition, so running it again after a failure replaces what it wrote.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy("symbol", F.window("event_time", width).alias("span")).agg(
            F.count(F.lit(1)).alias("n_seen"), F.max("event_time").alias("last_time")
        )
        counted.select(
            "symbol", F.col("span.start").alias("open_time"), F.col("span.end").alias("close_time"), "n_seen", "last_time"
        ).write.mode("overwrite").parquet(f"{uri}/batch={batch_id}")

    writer = complete_ticks(ticks).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


SEEN = "symbol STRING, open_time TIMESTAMP, close_time TIMESTAMP, n_seen BIGINT, last_time TIMESTAMP"


def late_ticks(seen: DataFrame, bars: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(symbol, open_time, n_late): ticks that came after their bar was out, from both streams' tables.

    Bars that the watermark has not passed are still open and not compared.  Counts per window move, not
    ticks.
    """
    totals = seen.groupBy("symbol", "open_time", "close_time").agg(F.sum("n_seen").alias("n_seen"))
    watermark = seen.agg((F.max("last_time") - F.expr(f"INTERVAL {delay}")).alias("watermark")).scalar()
    closed = totals.filter(F.col("close_time") <= watermark)
    built = bars.select("symbol", "open_time", "num_trades")
    missing = F.col("n_seen") - F.coalesce("num_trades", F.lit(0))
    return (
        closed.join(built, ["symbol", "open_time"], "left")
        .select("symbol", "open_time", missing.alias("n_late"))
        .filter(F.col("n_late") > 0)
    )
