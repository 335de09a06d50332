"""Raw API payloads (one JSON document per landing row) to Bronze rows.

Every parser takes a landing DataFrame (``contracts.LANDING``) and works inside the row: the body
is parsed once by a generator and exploded, so parsing needs no shuffle.  A faulty document fails the job
in the ``parse_*`` functions; ``tolerant_rows`` leaves it out and counts it, and ``rejected`` keeps it with
the reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from candlewick.contracts import KLINE_PAGE_SIZE, KLINES, LANDING, MARKET_CHART, SENTIMENT_INDEX, VALID_INTERVALS
from candlewick.functions.scalar import millis_to_timestamp, seconds_to_date, sentiment_bucket

_CORRUPT = "_corrupt"
# Milliseconds of the years 1 to 9999.
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


@dataclass(frozen=True)
class Format:
    """A payload format: the body's schema, and what is wrong with a parsed one (text, or null if nothing).

    ``faults`` are always looked for.  ``bad_values`` are values that fail the job when they are cast; they
    are looked for only where a faulty document must not do that.
    """

    schema: str
    faults: Callable[[], Column]
    bad_values: Callable[[], Column]


def _none() -> Column:
    return F.lit(None).cast("string")


def _missing_key(*names: str) -> Callable[[], Column]:
    def fault() -> Column:
        doc = F.col("doc")
        return F.coalesce(*(F.when(doc[name].isNull(), F.lit(f"Missing key '{name}'")) for name in names))

    return fault


def _unknown_interval() -> Column:
    interval = F.col("interval")
    complaint = F.concat(F.lit("Invalid interval: "), F.coalesce(interval, F.lit("null")))
    return F.when(~F.coalesce(interval.isin(*VALID_INTERVALS), F.lit(False)), complaint)


def _not_a(kind: str, value: Column) -> Column:
    return value.isNotNull() & value.try_cast(kind).isNull()


def _bad_bars() -> Column:
    whole, fraction = (0, 6, 8), (1, 2, 3, 4, 5, 7, 9, 10)

    def bad(bar: Column) -> Column:
        wrong = F.lit(False)
        for kind, positions in (("bigint", whole), ("double", fraction)):
            for position in positions:
                wrong = wrong | _not_a(kind, bar[position])
        return wrong | _bad_time(bar[0].try_cast("bigint")) | _bad_time(bar[6].try_cast("bigint"))

    bars = F.col("doc")
    return F.when(F.exists(bars, lambda bar: bar.isNull() | (F.size(bar) < 11)), F.lit("Short bar")).when(
        F.exists(bars, bad), F.lit("Bad number")
    )


def _bad_time(ms: Column) -> Column:
    return F.coalesce(F.isnan(ms.cast("double")) | ~ms.between(_FIRST_MS, _LAST_MS), F.lit(False))


def _bad_points(n_values: int, *names: str) -> Callable[[], Column]:
    """Lists of [time, value, ..]: of the document's keys, or the document itself."""

    def fault() -> Column:
        lists = [F.col("doc")[name] for name in names] or [F.col("doc")]
        short = lambda point: point.isNull() | (F.size(point) < n_values)
        return F.coalesce(
            *(F.when(F.exists(points, short), F.lit("Short point")) for points in lists),
            *(F.when(F.exists(points, lambda point: _bad_time(point[0])), F.lit("Bad time")) for points in lists),
        )

    return fault


def _bad_entries() -> Column:
    bad = lambda entry: _not_a("bigint", entry["timestamp"]) | _not_a("bigint", entry["value"])
    return F.when(F.exists(F.col("doc")["data"], bad), F.lit("Bad number"))


_CHART_LISTS = {"prices": "price_usd", "market_caps": "market_cap_usd", "total_volumes": "volume_usd"}
_KLINE_FORMAT = Format("array<array<string>>", _unknown_interval, _bad_bars)
_CHART_FORMAT = Format(
    f"struct<{', '.join(f'{name}: array<array<double>>' for name in _CHART_LISTS)}>",
    _missing_key(*_CHART_LISTS), _bad_points(2, *_CHART_LISTS),
)
_OHLC_FORMAT = Format("array<array<double>>", _none, _bad_points(5))
_INDEX_FORMAT = Format(
    "struct<data: array<struct<value: string, value_classification: string, timestamp: string>>>",
    _missing_key("data"), _bad_entries,
)
_METADATA_FORMAT = Format(
    "struct<name: string, symbol: string, genesis_date: string, hashing_algorithm: string, "
    "market_data: struct<market_cap_rank: bigint>>",
    _missing_key("name", "symbol", "market_data"), _none,
)


def _opened(landing: DataFrame, schema: str) -> DataFrame:
    """The documents with their parsed body as ``doc``; ``_corrupt`` is set where it does not fit the schema.

    A generator rather than a column: the optimizer cannot copy it into later filters and projections, so
    each body is parsed exactly once.  The body is wrapped, as only objects can say what is wrong with them.
    """
    wrapped = F.concat(F.lit('{"doc":'), F.col("body"), F.lit("}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(wrapped, f"doc {schema}, {_CORRUPT} string", options)
    return landing.select(*LANDING.names, F.inline(F.array(parsed)))


def _reason(faults: Column) -> Column:
    unreadable = F.col("doc").isNull() | F.col(_CORRUPT).isNotNull()
    return F.when(unreadable, F.lit("Malformed body")).otherwise(faults)


def _sound(landing: DataFrame, form: Format) -> DataFrame:
    """The opened documents; the job fails if one is faulty, also where none of its columns is used."""
    documents = _opened(landing, form.schema)
    reason = _reason(form.faults())
    complaint = F.concat(reason, F.lit(" in payload "), F.col("payload_id"))
    return documents.filter(F.when(reason.isNull(), True).otherwise(F.raise_error(complaint).cast("boolean")))


def _checked(landing: DataFrame, form: Format) -> DataFrame:
    """The opened documents with the reason why one cannot be used (null if it can)."""
    reason = _reason(F.coalesce(form.faults(), form.bad_values()))
    return _opened(landing, form.schema).select("*", F.inline(F.array(F.struct(reason.alias("reason")))))


def parse_klines(landing: DataFrame) -> DataFrame:
    """Candle pages to Bronze candles; pages of one request are simply unioned.

    Positions: 0 open time ms, 1-4 open/high/low/close, 5 volume, 6 close time ms, 7 quote volume,
    8 trades, 9-10 taker buy volumes, 11 unused.  An unknown interval fails the job.
    """
    return _kline_rows(_sound(landing, _KLINE_FORMAT))


def _kline_rows(documents: DataFrame) -> DataFrame:
    bars = documents.select(
        F.col("entity").alias("symbol"),
        "interval",
        F.col("fetched_at").alias("ingested_at"),
        F.explode("doc").alias("bar"),
    )
    bar = F.col("bar")

    def number(position: int, name: str) -> Column:
        return bar[position].cast("double").alias(name)

    return bars.select(
        millis_to_timestamp(bar[0]).alias("open_time"),
        millis_to_timestamp(bar[6]).alias("close_time"),
        "symbol",
        "interval",
        number(1, "open"),
        number(2, "high"),
        number(3, "low"),
        number(4, "close"),
        number(5, "volume"),
        number(7, "quote_volume"),
        bar[8].cast("bigint").alias("num_trades"),
        number(9, "taker_buy_base_vol"),
        number(10, "taker_buy_quote_vol"),
        "ingested_at",
    ).select(*KLINES.names)


def kline_pages(landing: DataFrame) -> DataFrame:
    """One summary row per candle page, without exploding it."""
    body = _sound(landing, Format(_KLINE_FORMAT.schema, _none, _none)).select(
        "payload_id", F.col("entity").alias("symbol"), "interval", F.col("doc").alias("bars")
    )
    edge = lambda index, position: F.try_element_at("bars", F.lit(index))[position]
    return body.select(
        "payload_id",
        "symbol",
        "interval",
        F.size("bars").alias("n_bars"),
        millis_to_timestamp(edge(1, 0)).alias("first_open"),
        millis_to_timestamp(edge(-1, 6)).alias("last_close"),
    )


def page_coverage(
    pages: DataFrame, end: Column, page_size: int = KLINE_PAGE_SIZE
) -> DataFrame:
    """Does every page that must be followed by another one have its follow-up?

    ``pages`` are page summaries (``kline_pages``); they are read twice, so store them first.
    Paging stops at an empty or short page, or once a page reaches ``end``.  Any other page needs
    a next one that starts 1 ms after its last close.  The follow-up is found by an equi-join on
    that instant, so no symbol's pages have to meet in one task.
    """
    starts = pages.filter(F.col("n_bars") > 0).select(
        "symbol", "interval", F.col("first_open").alias("next_start"),
    ).distinct()
    is_last = (F.col("n_bars") < page_size) | (F.col("last_close") >= end)
    expected = pages.withColumns({
        "next_start": F.col("last_close") + F.expr("INTERVAL 1 MILLISECOND"),
        "is_last": F.coalesce(is_last, F.lit(True)),
    })
    found = starts.withColumn("followed", F.lit(True))
    return expected.join(found, ["symbol", "interval", "next_start"], "left").select(
        "payload_id", "symbol", "interval", "n_bars", "first_open", "last_close", "is_last",
        (~F.col("is_last") & F.col("followed").isNull()).alias("is_broken"),
    )


_CHART_POINT = "ts double, " + ", ".join(f"{column} double" for column in _CHART_LISTS.values())


def _zipped() -> Column:
    """The points of lists with the same timestamps in the same order."""
    return F.transform(
        F.arrays_zip(*_CHART_LISTS),
        lambda z: F.struct(
            z["prices"][0].alias("ts"), *(z[name][1].alias(column) for name, column in _CHART_LISTS.items())
        ),
    )


def _tagged_points() -> Column:
    """All points of the three lists, each with its list's number, in the order of their timestamps."""

    def tagged(number: int, name: str) -> Column:
        timed = F.filter(F.col(name), lambda point: point[0].isNotNull())
        return F.transform(
            timed, lambda point: F.struct(point[0].alias("ts"), F.lit(number).alias("list"), point[1].alias("value"))
        )

    return F.array_sort(F.concat(*(tagged(number, name) for number, name in enumerate(_CHART_LISTS))))


def _merged_points() -> Column:
    """Points of the column ``tagged`` whose timestamp all lists have; repeated timestamps multiply.

    Points of a timestamp stand side by side, so each run of them is cut out once: the work grows with the
    points and the result, not with their square.
    """
    points = F.col("tagged")
    ts_at = lambda i: F.element_at(points, i)["ts"]
    starts = F.filter(
        F.sequence(F.lit(1), F.size(points)), lambda i: F.when(i == 1, True).otherwise(ts_at(i) != ts_at(i - 1))
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(points) + 1))

    def joined(span: Column) -> Column:
        run = F.slice(points, span["from"], span["to"] - span["from"])
        of = lambda number: F.filter(run, lambda point: point["list"] == number)
        point = lambda price, cap, volume: F.struct(
            price["ts"].alias("ts"), price["value"].alias("price_usd"), cap["value"].alias("market_cap_usd"),
            volume["value"].alias("volume_usd"),
        )
        return F.flatten(F.transform(of(0), lambda price: F.flatten(
            F.transform(of(1), lambda cap: F.transform(of(2), lambda volume: point(price, cap, volume)))
        )))

    spans = F.arrays_zip(starts.alias("from"), ends.alias("to"))
    none = F.from_json(F.lit("[]"), f"array<struct<{_CHART_POINT.replace(' double', ': double')}>>")
    return F.when(F.size(points) == 0, none).otherwise(F.flatten(F.transform(spans, joined)))


def parse_market_chart(landing: DataFrame) -> DataFrame:
    """Three parallel ``[ts, value]`` lists, inner-joined on their timestamps, inside the row.

    Usually the lists carry the same distinct timestamps in the same order and are zipped.  Otherwise their
    points are sorted together and joined timestamp by timestamp: those that a list lacks drop out, repeated
    ones multiply.  Either way a document is parsed once and nothing is shuffled.
    """
    return _chart_rows(_sound(landing, _CHART_FORMAT))


def _chart_rows(documents: DataFrame) -> DataFrame:
    lists = documents.select(
        F.col("entity").alias("coin_id"), F.col("fetched_at").alias("ingested_at"),
        *(F.col("doc")[name].alias(name) for name in _CHART_LISTS),
    )
    times = lambda name: F.transform(F.col(name), lambda point: point[0])
    is_aligned = F.coalesce(
        (times("prices") == times("market_caps"))
        & (times("prices") == times("total_volumes"))
        & (F.size(F.array_distinct(times("prices"))) == F.size("prices"))
        & ~F.exists(times("prices"), lambda ts: ts.isNull()),
        F.lit(False),
    )
    # generators, so that no later expression holds a copy of what they compute
    ordered = lists.select(
        "coin_id", "ingested_at", *_CHART_LISTS,
        F.inline(F.array(F.struct(
            is_aligned.alias("is_aligned"),
            F.when(~is_aligned, _tagged_points()).alias("tagged"),
        ))),
    )
    points = F.when(F.col("is_aligned"), _zipped()).otherwise(_merged_points())
    return (
        ordered.select("coin_id", "ingested_at", F.inline(points))
        .withColumn("date", millis_to_timestamp(F.col("ts")))
        .select(*MARKET_CHART.names)
    )


def parse_ohlc(landing: DataFrame) -> DataFrame:
    """``[[ts, open, high, low, close], ...]`` to one row per candle."""
    candle = F.col("candle")
    return _sound(landing, _OHLC_FORMAT).select(
        F.col("entity").alias("coin_id"),
        F.col("fetched_at").alias("ingested_at"),
        F.explode("doc").alias("candle"),
    ).select(
        candle[1].alias("open"),
        candle[2].alias("high"),
        candle[3].alias("low"),
        candle[4].alias("close"),
        millis_to_timestamp(candle[0]).alias("date"),
        "coin_id",
        "ingested_at",
    )


def parse_metadata(landing: DataFrame) -> DataFrame:
    """Coin documents to one row each; ``name`` and ``symbol`` are required, the rest is optional."""
    doc = F.col("doc")
    return _sound(landing, _METADATA_FORMAT).select(
        F.col("entity").alias("coin_id"),
        *(doc[name].alias(name) for name in ("name", "symbol", "genesis_date", "hashing_algorithm")),
        doc["market_data"]["market_cap_rank"].alias("market_cap_rank"),
        "fetched_at",
    )


def _index_documents(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("fetched_at").alias("ingested_at"), F.col("doc")["data"].alias("data"))


def _index_rows(entries: DataFrame) -> DataFrame:
    entry = F.col("entry")
    return entries.select(
        seconds_to_date(entry["timestamp"]).cast("timestamp").alias("date"),
        entry["value"].cast("bigint").alias("fear_greed_value"),
        entry["value_classification"].alias("sentiment_label"),
        "ingested_at",
    ).withColumn("sentiment_bucket", sentiment_bucket("fear_greed_value")).select(
        *SENTIMENT_INDEX.names
    )


def parse_sentiment_index(landing: DataFrame) -> DataFrame:
    """All index entries with our own bucket next to the API's label (see ``oldest_first``)."""
    return _all_entries(_sound(landing, _INDEX_FORMAT))


def _all_entries(documents: DataFrame) -> DataFrame:
    return _index_rows(
        _index_documents(documents).select("ingested_at", F.explode("data").alias("entry"))
    )


def latest_sentiment(landing: DataFrame) -> DataFrame:
    """Only the first (newest) entry of each index document, in the same schema."""
    documents = _index_documents(_sound(landing, _INDEX_FORMAT))
    return _index_rows(documents.select("ingested_at", F.element_at("data", 1).alias("entry")))


def oldest_first(rows: DataFrame, time_col: str = "date") -> DataFrame:
    """In time order; re-ingested copies of a time follow by ingestion."""
    return rows.orderBy(F.col(time_col).asc_nulls_last(), "ingested_at")


# ---------------------------------------------------------------------------------------------
# Faulty documents
# ---------------------------------------------------------------------------------------------

# The format of each stored dataset's payloads, and their rows.
_DATASET_FORMATS: dict[str, tuple[Format, Callable[[DataFrame], DataFrame]]] = {
    "market_chart": (_CHART_FORMAT, _chart_rows),
    "klines_1d": (_KLINE_FORMAT, _kline_rows),
    "klines_1h": (_KLINE_FORMAT, _kline_rows),
    "index": (_INDEX_FORMAT, _all_entries),
}


def tolerant_rows(landing: DataFrame, dataset: str, seen: Observation) -> DataFrame:
    """Bronze rows of a dataset's sound documents.

    While they are computed, ``seen`` counts the documents and the faulty ones (n_documents, n_rejected), so
    that nothing is parsed twice to know.
    """
    form, rows = _DATASET_FORMATS[dataset]
    counted = _checked(landing, form).observe(
        seen, F.count(F.lit(1)).alias("n_documents"), F.count("reason").alias("n_rejected")
    )
    return rows(counted.filter(F.col("reason").isNull()))


def rejected(landing: DataFrame, dataset: str) -> DataFrame:
    """A dataset's faulty documents as they came, each with the reason."""
    found = _checked(landing, _DATASET_FORMATS[dataset][0]).filter(F.col("reason").isNotNull())
    return found.select(*LANDING.names, "reason")
