"""DuckDB texts of the registered queries: the same results, stated independently in SQL."""

from __future__ import annotations

import re

from candlewick.contracts import SENTIMENT_RANGES
from candlewick.sources.tables import FAULTS


def _bucket(value: str) -> str:
    cases = " ".join(
        f"WHEN {value} BETWEEN {low} AND {high - 1} THEN '{label}'"
        for low, high, label in SENTIMENT_RANGES
    )
    return f"(CASE {cases} ELSE 'Unknown' END)"


def _label(value: str) -> str:
    return f"(CASE WHEN {value} = 100 THEN 'Euphoria' ELSE {_bucket(value)} END)"


def _candles(
    table: str, symbol: str, ts: str, price: str, seq: str, bought: str, unit: str
) -> str:
    interval = {"day": "1d", "hour": "1h"}[unit]
    return f"""
        SELECT symbol, '{interval}' AS "interval", open_time, arg_min(price, seq) AS open,
               max(price) AS high, min(price) AS low, arg_max(price, seq) AS close,
               sum(price) / 4 AS volume, sum(price) AS quote_volume, count(*) AS num_trades,
               coalesce(sum(price) FILTER (bought), 0) AS taker_buy_quote_vol,
               coalesce(sum(price) FILTER (bought), 0) / 4 AS taker_buy_base_vol,
               open_time + INTERVAL 1 {unit} - INTERVAL 1 MILLISECOND AS close_time,
               open_time + INTERVAL 1 {unit} AS ingested_at
        FROM (SELECT CAST({symbol} AS VARCHAR) AS symbol, {seq} AS seq, {bought} AS bought,
                     CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP) AS open_time,
                     CAST(floor({price} + 0.5) AS DOUBLE) AS price
              FROM {table})
        GROUP BY ALL"""


def _orders(symbol: str, unit: str = "day") -> str:
    return _candles(
        "orders", symbol, "o_orderdate", "o_totalprice", "o_orderkey",
        "o_orderpriority IN ('1-URGENT', '2-HIGH')", unit,
    ).replace("GROUP BY ALL", "GROUP BY symbol, open_time")


def _events(unit: str) -> str:
    return _candles(
        "events", "event_type", "ts", "value * 100", "event_id", "user_id % 2 = 0", unit
    ).replace("GROUP BY ALL", "GROUP BY symbol, open_time")


_INDEX = "CAST(floor(l_discount * 1000 + 0.5) AS BIGINT)"

_RUN_DATE = ", ".join(
    f"CAST({part}(ingested_at) AS INTEGER) AS partition_{part}" for part in ("year", "month", "day")
)

_CTES = {
    "candles": _orders("o_orderstatus"),
    "customer_candles": _orders("o_custkey"),
    "candles_1h": _orders("o_orderstatus", "hour"),
    "event_1d": _events("day"),
    "event_1h": _events("hour"),
    "chart": """
        SELECT date_day, CAST(date_day AS TIMESTAMP) AS date, 'basket' AS coin_id,
               floor(turnover / quantity) AS price_usd, turnover AS market_cap_usd,
               quantity AS volume_usd, date_day + INTERVAL 26 HOUR AS ingested_at
        FROM (SELECT CAST(l_shipdate AS DATE) AS date_day, sum(l_quantity) AS quantity,
                     sum(floor(l_extendedprice + 0.5)) AS turnover
              FROM lineitem GROUP BY ALL)""",
    "mood": f"""
        SELECT date_day, CAST(date_day AS TIMESTAMP) AS date, fear_greed_value,
               {_label('fear_greed_value')} AS sentiment_label,
               {_bucket('fear_greed_value')} AS sentiment_bucket,
               date_day + INTERVAL 30 HOUR AS ingested_at
        FROM (SELECT CAST(l_shipdate AS DATE) AS date_day, {_INDEX} AS fear_greed_value,
                     row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
                         ORDER BY l_orderkey DESC, l_linenumber DESC, {_INDEX} DESC) AS nth
              FROM lineitem)
        WHERE nth = 1""",
    "enriched": """
        SELECT CAST(k.open_time AS DATE) AS date_day, k.symbol, k.open, k.high, k.low, k.close,
               k.volume, k.quote_volume, k.num_trades, c.price_usd AS coingecko_price_usd,
               c.market_cap_usd, c.volume_usd AS coingecko_volume_usd, m.fear_greed_value,
               m.sentiment_label, m.sentiment_bucket,
               greatest(k.ingested_at, c.ingested_at, m.ingested_at) AS latest_ingested_at
        FROM candles k
        LEFT JOIN chart c ON c.date_day = CAST(k.open_time AS DATE)
        LEFT JOIN mood m ON m.date_day = CAST(k.open_time AS DATE)""",
    "price": """
        SELECT *, avg(close) OVER (series ROWS 6 PRECEDING) AS ma7_close,
               avg(close) OVER (series ROWS 29 PRECEDING) AS ma30_close,
               stddev_samp(daily_return_pct) OVER (series ROWS 29 PRECEDING) AS volatility_30d_pct
        FROM (SELECT * EXCLUDE (coingecko_price_usd), close - previous AS price_change_usd,
                     100 * (close / nullif(previous, 0) - 1) AS daily_return_pct
              FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date_day) AS previous
                    FROM enriched))
        WINDOW series AS (PARTITION BY symbol ORDER BY date_day)""",
    "mood_corr": """
        SELECT date_day, symbol, close, daily_return_pct, fear_greed_value, sentiment_label,
               sentiment_bucket, latest_ingested_at,
               fear_greed_value - lag(fear_greed_value) OVER series AS sentiment_change,
               lead(daily_return_pct) OVER series AS next_day_return_pct,
               corr(fear_greed_value, daily_return_pct) OVER (series ROWS 29 PRECEDING)
                   AS rolling_30d_sentiment_return_corr
        FROM price WHERE fear_greed_value IS NOT NULL
        WINDOW series AS (PARTITION BY symbol ORDER BY date_day)""",
    "anomalies": """
        SELECT *, (volume - volume_ma30) / nullif(volume_std30, 0) AS volume_z_score,
               coalesce(volume_std30 > 0
                        AND (volume - volume_ma30) / nullif(volume_std30, 0) >= 2, FALSE)
                   AS is_volume_anomaly
        FROM (SELECT date_day, symbol, close, volume, quote_volume, num_trades, daily_return_pct,
                     fear_greed_value, sentiment_label, latest_ingested_at,
                     avg(volume) OVER (series ROWS 29 PRECEDING) AS volume_ma30,
                     stddev_samp(volume) OVER (series ROWS 29 PRECEDING) AS volume_std30
              FROM price
              WINDOW series AS (PARTITION BY symbol ORDER BY date_day))""",
    "candle_ingests": f"""
        SELECT *, open_time + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS close_time,
               {_RUN_DATE}
        FROM (SELECT CAST(l_orderkey AS VARCHAR) AS symbol, '1d' AS "interval",
                     TIMESTAMP '1995-01-01' + to_days(l_linenumber) AS open_time,
                     l_extendedprice AS open, l_extendedprice + l_quantity AS high,
                     l_extendedprice - l_quantity AS low, l_extendedprice + l_tax AS close,
                     l_quantity AS volume, l_extendedprice * l_quantity AS quote_volume,
                     CAST(l_partkey AS INTEGER) AS num_trades, l_quantity / 2 AS taker_buy_base_vol,
                     l_extendedprice / 2 AS taker_buy_quote_vol, l_shipdate AS ingested_at
              FROM lineitem)""",
    "snapshots": f"""
        SELECT CAST(ts AS DATE) AS date_day, date_trunc('hour', ts) AS observed_at,
               event_type AS coin_id, value AS price_usd, value * user_id AS market_cap_usd,
               CAST(user_id AS DOUBLE) AS volume_usd, ts AS ingested_at,
               {_RUN_DATE.replace('ingested_at', 'ts')}
        FROM events""",
    "mood_ingests": f"""
        SELECT *, {_label('fear_greed_value')} AS sentiment_label,
               {_bucket('fear_greed_value')} AS sentiment_bucket,
               {_RUN_DATE}
        FROM (SELECT CAST(l_shipdate AS DATE) AS date_day, CAST({_INDEX} AS INTEGER) AS fear_greed_value,
                     l_shipdate + to_hours(l_linenumber) AS ingested_at
              FROM lineitem)""",
}
_NEEDS = {
    "enriched": ("candles", "chart", "mood"),
    "price": ("enriched",),
    "mood_corr": ("price",),
    "anomalies": ("price",),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        for needed in [*_closure(_NEEDS.get(name, ())), name]:
            if needed not in ordered:
                ordered.append(needed)
    return ordered


def with_tables(names: str, body: str, **replaced: str) -> str:
    """``body`` after the CTEs it names (and theirs); ``replaced`` swaps or adds CTE texts."""
    texts = {**_CTES, **replaced}
    ctes = ",\n".join(f"{name} AS ({texts[name]})" for name in _closure(tuple(names.split())))
    return f"WITH {ctes}\n{body}"


def rounded(columns: str, digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


KLINE_KEYS = 'symbol, "interval", open_time'
KLINE_VALUES = (
    "open, high, low, close, volume, quote_volume, num_trades, taker_buy_base_vol, "
    "taker_buy_quote_vol"
)
RUN_DATE = "partition_year, partition_month, partition_day"
PRICE_KEYS = "date_day, symbol"
CARRIED = "fear_greed_value, sentiment_label, sentiment_bucket"

_NAN_SPLIT = """round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 6) AS {c},
    coalesce(isnan({c}), FALSE) AS corr_is_nan"""
_CORR = _NAN_SPLIT.format(c="rolling_30d_sentiment_return_corr")

PRICE_OUT = (
    f"{PRICE_KEYS}, open, high, low, close, volume, quote_volume, num_trades, market_cap_usd, "
    f"coingecko_volume_usd, {CARRIED}, price_change_usd, latest_ingested_at, "
    + "daily_return_pct, ma7_close, ma30_close"
    + ", "
    + rounded("volatility_30d_pct", 4)
)


def _price(columns: str) -> str:
    return with_tables("price", f"SELECT {PRICE_KEYS}, {columns} FROM price")


def _fetched(rows: str, entity: str, ts: str, page: str) -> str:
    """Rows with the fetch time of the document that carried them."""
    over = f"{entity + ', ' if entity else ''}date_trunc('{page}', {ts})"
    return (
        f"SELECT * EXCLUDE (ingested_at), max(ingested_at) OVER (PARTITION BY {over}) "
        f"AS ingested_at FROM {rows}"
    )


_ONE_CHART_A_MONTH = """(SELECT * FROM ({fetched})
    WHERE NOT (month(date) % 2 = 1 AND day(date) = 1))""".format(
    fetched=_fetched("chart", "coin_id", "date", "month")
)

_CHART_ROWS = 'date, coin_id, price_usd, market_cap_usd, volume_usd, ingested_at'
_KLINE_ROWS = f"{KLINE_KEYS}, close_time, {KLINE_VALUES}, ingested_at"


def _suite(source: str, table: str, rules: list[tuple[str, ...]]) -> str:
    """The row count rule, then one counting query per (rule, column, violation[, severity])."""
    return f"""
        SELECT '{source}' AS source, 'row_count' AS rule, '*' AS "column", 'error' AS severity,
               count(*) AS n_rows, CAST(count(*) = 0 AS BIGINT) AS n_bad
        FROM {table}
        UNION ALL {_model(source, table, rules)}"""


def _model(source: str, table: str, rules: list[tuple[str, ...]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{rule}' AS rule, '{column}' AS \"column\", "
        f"'{(severity or ['error'])[0]}' AS severity, count(*) AS n_rows, "
        f"count(*) FILTER ({bad}) AS n_bad FROM {table}"
        for rule, column, bad, *severity in rules
    )


def _nulls(columns: str) -> list[tuple[str, str, str]]:
    return [("not_null", c, f'"{c}" IS NULL') for c in columns.split()]


_LABELS = "(" + ", ".join(f"'{label}'" for _, _, label in SENTIMENT_RANGES) + ")"

def _kline_suite(table: str, symbols: str, interval: str) -> str:
    return _suite("binance", table, [
        ("in_set", "symbol", f"symbol NOT IN ({symbols})"),
        ("in_set", "interval", f"\"interval\" NOT IN ('{interval}')"),
        *_nulls("open"),
        ("positive", "open", "open <= 0"),
        ("positive", "high", "high <= 0"),
        ("positive", "low", "low <= 0"),
        *_nulls("close"),
        ("positive", "close", "close <= 0"),
        ("at_least", "high,low", "high < low"),
        *_nulls("volume"),
        ("between", "volume", "volume < 0"),
    ])


_KLINE_SUITE = _kline_suite("candles", "'F', 'O'", "1d")
_CHART_SUITE = _suite("coingecko", "chart", [
    *_nulls("date coin_id"),
    ("in_set", "coin_id", "coin_id NOT IN ('basket')"),
    *_nulls("price_usd"),
    ("positive", "price_usd", "price_usd <= 0"),
    *_nulls("volume_usd"),
    ("between", "volume_usd", "volume_usd < 0"),
    ("between", "market_cap_usd", "market_cap_usd < 0"),
])
_MOOD_SUITE = _suite("feargreed", "shifted", [
    *_nulls("date_day fear_greed_value"),
    ("between", "fear_greed_value", "fear_greed_value < 0 OR fear_greed_value > 100"),
    ("in_set", "sentiment_bucket", f"sentiment_bucket NOT IN {_LABELS}"),
    *_nulls("sentiment_label"),
]).replace("'date_day'", "'date'")

_SHIFTED = f"""
    SELECT * EXCLUDE (fear_greed_value, sentiment_bucket), shifted AS fear_greed_value,
           {_bucket('shifted')} AS sentiment_bucket
    FROM (SELECT *, fear_greed_value + (date_part('hour', ingested_at) - 2) * 20 AS shifted
          FROM mood_ingests)"""

_SUITES = f"""SELECT *, n_bad = 0 AS success, CASE source WHEN 'binance' THEN 'klines_1d'
        WHEN 'coingecko' THEN 'market_chart' ELSE 'index' END AS dataset
    FROM ({_KLINE_SUITE} UNION ALL {_CHART_SUITE} UNION ALL {_MOOD_SUITE})"""


def _gated(interval: str, table: str) -> str:
    """The candle suite over one stored run; the SQL of a positive or bounded check passes nulls."""
    suite = _kline_suite(table, "'F', 'O', 'P'", interval)
    return f"""
        SELECT *, n_bad = 0 AS success, 'klines_{interval}' AS dataset,
               'bronze/binance/klines_{interval}/year=2024/month=03/day=09/klines_{interval}'
                   || '_20240309_083000.parquet' AS path
        FROM ({suite})"""


_FAULTY_HOURS = """
    SELECT * REPLACE (close - 100000 AS close,
                      CASE WHEN num_trades > 1 THEN low - 1 ELSE high END AS high,
                      CASE WHEN volume > 100 THEN NULL ELSE volume END AS volume)
    FROM candles_1h"""

_SILVER_KLINES = f"""
    SELECT {KLINE_KEYS}, close, volume, quote_volume FROM candles
    UNION ALL SELECT {KLINE_KEYS}, close, volume, quote_volume FROM event_1h"""


def _set_check(source: str, rule: str, column: str, n_bad: str, severity: str = "error") -> str:
    return (
        f"SELECT '{source}', '{rule}', '{column}', '{severity}', CAST(NULL AS BIGINT), "
        f"CAST(({n_bad}) AS BIGINT)"
    )


def _repeats(table: str, keys: str) -> str:
    quoted = ", ".join(f'"{k}"' for k in keys.split(","))
    return (
        f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {quoted} HAVING count(*) > 1)"
    )


def _orphans(child: str, parent: str) -> str:
    return (
        f"SELECT count(*) FROM {child} WHERE date_day IS NOT NULL "
        f"AND date_day NOT IN (SELECT date_day FROM {parent} WHERE date_day IS NOT NULL)"
    )


_OUTPUT_TESTS = " UNION ALL ".join([
    _model("silver_market_chart", "chart", _nulls("date_day coin_id price_usd volume_usd")),
    _model("silver_klines", "silver_klines", [
        *_nulls("open_time symbol interval close volume"),
        ("in_set", "interval", "\"interval\" NOT IN ('1d', '1h')"),
        ("plausible", "close,volume,quote_volume", "close <= 0 OR volume < 0 OR quote_volume < 0"),
    ]),
    _model("silver_sentiment", "mood", [
        *_nulls("date_day fear_greed_value sentiment_label sentiment_bucket"),
        ("in_set", "sentiment_label", f"sentiment_label NOT IN {_LABELS}", "warn"),
        ("in_set", "sentiment_bucket", f"sentiment_bucket NOT IN {_LABELS}"),
        ("between", "fear_greed_value", "fear_greed_value NOT BETWEEN 0 AND 100"),
    ]),
    _model("daily_enriched", "enriched", _nulls("date_day symbol close")),
    _model("mart_price_analysis", "price", _nulls("date_day symbol close")),
    _model("mart_sentiment_correlation", "mood_corr", _nulls("date_day symbol")),
    _model("mart_volume_anomalies", "anomalies", _nulls("date_day symbol is_volume_anomaly")),
    _set_check("silver_sentiment", "unique", "date_day", _repeats("mood WHERE date_day IS NOT NULL", "date_day")),
    _set_check("silver_klines", "grain", "symbol,interval,open_time",
               _repeats("silver_klines", "symbol,interval,open_time")),
    _set_check("silver_market_chart", "grain", "coin_id,date_day",
               _repeats("chart", "coin_id,date_day")),
    _set_check("daily_enriched", "grain", "symbol,date_day", _repeats("enriched", "symbol,date_day")),
    _set_check("mart_price_analysis", "grain", "symbol,date_day",
               _repeats("price", "symbol,date_day")),
    _set_check("mart_price_analysis", "relationships", "date_day", _orphans("price", "enriched")),
    _set_check("mart_sentiment_correlation", "relationships", "date_day",
               _orphans("mood_corr", "price")),
    _set_check("mart_volume_anomalies", "relationships", "date_day", _orphans("anomalies", "price")),
    _set_check("mart_price_analysis", "freshness", "date_day",
               "SELECT count(*) FROM (SELECT max(date_day) AS d FROM price) "
               "WHERE d < DATE '2001-12-31' - 3", "warn"),
])

# The tables of the output tests with the faults that ``tables.FAULTS`` describes.
_FAULTY_TABLES = {
    "silver_market_chart": "chart", "silver_klines": "silver_klines", "silver_sentiment": "mood",
    "daily_enriched": "enriched", "mart_price_analysis": "price", "mart_sentiment_correlation": "mood_corr",
    "mart_volume_anomalies": "anomalies",
}
_MORE_FAULTS = {
    "silver_sentiment": {"fear_greed_value": "WHEN nth = 3 THEN 150", "sentiment_bucket": "WHEN nth = 6 THEN 'Odd'"},
    "silver_klines": {"interval": "WHEN nth = 4 THEN '9x'", "volume": "WHEN nth = 7 THEN NULL"},
}


def _faulty(name: str) -> str:
    day, wrong, repeated, removed = FAULTS[name]
    rows = f"SELECT *, date_part('day', {day}) AS nth FROM {_FAULTY_TABLES[name]}"
    if removed is not None:
        rows = f"SELECT * FROM ({rows}) WHERE nth <> {removed}"
    if repeated is not None:
        rows = f"SELECT * FROM ({rows}) UNION ALL SELECT * FROM ({rows}) WHERE nth = {repeated}"
    more = _MORE_FAULTS.get(name, {})
    replaced = ", ".join(
        f'CASE WHEN nth = {n} THEN {value.rstrip("D")} {more.get(c, "")} ELSE "{c}" END AS "{c}"'
        for c, (n, value) in wrong.items()
    )
    return f"SELECT * REPLACE ({replaced}) FROM ({rows})"


_OUTPUT_FAILURES = re.sub(
    rf"\bFROM ({'|'.join(sorted(_FAULTY_TABLES.values(), key=len, reverse=True))})\b", r"FROM faulty_\1", _OUTPUT_TESTS
)

_KPI = """
    '$' || format('{:,.0f}', close) AS latest_close,
    coalesce(format('{:.0f}', CAST(fear_greed_value AS DOUBLE)), 'n/a') AS fear_greed,
    coalesce(format('{:.2f}%', volatility_30d_pct), 'n/a') AS volatility_30d,
    strftime(freshness, '%Y-%m-%d %H:%M:%S') AS latest_ingested"""

_ISO = """strftime(event_at, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN date_part('microseconds', event_at) % 1000000 = 0 THEN ''
            ELSE '.' || strftime(event_at, '%f') END || '+00:00'"""
_TICKS = """SELECT upper(event_type) AS symbol, value AS price, user_id / 8 AS quantity,
    date_trunc('milliseconds', ts) AS event_at, event_id AS trade_id, user_id % 2 = 0 AS is_buyer_maker
    FROM events"""

_DEDUP_KLINES = f"""
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (PARTITION BY {KLINE_KEYS} ORDER BY ingested_at DESC,
            close_time DESC, open DESC, high DESC, low DESC, close DESC, volume DESC,
            quote_volume DESC, num_trades DESC, taker_buy_base_vol DESC,
            taker_buy_quote_vol DESC) AS nth
        FROM candle_ingests)
    WHERE nth = 1"""
_DEDUP_CHART = """
    SELECT * EXCLUDE (nth, observed_at) FROM (
        SELECT *, row_number() OVER (PARTITION BY coin_id, date_day
            ORDER BY observed_at DESC, ingested_at DESC, price_usd DESC, market_cap_usd DESC,
                     volume_usd DESC) AS nth
        FROM snapshots)
    WHERE nth = 1"""
_DEDUP_MOOD = """
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (PARTITION BY date_day ORDER BY ingested_at DESC,
            fear_greed_value DESC, sentiment_label DESC) AS nth
        FROM mood_ingests)
    WHERE nth = 1"""

# The daily run reads its inputs from monthly documents: a document's fetch time is the ingestion
# time of all its rows, and odd months lack the first day's market data.
_RUN_TABLES = {
    "base_candles": _CTES["candles"],
    "candles": _fetched("base_candles", "symbol", "open_time", "month"),
    "base_chart": _CTES["chart"],
    "chart": _fetched("base_chart", "coin_id", "date", "month").join(
        ("SELECT * FROM (", ") WHERE NOT (month(date) % 2 = 1 AND day(date) = 1)")
    ),
    "base_mood": _CTES["mood"],
    "mood": _fetched("base_mood", "", "date", "month"),
}

_R = "rolling_30d_sentiment_return_corr"
# Ticks that the staged streams take in, and bars that are out at their end: the held-back ticks come when
# all of theirs are out, and a bar is out once the newest tick is two hours beyond its end.
_CUT = "TIMESTAMP '2024-01-20'"
_HELD_BACK = "trade_id % 10 = 0 AND event_at < TIMESTAMP '2024-01-10'"
_ON_TIME = f"SELECT * FROM ({_TICKS}) WHERE NOT ({_HELD_BACK})"
_CLOSED = """date_trunc('hour', event_at) + INTERVAL 1 HOUR
    <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""

ORACLES: dict[str, str] = {
    "price_analysis": with_tables("price", f"SELECT {PRICE_OUT} FROM price"),
    "price_analysis_many_symbols": with_tables(
        "price", f"SELECT {PRICE_OUT} FROM price", candles=_CTES["customer_candles"]
    ),
    "daily_enriched": with_tables(
        "enriched",
        "SELECT * FROM enriched",
    ),
    "daily_enriched_by_coin": with_tables(
        "candles mood", """
        SELECT CAST(k.open_time AS DATE) AS date_day, k.symbol, k.open, k.high, k.low, k.close,
               k.volume, k.quote_volume, k.num_trades,
               floor(c.turnover / c.quantity) AS coingecko_price_usd,
               c.turnover AS market_cap_usd, c.quantity AS coingecko_volume_usd,
               m.fear_greed_value, m.sentiment_label, m.sentiment_bucket,
               greatest(k.ingested_at, c.date_day + INTERVAL 26 HOUR, m.ingested_at)
                   AS latest_ingested_at
        FROM candles k
        LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS date_day, l_returnflag,
                          sum(l_quantity) AS quantity,
                          sum(floor(l_extendedprice + 0.5)) AS turnover
                   FROM lineitem GROUP BY ALL) c
            ON c.date_day = CAST(k.open_time AS DATE)
            AND c.l_returnflag = CASE k.symbol WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END
        LEFT JOIN mood m ON m.date_day = CAST(k.open_time AS DATE)""",
    ),
    "sentiment_correlation": with_tables(
        "mood_corr",
        f"SELECT {PRICE_KEYS}, close, {CARRIED}, sentiment_change, latest_ingested_at, "
        f"daily_return_pct, next_day_return_pct, {_CORR} FROM mood_corr",
    ),
    "volume_anomalies": with_tables(
        "anomalies",
        f"SELECT {PRICE_KEYS}, close, volume, quote_volume, num_trades, fear_greed_value, "
        f"sentiment_label, is_volume_anomaly, latest_ingested_at, "
        f"daily_return_pct, volume_ma30, {rounded('volume_std30 volume_z_score', 4)} "
        "FROM anomalies",
    ),
    "day_over_day_change": _price("price_change_usd"),
    "daily_return_pct": _price("daily_return_pct"),
    "moving_average_7": _price("ma7_close"),
    "moving_average_30": _price("ma30_close"),
    "volatility_30": _price(rounded("volatility_30d_pct", 4)),
    "sentiment_change": with_tables(
        "mood_corr", f"SELECT {PRICE_KEYS}, sentiment_change FROM mood_corr"
    ),
    "next_day_return": with_tables(
        "mood_corr", f"SELECT {PRICE_KEYS}, next_day_return_pct FROM mood_corr"
    ),
    "rolling_corr_30": with_tables("mood_corr", f"SELECT {PRICE_KEYS}, {_CORR} FROM mood_corr"),
    "volume_zscore": with_tables(
        "anomalies",
        f"SELECT {PRICE_KEYS}, {rounded('volume_z_score', 4)}, is_volume_anomaly FROM anomalies",
    ),
    "dedup_klines": with_tables(
        "candle_ingests",
        f"SELECT {_KLINE_ROWS}, {RUN_DATE} FROM ({_DEDUP_KLINES})",
    ),
    "dedup_latest_in_day": with_tables("snapshots", _DEDUP_CHART),
    "dedup_sentiment": with_tables("mood_ingests", _DEDUP_MOOD),
    "union_intervals": with_tables(
        "event_1d event_1h",
        f"SELECT {_KLINE_ROWS} FROM event_1d UNION ALL SELECT {_KLINE_ROWS} FROM event_1h",
    ),
    "typed_projection": with_tables(
        "candle_ingests", f"SELECT {_KLINE_ROWS}, {RUN_DATE} FROM candle_ingests"
    ),
    "sentiment_bucket": f"""
        SELECT value, {_bucket('value')} AS bucket, count(*) AS n_rows
        FROM (SELECT {_INDEX} + (l_linenumber - 2) * 20 AS value FROM lineitem) GROUP BY ALL""",
    "json_field_access": """
        SELECT event_type, count(*) AS n_rows,
               CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
        FROM events GROUP BY event_type""",
    "epoch_millis": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
               epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS millis
        FROM orders""",
    "parse_klines_payload": with_tables(
        "event_1h",
        f"SELECT {_KLINE_ROWS} FROM ({_fetched('event_1h', 'symbol', 'open_time', 'day')})",
    ),
    "kline_page_coverage": with_tables("event_1h", """
        , pages AS (
            SELECT 'klines_1h/' || symbol || '/' || strftime(date_trunc('day', open_time),
                       '%Y-%m-%d 00:00:00') AS payload_id, symbol, "interval",
                   CAST(count(*) AS INTEGER) AS n_bars, min(open_time) AS first_open, max(close_time) AS last_close
            FROM event_1h GROUP BY symbol, "interval", date_trunc('day', open_time))
        SELECT *, NOT is_last AND NOT EXISTS (
                   SELECT 1 FROM pages n WHERE n.symbol = p.symbol
                   AND n.first_open = p.last_close + INTERVAL 1 MILLISECOND) AS is_broken
        FROM (SELECT *, n_bars < 24 OR last_close >= TIMESTAMP '2024-01-30 00:00:00' AS is_last
              FROM pages) p"""),
    "parse_market_chart_payload": with_tables(
        "chart",
        f"""SELECT {_CHART_ROWS} FROM {_ONE_CHART_A_MONTH} UNION ALL
        SELECT * REPLACE (price_usd + 1 AS price_usd) FROM (SELECT {_CHART_ROWS} FROM {_ONE_CHART_A_MONTH})
        WHERE month(date) = 6 AND day(date) = 1""",
    ),
    "parse_ohlc_payload": with_tables(
        "candles",
        "SELECT open, high, low, close, open_time AS date, symbol AS coin_id, ingested_at "
        f"FROM ({_fetched('candles', 'symbol', 'open_time', 'month')})",
    ),
    "parse_index_payload": with_tables(
        "mood", "SELECT date, fear_greed_value, sentiment_label, sentiment_bucket, ingested_at "
        f"FROM ({_fetched('mood', '', 'date', 'month')})",
    ),
    "latest_index_entry": with_tables(
        "mood", "SELECT date, fear_greed_value, sentiment_label, sentiment_bucket, ingested_at "
        "FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('month', date) "
        "ORDER BY date DESC) AS nth FROM mood) WHERE nth = 1",
    ),
    "parse_metadata_payload": """
        SELECT CAST(p_partkey AS VARCHAR) AS coin_id, p_name AS name, p_brand AS symbol,
               CASE WHEN p_size % 3 != 0 THEN printf('2009-01-%02d', p_size % 28 + 1) END
                   AS genesis_date,
               CASE WHEN p_size % 2 = 0 THEN p_type END AS hashing_algorithm,
               CAST(CASE WHEN p_size % 5 != 0 THEN p_size END AS BIGINT) AS market_cap_rank,
               TIMESTAMP '2024-01-01' AS fetched_at
        FROM part""",
    "logical_date_slice": """
        SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-03-09'""",
    "kline_run_window": with_tables(
        "event_1h",
        f"SELECT {_KLINE_ROWS} FROM event_1h WHERE open_time BETWEEN TIMESTAMP '2024-01-15' "
        "AND TIMESTAMP '2024-01-16'",
    ),
    "gap_detection": with_tables("candles", """
        SELECT symbol, CAST(day AS DATE) AS date_day
        FROM (SELECT symbol, unnest(generate_series(min(open_time), max(open_time),
                                                    INTERVAL 1 DAY)) AS day
              FROM candles GROUP BY symbol) calendar
        WHERE NOT EXISTS (SELECT 1 FROM candles c
                          WHERE c.symbol = calendar.symbol AND c.open_time = calendar.day)"""),
    "series_coverage": with_tables("customer_candles", """
        SELECT symbol, CAST(min(open_time) AS DATE) AS first_day,
               CAST(max(open_time) AS DATE) AS last_day, count(*) AS n_rows,
               date_diff('day', min(open_time), max(open_time)) + 1 - count(*) AS n_missing
        FROM customer_candles GROUP BY symbol"""),
    "grain_check": with_tables("candle_ingests", f"""
        SELECT {KLINE_KEYS}, count(*) AS n_rows FROM candle_ingests GROUP BY {KLINE_KEYS}
        HAVING count(*) > 1"""),
    "relationships_check": with_tables("candles chart", """
        SELECT CAST(open_time AS DATE) AS date_day, count(*) AS n_rows FROM candles
        WHERE CAST(open_time AS DATE) NOT IN (SELECT date_day FROM chart) GROUP BY ALL"""),
    "null_counts": with_tables("candle_ingests", " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", count(*) AS n_rows, "
        f"count(*) FILTER ({missing}) AS n_null FROM candle_ingests"
        for column, missing in {
            "open_time": "open_time IS NULL", "close_time": "close_time IS NULL",
            "symbol": "symbol IS NULL", "open": "volume < 3", "close": "volume < 5",
            "ingested_at": "ingested_at IS NULL",
        }.items()
    )),
    "freshness_check": with_tables("price", """
        SELECT max(date_day) AS latest_day, DATE '2001-12-31' AS today FROM price
        HAVING max(date_day) < DATE '2001-12-31' - 3"""),
    "range_check": with_tables("mood_ingests shifted", """
        SELECT date_day, CAST(fear_greed_value AS BIGINT) AS fear_greed_value, sentiment_bucket,
               ingested_at
        FROM shifted WHERE fear_greed_value < 0 OR fear_greed_value > 100""", shifted=_SHIFTED),
    "positive_check": with_tables("candle_ingests", f"""
        SELECT {KLINE_KEYS}, close, quote_volume, volume, ingested_at
        FROM (SELECT * REPLACE (close - 20000 AS close, volume - 5 AS volume) FROM candle_ingests)
        WHERE close <= 0 OR volume < 0 OR quote_volume < 0"""),
    "suite_results": with_tables("candles chart mood_ingests shifted", _SUITES, shifted=_SHIFTED),
    "gate_failures": with_tables(
        "candles candles_1h faulty_hours",
        f"{_gated('1d', 'candles')} UNION ALL {_gated('1h', 'faulty_hours')}",
        faulty_hours=_FAULTY_HOURS,
    ),
    "gate_outcomes": with_tables("candles chart mood_ingests shifted", f"""
        SELECT source, dataset, count(*) FILTER (NOT success AND severity = 'error') = 0 AS success,
               count(*) FILTER (NOT success AND severity = 'error') AS n_failed,
               count(*) FILTER (NOT success AND severity = 'warn') AS n_warned
        FROM ({_SUITES}) GROUP BY source, dataset""", shifted=_SHIFTED),
    "output_test_failures": with_tables(
        "candles event_1h silver_klines mood_corr anomalies " + " ".join(f"faulty_{t}" for t in _FAULTY_TABLES.values()),
        f"SELECT *, n_bad = 0 AS success FROM ({_OUTPUT_FAILURES})",
        silver_klines=_SILVER_KLINES,
        **{f"faulty_{table}": _faulty(name) for name, table in _FAULTY_TABLES.items()},
    ),
    "suite_lookup": with_tables(
        "candle_ingests coin_charts mood_ingests shifted",
        "SELECT *, n_bad = 0 AS success FROM ("
        + _kline_suite("candle_ingests", "'1', '2', '3'", "1d")
        + " UNION ALL " + _CHART_SUITE.replace("FROM chart", "FROM coin_charts").replace("('basket')", "('A', 'N')")
        + " UNION ALL " + _MOOD_SUITE + ")",
        shifted=_SHIFTED,
        coin_charts="""
            SELECT date_day, date_day AS date, coin_id, floor(turnover / quantity) AS price_usd,
                   turnover AS market_cap_usd, quantity AS volume_usd
            FROM (SELECT CAST(l_shipdate AS DATE) AS date_day, l_returnflag AS coin_id, sum(l_quantity) AS quantity,
                         sum(floor(l_extendedprice + 0.5)) AS turnover FROM lineitem GROUP BY ALL)""",
    ),
    "quarantined_documents": with_tables("candles candles_1h chart mood", """
        SELECT 'klines_1d' AS dataset, 'stored' AS reason, count(*) AS n_rows FROM candles
        WHERE month(open_time) NOT IN (4, 5, 6)
        UNION ALL SELECT 'klines_1d', CASE month(open_time) WHEN 4 THEN 'Malformed body'
            WHEN 5 THEN 'Invalid interval: 7d' ELSE 'Short bar' END,
            count(DISTINCT (symbol, date_trunc('month', open_time)))
        FROM candles WHERE month(open_time) IN (4, 5, 6) GROUP BY month(open_time)
        UNION ALL SELECT 'klines_1h', 'stored', count(*) FROM candles_1h
        UNION ALL SELECT 'market_chart', 'stored', count(*) FROM chart
        WHERE month(date) <> 2 AND NOT (month(date) % 2 = 1 AND day(date) = 1)
        UNION ALL SELECT 'market_chart', 'Missing key ' || chr(39) || 'market_caps' || chr(39),
            count(DISTINCT date_trunc('month', date)) FROM chart WHERE month(date) = 2
        UNION ALL SELECT 'index', 'stored', count(*) FROM mood WHERE month(date) NOT IN (7, 8)
        UNION ALL SELECT 'index', CASE month(date) WHEN 7 THEN 'Bad number' ELSE 'Malformed body' END,
            count(DISTINCT date_trunc('month', date)) FROM mood WHERE month(date) IN (7, 8) GROUP BY month(date)"""),
    "output_test_results": with_tables(
        "mood_corr anomalies event_1h silver_klines",
        f"SELECT *, n_bad = 0 AS success FROM ({_OUTPUT_TESTS})",
        silver_klines=_SILVER_KLINES,
    ),
    "kpi_latest": with_tables("price", f"""
        SELECT date_day, {_KPI} FROM (
            SELECT *, max(latest_ingested_at) OVER () AS freshness FROM price)
        ORDER BY date_day DESC, symbol DESC LIMIT 1"""),
    "kpi_by_symbol": with_tables("price", f"""
        SELECT symbol, date_day, {_KPI} FROM (
            SELECT *, max(latest_ingested_at) OVER (PARTITION BY symbol) AS freshness,
                   row_number() OVER (PARTITION BY symbol ORDER BY date_day DESC) AS nth
            FROM price) WHERE nth = 1""", candles=_CTES["customer_candles"]),
    "close_vs_ma_series": _price("close, " + "ma7_close, ma30_close"),
    "sentiment_vs_return_series": with_tables("price", f"""
        SELECT {PRICE_KEYS}, fear_greed_value, daily_return_pct FROM price
        WHERE fear_greed_value IS NOT NULL"""),
    "volume_anomaly_series": with_tables(
        "anomalies", f"SELECT {PRICE_KEYS}, volume, is_volume_anomaly FROM anomalies"
    ),
    "recent_anomalies": with_tables("anomalies", f"""
        SELECT symbol, date_day, close, volume, {rounded('volume_z_score', 4)},
               daily_return_pct, sentiment_label
        FROM anomalies WHERE is_volume_anomaly ORDER BY date_day DESC, symbol LIMIT 10"""),
    "rolling_corr_series": with_tables("mood_corr", f"SELECT {PRICE_KEYS}, {_CORR} FROM mood_corr"),
    "sentiment_distribution": with_tables("price", """
        SELECT sentiment_bucket, count(*) AS n_days FROM price
        WHERE sentiment_bucket IS NOT NULL GROUP BY sentiment_bucket"""),
    "mart_by_day": with_tables("price", f"SELECT {PRICE_OUT} FROM price ORDER BY date_day"),
    "mart_row_counts": with_tables("mood_corr anomalies", """
        SELECT 'mart_price_analysis' AS mart, count(*) AS n_rows FROM price
        UNION ALL SELECT 'mart_sentiment_correlation', count(*) FROM mood_corr
        UNION ALL SELECT 'mart_volume_anomalies', count(*) FROM anomalies"""),
    "bronze_roundtrip": with_tables("candles", f"""
        SELECT {_KLINE_ROWS}, 2024 AS year, 3 AS month, 9 AS day FROM candles
        UNION ALL SELECT {_KLINE_ROWS}, 2024, 3, 9 FROM candles
        UNION ALL SELECT {_KLINE_ROWS}, 2024, 12, 31 FROM candles"""),
    "schema_drift_read": with_tables("mood", """
        SELECT date, fear_greed_value, sentiment_label, sentiment_bucket, ingested_at,
               2024 AS year, 3 AS month, 9 AS day FROM mood
        UNION ALL SELECT date, fear_greed_value, sentiment_label, sentiment_bucket, ingested_at,
               2024, 3, 10 FROM mood
        UNION ALL SELECT date, NULL, sentiment_label, NULL, ingested_at, 2024, 3, 11 FROM mood"""),
    "serving_publish": with_tables("mood_corr anomalies", """
        SELECT 'mart_price_analysis' AS mart, count(*) AS n_rows FROM price
        UNION ALL SELECT 'mart_sentiment_correlation', count(*) FROM mood_corr
        UNION ALL SELECT 'mart_volume_anomalies', count(*) FROM anomalies"""),
    "run_summary": with_tables("candles candles_1h chart mood", """
        SELECT source, dataset, 'PASS' AS status, n AS row_count, lo AS min_time, hi AS max_time,
               'bronze/' || source || '/' || dataset || '/year=2002/month=01/day=02/' || dataset
                   || '_20020102_030405.parquet' AS path, CAST(0 AS INTEGER) AS n_errors
        FROM (SELECT 'coingecko' AS source, 'market_chart' AS dataset, count(*) AS n,
                     min(date) AS lo, max(date) AS hi
              FROM chart WHERE NOT (month(date) % 2 = 1 AND day(date) = 1)
              UNION ALL SELECT 'binance', 'klines_1d', count(*), min(open_time), max(open_time)
              FROM candles
              UNION ALL SELECT 'binance', 'klines_1h', count(*), min(open_time), max(open_time)
              FROM candles_1h
              UNION ALL SELECT 'feargreed', 'index', count(*), min(date), max(date) FROM mood)"""),
    "daily_run": with_tables(
        "base_candles base_chart base_mood price",
        "SELECT * REPLACE (CAST(num_trades AS INTEGER) AS num_trades, "
        "CAST(fear_greed_value AS INTEGER) AS fear_greed_value) "
        f"FROM (SELECT {PRICE_OUT} FROM price)",
        **_RUN_TABLES,
    ),
    "tick_parse": f"SELECT * EXCLUDE (event_at), event_at AS event_time FROM ({_TICKS})",
    "tick_parse_stream": f"SELECT * EXCLUDE (event_at), event_at AS event_time FROM ({_TICKS})",
    "tick_publish_stream": f"""
        SELECT symbol AS key, symbol, price, quantity, {_ISO} AS event_time, trade_id,
               is_buyer_maker
        FROM ({_TICKS})""",
    "unique_ticks_stream": f"SELECT * EXCLUDE (event_at), event_at AS event_time FROM ({_ON_TIME})",
    "tick_bars_stream": f"""
        SELECT symbol, date_trunc('hour', event_at) AS open_time,
               date_trunc('hour', event_at) + INTERVAL 1 HOUR AS close_time,
               arg_min(price, (event_at, trade_id)) AS open, max(price) AS high, min(price) AS low,
               arg_max(price, (event_at, trade_id)) AS close, sum(quantity) AS volume,
               count(*) AS num_trades, sum(CASE WHEN is_buyer_maker THEN 0 ELSE quantity END) AS taker_buy_base_vol
        FROM ({_ON_TIME}) WHERE {_CLOSED} GROUP BY symbol, date_trunc('hour', event_at)""",
    "late_ticks_stream": f"""
        SELECT symbol, date_trunc('hour', event_at) AS open_time, CAST(sum(n_lost) AS BIGINT) AS n_late
        FROM (SELECT *, CASE WHEN {_HELD_BACK} THEN 1 WHEN event_at < {_CUT} AND trade_id % 7 = 0 THEN 1 ELSE 0 END
                  AS n_lost FROM ({_TICKS}))
        WHERE {_CLOSED} GROUP BY symbol, date_trunc('hour', event_at) HAVING sum(n_lost) > 0""",
    "incremental_marts": with_tables(
        "base_candles base_chart base_mood mood_corr anomalies",
        f"""SELECT * REPLACE (CAST(num_trades AS INTEGER) AS num_trades,
                CAST(fear_greed_value AS INTEGER) AS fear_greed_value)
            FROM (SELECT {PRICE_OUT} FROM price)
            LEFT JOIN (SELECT date_day, symbol, CAST(sentiment_change AS INTEGER) AS sentiment_change,
                              next_day_return_pct, round(CASE WHEN isnan({_R}) THEN NULL ELSE {_R} END, 6) AS {_R},
                              isnan({_R}) AS undefined FROM mood_corr) USING (date_day, symbol)
            LEFT JOIN (SELECT date_day, symbol, volume_ma30, round(volume_z_score, 4) AS volume_z_score,
                              is_volume_anomaly FROM anomalies) USING (date_day, symbol)""",
        base_candles=_CTES["candles"],
        candles="""SELECT * REPLACE (CASE WHEN fixed THEN close + 11 ELSE close END AS close,
                CASE WHEN fixed THEN volume * 3 ELSE volume END AS volume,
                CASE WHEN fixed THEN TIMESTAMP '2002-01-04' ELSE ingested_at END AS ingested_at)
            FROM (SELECT *, CAST(open_time AS DATE) IN (DATE '1995-03-15', DATE '1996-08-02') AS fixed
                  FROM base_candles)""",
        base_chart=_CTES["chart"],
        chart="""SELECT * REPLACE (CASE WHEN fixed THEN 1 ELSE market_cap_usd END AS market_cap_usd,
                CASE WHEN fixed THEN TIMESTAMP '2002-01-05' ELSE ingested_at END AS ingested_at)
            FROM (SELECT *, date_day = DATE '1993-02-01' AS fixed FROM base_chart)""",
        base_mood=_CTES["mood"],
        mood="""SELECT * REPLACE (CASE WHEN fixed THEN 7 ELSE fear_greed_value END AS fear_greed_value,
                CASE WHEN fixed THEN TIMESTAMP '2002-01-04' ELSE ingested_at END AS ingested_at)
            FROM (SELECT *, date_day BETWEEN DATE '1994-05-05' AND DATE '1994-05-10' AS fixed FROM base_mood)""",
    ).replace("undefined FROM", "corr_is_nan FROM").replace(
        "SELECT * REPLACE (CAST(num_trades", "SELECT * REPLACE (coalesce(corr_is_nan, FALSE) AS corr_is_nan, CAST(num_trades", 1
    ),
}
