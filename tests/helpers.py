"""Small builders shared by the tests."""

import json
from datetime import datetime

from candlewick.contracts import LANDING

FETCHED = datetime(2024, 3, 9, 14, 30, 5)
DAY1, DAY2 = 1_704_067_200_000, 1_704_153_600_000  # 2024-01-01 and 2024-01-02, in ms


def landing(spark, *bodies, source="coingecko", dataset="market_chart", entity="bitcoin",
            interval=None, start=0):
    rows = [
        (f"p{start + i}", source, dataset, entity, interval, FETCHED,
         body if isinstance(body, str) else json.dumps(body))
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, LANDING)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def chart_doc(days=(DAY1, DAY2), caps=None, volumes=None):
    return {
        "prices": [[d, 42_000.0 + 1_500.0 * i] for i, d in enumerate(days)],
        "market_caps": [[d, 8.0e11 + 2.0e10 * i] for i, d in enumerate(days if caps is None else caps)],
        "total_volumes": [
            [d, 2.0e10 + 5.0e9 * i] for i, d in enumerate(days if volumes is None else volumes)
        ],
    }


def kline(open_ms, close=43_000.0, span_ms=86_400_000, high=44_000.0, low=41_000.0):
    return [
        open_ms, "42000.5", str(high), str(low), str(close), "1200.25", open_ms + span_ms - 1,
        "5.0E7", 1234, "600.5", "2.5E7", "0",
    ]
