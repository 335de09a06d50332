from datetime import date, datetime

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from candlewick.plans import serving


def price(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "symbol string, date_day date, close double, fear_greed_value int, "
        "volatility_30d_pct double, latest_ingested_at timestamp",
    )


DAY = date(2024, 1, 2)
STAMP = datetime(2024, 1, 3, 4, 5, 6, 789)


def test_kpi_row(spark):
    mart = price(
        spark,
        ("S", date(2024, 1, 1), 1.0, 1, 1.0, STAMP),
        ("S", DAY, 67_432.6, 72, 2.345678, datetime(2024, 1, 1)),
    )
    [row] = serving.kpi_latest(mart).collect()
    assert row.asDict() == {
        "date_day": DAY, "latest_close": "$67,433", "fear_greed": "72", "volatility_30d": "2.35%",
        "latest_ingested": "2024-01-03 04:05:06",
    }


def test_kpi_without_values(spark):
    [row] = serving.kpi_latest(price(spark, ("S", DAY, 1.0, None, None, STAMP))).collect()
    assert (row["fear_greed"], row["volatility_30d"]) == ("n/a", "n/a")


def test_kpi_by_symbol(spark):
    mart = price(spark, ("S", DAY, 1.0, 1, None, STAMP), ("T", DAY, 2.0, None, 1.0, STAMP))
    assert {(r["symbol"], r["latest_close"]) for r in serving.kpi_by_symbol(mart).collect()} == {
        ("S", "$1"), ("T", "$2"),
    }


def test_empty_mart_is_reported(spark):
    mart = price(spark, ("S", DAY, 1.0, 1, 1.0, STAMP))
    assert serving.require_rows(mart, "m") is mart
    with pytest.raises(serving.EmptyMartError, match="m is empty"):
        serving.require_rows(mart.limit(0), "m")


def test_recent_anomalies_is_a_top_k(spark, tmp_path):
    rows = spark.range(40).select(
        F.lit("S").alias("symbol"), F.expr("date_add(DATE '2024-01-01', CAST(id AS INT))").alias("date_day"),
        *(F.lit(1.0).alias(c) for c in ("close", "volume", "volume_z_score", "daily_return_pct")),
        F.lit("Fear").alias("sentiment_label"), (F.col("id") % 2 == 0).alias("is_volume_anomaly"),
    )
    rows.write.parquet(str(tmp_path / "a"))
    top = serving.recent_anomalies(spark.read.parquet(str(tmp_path / "a")))
    assert "TakeOrderedAndProject" in plan_of(top)
    assert [r["date_day"].toordinal() - date(2024, 1, 1).toordinal() for r in top.collect()] == list(
        range(38, 18, -2)
    )


def test_publish_is_idempotent_and_replaces(spark, tmp_path):
    sink = serving.parquet_sink(spark, str(tmp_path))
    mart = price(spark, ("S", DAY, 1.0, 1, 1.0, STAMP), ("T", DAY, 1.0, 1, 1.0, STAMP))
    assert serving.publish({"m": mart}, sink) == {"m": 2}
    assert serving.publish({"m": mart}, sink) == {"m": 2}
    assert serving.publish({"m": mart.limit(1)}, sink) == {"m": 1}
    assert spark.read.parquet(f"{tmp_path}/m").count() == 1


def test_publish_notices_lost_or_repeated_rows(spark):
    mart = price(spark, ("S", DAY, 1.0, 1, 1.0, STAMP))
    with pytest.raises(RuntimeError, match="published 2 rows instead of 1"):
        serving.publish({"m": mart}, (lambda name, rows: None, lambda name: 2))


def test_jdbc_sink_arguments():
    """No database here: the writer and reader calls are recorded instead."""
    calls = []

    class Writer:
        def option(self, *args):
            calls.append(("option", *args))
            return self

        def jdbc(self, url, table, mode, properties):
            calls.append(("write", url, table, mode, properties))

    class Reader:
        def jdbc(self, url, query, properties):
            calls.append(("read", url, query, properties))
            return self

        def first(self):
            return {"n_rows": 3}

    class Stub:
        write = Writer()
        read = Reader()

    replace, count = serving.jdbc_sink(Stub, "jdbc:x", {"user": "u"}, connections=4)
    replace("mart_price_analysis", Stub)
    assert count("mart_price_analysis") == 3
    assert calls == [
        ("option", "numPartitions", 4),
        ("write", "jdbc:x", "public.mart_price_analysis", "overwrite", {"batchsize": "10000", "user": "u"}),
        (
            "read", "jdbc:x",
            "(SELECT count(*) AS n_rows FROM public.mart_price_analysis) AS counted", {"user": "u"},
        ),
    ]


def test_the_kpi_row_of_an_empty_mart_fails(spark):
    columns = "date_day date, symbol string, close double, fear_greed_value int, volatility_30d_pct double, latest_ingested_at timestamp"
    empty = spark.createDataFrame([], columns)
    with pytest.raises(Exception, match="price mart is empty"):
        serving.kpi_latest(empty).collect()
    assert serving.kpi_by_symbol(empty).count() == 0
