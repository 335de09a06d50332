"""Serving: publishing the marts, and the queries a dashboard asks of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.functions.scalar import or_na, percent_text, seconds_text, usd_text

# A sink replaces a named table with a DataFrame and can tell how many rows it holds.
Replace = Callable[[str, DataFrame], None]
Count = Callable[[str], int]


class EmptyMartError(RuntimeError):
    """A mart holds no rows yet."""


# ---------------------------------------------------------------------------------------------
# Publishing
# ---------------------------------------------------------------------------------------------


def jdbc_sink(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    schema: str = "public",
    connections: int = 8,
    batch_rows: int = 10_000,
) -> tuple[Replace, Count]:
    """Tables of a JDBC database; at most ``connections`` tasks write at the same time."""
    options = {"batchsize": str(batch_rows), **properties}

    def replace(name: str, rows: DataFrame) -> None:
        rows.write.option("numPartitions", connections).jdbc(
            url, f"{schema}.{name}", mode="overwrite", properties=options
        )

    def count(name: str) -> int:
        query = f"(SELECT count(*) AS n_rows FROM {schema}.{name}) AS counted"
        return int(spark.read.jdbc(url, query, properties=dict(properties)).first()["n_rows"])

    return replace, count


def parquet_sink(spark: SparkSession, uri: str) -> tuple[Replace, Count]:
    """Tables as Parquet directories below a URI."""

    def replace(name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{uri}/{name}")

    def count(name: str) -> int:
        return spark.read.parquet(f"{uri}/{name}").count()

    return replace, count


def publish(marts: Mapping[str, DataFrame], sink: tuple[Replace, Count]) -> dict[str, int]:
    """Fully replace each mart in the serving store; publishing twice changes nothing.

    The stored row count is compared with the mart's: a JDBC task that is re-run after its
    executor was lost may insert its rows twice, and that must not go unnoticed.
    """
    replace, count = sink

    def load(name: str) -> int:
        expected = marts[name].count()
        replace(name, marts[name])
        stored = count(name)
        if stored != expected:
            raise RuntimeError(f"{name}: published {stored} rows instead of {expected}")
        return stored

    with ThreadPoolExecutor(max_workers=max(len(marts), 1)) as pool:
        return dict(zip(marts, pool.map(load, marts)))


def register_views(
    tables: Mapping[str, DataFrame], names: Mapping[str, str] | None = None
) -> None:
    """Make tables available to ``spark.sql``, under other names where ``names`` gives them."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView((names or {}).get(name, name))


# ---------------------------------------------------------------------------------------------
# Dashboard queries
# ---------------------------------------------------------------------------------------------


def by_day(mart: DataFrame) -> DataFrame:
    """A mart in day order; the symbol as second key lets a day's rows spread over sort ranges."""
    return mart.orderBy(F.col("date_day").asc_nulls_last(), "symbol")


def require_rows(mart: DataFrame, name: str) -> DataFrame:
    if mart.isEmpty():
        raise EmptyMartError(f"{name} is empty: no run has filled it yet")
    return mart


def row_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        for name, rows in marts.items()
    ]
    whole = counts[0]
    for one in counts[1:]:
        whole = whole.unionByName(one)
    return whole


def _kpi_text() -> list[Column]:
    return [
        usd_text(F.col("close")).alias("latest_close"),
        or_na(F.format_number("fear_greed_value", 0)).alias("fear_greed"),
        or_na(percent_text(F.col("volatility_30d_pct"))).alias("volatility_30d"),
        seconds_text(F.col("freshness")).alias("latest_ingested"),
    ]


def kpi_latest(price: DataFrame) -> DataFrame:
    """The KPI row: values of the latest day and the newest ingestion of all, as display text.

    One aggregation without a sort; with several symbols the last symbol of the latest day counts.
    An empty mart has no latest day: the query then fails instead of showing a row of nulls.
    """
    latest = F.struct("date_day", "symbol")
    return price.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("date_day").alias("date_day"),
        F.max_by("close", latest).alias("close"),
        F.max_by("fear_greed_value", latest).alias("fear_greed_value"),
        F.max_by("volatility_30d_pct", latest).alias("volatility_30d_pct"),
        F.max("latest_ingested_at").alias("freshness"),
    ).filter(
        F.expr("IF(n_rows > 0, true, CAST(raise_error('The price mart is empty') AS BOOLEAN))")
    ).select("date_day", *_kpi_text())


def kpi_by_symbol(price: DataFrame) -> DataFrame:
    """The KPI row of every symbol (hash aggregation: the day alone decides within a symbol)."""
    return price.groupBy("symbol").agg(
        F.max("date_day").alias("date_day"),
        F.max_by("close", "date_day").alias("close"),
        F.max_by("fear_greed_value", "date_day").alias("fear_greed_value"),
        F.max_by("volatility_30d_pct", "date_day").alias("volatility_30d_pct"),
        F.max("latest_ingested_at").alias("freshness"),
    ).select("symbol", "date_day", *_kpi_text())


def close_vs_averages(price: DataFrame) -> DataFrame:
    return price.select("symbol", "date_day", "close", "ma7_close", "ma30_close")


def sentiment_vs_return(price: DataFrame) -> DataFrame:
    """Days that have a sentiment value, next to the day's return."""
    return price.dropna(subset=["fear_greed_value"]).select(
        "symbol", "date_day", "fear_greed_value", "daily_return_pct"
    )


def volume_bars(anomalies: DataFrame) -> DataFrame:
    return anomalies.select("symbol", "date_day", "volume", "is_volume_anomaly")


def recent_anomalies(anomalies: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest anomalies (a top-k: each task keeps ``n`` rows, nothing is fully sorted)."""
    return (
        anomalies.filter("is_volume_anomaly")
        .orderBy(F.col("date_day").desc(), F.col("symbol"))
        .select(
            "symbol", "date_day", "close", "volume", "volume_z_score", "daily_return_pct",
            "sentiment_label",
        )
        .limit(n)
    )


def correlation_series(correlation: DataFrame) -> DataFrame:
    return correlation.select("symbol", "date_day", "rolling_30d_sentiment_return_corr")


def sentiment_distribution(mart: DataFrame) -> DataFrame:
    return (
        mart.filter(F.col("sentiment_bucket").isNotNull())
        .groupBy("sentiment_bucket")
        .agg(F.count(F.lit(1)).alias("n_days"))
    )
