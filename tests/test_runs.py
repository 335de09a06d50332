from datetime import date, datetime
from pathlib import Path

import pandas as pd
import pytest
from helpers import DAY1, DAY2, chart_doc, kline, landing, plan_of
from pyspark.sql import functions as F

from candlewick.config import dataset_uri, table_uri
from candlewick.contracts import MARTS, dataset_spec
from candlewick.operators.quality import QualityGateError, Suite
from candlewick.plans import runs, serving
from candlewick.sources import bronze, files
from candlewick.sources.drift import read_drifted

RUN = datetime(2024, 1, 2, 8, 30)
INDEX = {
    "data": [
        {"value": "72", "value_classification": "Greed", "timestamp": str(DAY2 // 1000)},
        {"value": "20", "value_classification": "Extreme Fear", "timestamp": str(DAY1 // 1000)},
    ]
}


def all_payloads(spark, chart=None, index=None, daily=None):
    hour = 3_600_000
    daily = [kline(DAY1, 41_500.0), kline(DAY2, 43_000.0)] if daily is None else daily
    hours = [kline(DAY2 + i * hour, span_ms=hour) for i in range(3)]
    binance = dict(source="binance", entity="BTCUSDT")
    return (
        landing(spark, chart or chart_doc())
        .unionByName(landing(spark, daily, dataset="klines_1d", interval="1d", start=10, **binance))
        .unionByName(landing(spark, hours, dataset="klines_1h", interval="1h", start=20, **binance))
        .unionByName(
            landing(spark, index or INDEX, source="feargreed", dataset="index", entity="index", start=30)
        )
    )


def test_daily_run_slices_gates_builds_and_publishes(spark, cfg):
    sink = serving.parquet_sink(spark, f"{cfg.root}/serving")
    result = runs.run_daily(spark, cfg, all_payloads(spark), RUN, sink=sink)
    [row] = result["mart_price_analysis"].collect()
    assert (row["date_day"], row["symbol"], row["close"]) == (date(2024, 1, 2), "BTCUSDT", 43_000.0)
    assert (row["market_cap_usd"], row["fear_greed_value"]) == (8.2e11, 72)
    assert result["output_results"].count() == 38
    assert result["input_results"].count() == 9 + 12 + 12 + 6 + 4
    assert all(sink[1](name) == 1 for name in MARTS)
    log = spark.read.parquet(table_uri(cfg, "quality", "ingest_log"))
    assert {(r["dataset"], r["row_count"]) for r in log.collect()} == {
        ("market_chart", 1), ("klines_1d", 1), ("klines_1h", 3), ("index", 1),
    }


def test_running_a_date_twice_changes_nothing(spark, cfg):
    runs.run_daily(spark, cfg, all_payloads(spark), RUN)
    first = runs.stored_tables(spark, cfg)["mart_price_analysis"].collect()
    tables = runs.stored_tables(spark, cfg)
    serving.register_views(tables, {"mart_price_analysis": "prices"})
    assert spark.sql("SELECT * FROM prices ORDER BY date_day").collect() == first
    assert spark.sql("SELECT count(*) FROM silver_klines").first()[0] == 4
    daily = spark.table("silver_klines").filter("interval = '1d'").select("close")
    assert "PartitionFilters: [isnotnull(interval" in plan_of(daily) and daily.count() == 1
    runs.run_daily(spark, cfg, all_payloads(spark), RUN)
    second = runs.stored_tables(spark, cfg)["mart_price_analysis"].collect()
    assert first == second
    assert bronze.read_bronze(spark, cfg, dataset_spec("klines_1h")).count() == 3


def test_backfill_then_daily_run_leaves_one_row_per_day(spark, cfg):
    report = runs.run_backfill(spark, cfg, all_payloads(spark), datetime(2024, 1, 3, 1))
    assert report.ok and {r["status"] for r in report.summary.collect()} == {"PASS"}
    result = runs.run_daily(spark, cfg, all_payloads(spark), RUN)
    rows = result["mart_price_analysis"].orderBy("date_day").collect()
    assert [r["date_day"].day for r in rows] == [1, 2]
    assert rows[1]["price_change_usd"] == 1_500.0
    assert result["silver_klines"].count() == 2 + 3


def test_failing_gate_blocks_the_transform(spark, cfg):
    broken = {"data": [{**INDEX["data"][0], "value": "150"}]}
    with pytest.raises(QualityGateError) as stop:
        runs.run_daily(spark, cfg, all_payloads(spark, index=broken), RUN)
    assert stop.value.sources == ["feargreed"]
    assert runs.stored_tables(spark, cfg) == {}


def test_a_date_without_rows_is_a_missing_path(spark, cfg):
    with pytest.raises(QualityGateError, match="index stored_run\\(path\\) x 1; klines_1d stored_run"):
        runs.run_daily(spark, cfg, all_payloads(spark), datetime(2024, 2, 1))


def test_backfill_datasets_are_independent(spark, cfg):
    payloads = all_payloads(spark, chart={"prices": []}, daily=[])
    report = runs.run_backfill(spark, cfg, payloads, RUN, since={"index": date(2024, 1, 2)})
    rows = {r["dataset"]: r for r in report.summary.collect()}
    assert not report.ok
    assert rows["market_chart"]["status"] == "FAIL" and rows["market_chart"]["path"] is None
    assert rows["market_chart"]["errors"] == [("row_count", "*", 1), ("malformed", "body", 1)]
    kept = spark.read.parquet(table_uri(cfg, "quality", "quarantine")).collect()
    assert [(r["dataset"], r["reason"]) for r in kept] == [("market_chart", "Missing key 'market_caps'")]
    assert rows["klines_1d"]["status"] == "FAIL"
    assert rows["klines_1d"]["errors"] == [("row_count", "*", 1)]
    assert rows["klines_1h"]["status"] == "PASS" and rows["klines_1h"]["row_count"] == 3
    assert rows["index"]["row_count"] == 1 and rows["index"]["min_time"] == datetime(2024, 1, 2)
    assert bronze.read_run(spark, rows["klines_1h"]["path"]).count() == 3


def test_transform_of_a_tree_of_another_writer(spark, cfg):
    """Files as pandas writes them: nanoseconds, one loose file per run, dates without time."""

    def store(frame, source, dataset):
        folder = Path(dataset_uri(cfg, source, dataset)) / "year=2024" / "month=01" / "day=03"
        folder.mkdir(parents=True)
        for name in ("open_time", "close_time", "ingested_at"):
            if name in frame:
                frame[name] = pd.to_datetime(frame[name], utc=True).astype("datetime64[ns, UTC]")
        frame.to_parquet(folder / f"{dataset}_20240103_000000.parquet", index=False)

    stamp = datetime(2024, 1, 3)
    days = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    candle = dict(
        symbol="BTCUSDT", open=1.0, high=3.0, low=0.5, volume=10.0, quote_volume=20.0, num_trades=4,
        taker_buy_base_vol=1.0, taker_buy_quote_vol=2.0, ingested_at=stamp,
    )
    for interval in ("1d", "1h"):
        rows = [
            dict(open_time=d, close_time=d, interval=interval, close=2.0 + i, **candle)
            for i, d in enumerate(days)
        ]
        store(pd.DataFrame(rows), "binance", f"klines_{interval}")
    chart = pd.DataFrame(
        dict(date=pd.to_datetime(days, utc=True), coin_id="bitcoin", price_usd=5.0, market_cap_usd=6.0,
             volume_usd=7.0, ingested_at=stamp)
    )
    store(chart, "coingecko", "market_chart")
    index = pd.DataFrame(
        dict(date=[d.date() for d in days], fear_greed_value=[20, 72], sentiment_label="x",
             sentiment_bucket=["Extreme Fear", "Greed"], ingested_at=stamp)
    )
    store(index, "feargreed", "index")

    tables = runs.transform(spark, cfg, reader=read_drifted)
    rows = tables["mart_price_analysis"].orderBy("date_day").collect()
    assert [(r["date_day"].day, r["close"], r["market_cap_usd"], r["fear_greed_value"]) for r in rows] == [
        (1, 2.0, 6.0, 20), (2, 3.0, 6.0, 72),
    ]
    assert rows[1]["daily_return_pct"] == 50.0 and rows[0]["latest_ingested_at"] == stamp
    assert tables["mart_sentiment_correlation"].orderBy("date_day").first()["sentiment_change"] is None


def test_silver_absorbs_a_correction(spark, cfg):
    runs.run_backfill(spark, cfg, all_payloads(spark), RUN)
    fixed = all_payloads(spark, daily=[kline(DAY1, 50_000.0)])
    later = fixed.withColumn("fetched_at", F.expr("fetched_at + INTERVAL 1 DAY"))
    runs.run_backfill(spark, cfg, later, datetime(2024, 1, 3, 8, 30))
    tables = runs.transform(spark, cfg)
    rows = tables["mart_price_analysis"].orderBy("date_day").collect()
    assert [(r["date_day"].day, r["close"]) for r in rows] == [(1, 50_000.0), (2, 43_000.0)]


def test_failing_silver_tests_leave_gold_and_serving_alone(spark, cfg):
    sink = serving.parquet_sink(spark, f"{cfg.root}/serving")
    runs.run_daily(spark, cfg, all_payloads(spark), RUN, sink=sink)
    def visible():
        return {name: sorted(rows.inputFiles()) for name, rows in runs.stored_tables(spark, cfg).items()}

    files = visible()
    served = sorted(spark.read.parquet(f"{cfg.root}/serving/mart_price_analysis").inputFiles())
    broken = {"data": [{**INDEX["data"][0], "value": "150"}]}
    lax = {name: Suite(name, ()) for name in runs.default_suites()}
    with pytest.raises(QualityGateError) as stop:
        runs.run_daily(spark, cfg, all_payloads(spark, index=broken), RUN, suites=lax, sink=sink)
    assert stop.value.sources == ["silver_sentiment"]
    assert visible() == files
    assert sorted(spark.read.parquet(f"{cfg.root}/serving/mart_price_analysis").inputFiles()) == served
    kept = spark.read.parquet(table_uri(cfg, "quality", "output_results"))
    assert {r["source"] for r in kept.select("source").distinct().collect()} == {
        "silver_klines", "silver_market_chart", "silver_sentiment",
    }


def test_a_run_reads_only_the_documents_of_its_span(spark, cfg, tmp_path):
    old = landing(spark, "not json", "{", source="binance", dataset="klines_1d", interval="1d")
    old = old.withColumn("fetched_at", F.expr("fetched_at - INTERVAL 3 DAYS"))
    whole = all_payloads(spark).unionByName(old).withColumn("fetch_date", F.to_date("fetched_at"))
    whole.write.partitionBy("dataset", "fetch_date").parquet(str(tmp_path / "landing"))
    stored = spark.read.parquet(str(tmp_path / "landing"))
    span = (datetime(2024, 3, 9), datetime(2024, 3, 10))
    scan = next(x for x in plan_of(runs.fetched_within(stored, span)).splitlines() if "FileScan" in x)
    assert "fetch_date" in scan.partition("PartitionFilters: ")[2].partition("]")[0]
    assert runs.fetched_within(stored, span).count() == all_payloads(spark).count()
    result = runs.run_daily(spark, cfg, stored, RUN, fetched=span)
    assert result["mart_price_analysis"].count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        runs.run_daily(spark, cfg, stored, RUN)


def test_faulty_documents_are_quarantined_and_counted(spark, cfg):
    """The sound documents are stored; beyond the limit the gate fails, up to it the run goes on."""
    faulty = landing(spark, "{", "[[1]]", source="binance", dataset="klines_1d", entity="X", interval="1d", start=50)
    payloads = all_payloads(spark).unionByName(faulty)
    with pytest.raises(QualityGateError, match="binance/klines_1d malformed\\(body\\) x 2"):
        runs.run_daily(spark, cfg, payloads, RUN)
    assert runs.stored_tables(spark, cfg) == {}
    assert bronze.read_bronze(spark, cfg, dataset_spec("klines_1d")).count() == 1
    table = table_uri(cfg, "quality", "quarantine")
    kept = spark.read.parquet(table).orderBy("payload_id").collect()
    assert [(r["payload_id"], r["body"], r["reason"]) for r in kept] == [("p50", "{", "Malformed body"), ("p51", "[[1]]", "Short bar")]
    result = runs.run_daily(spark, cfg, payloads, RUN, max_rejected=2)
    assert result["mart_price_analysis"].count() == 1
    counted = result["input_results"].filter("rule = 'malformed' AND n_bad > 0").collect()
    assert [(r["dataset"], r["n_rows"], r["n_bad"], r["success"]) for r in counted] == [("klines_1d", 3, 2, True)]
    runs.run_daily(spark, cfg, all_payloads(spark), RUN)  # mended: nothing is left of the earlier try
    assert files.folders(spark, f"{table}/run=20240102_083000") == []


def test_only_faulty_documents_stop_the_run_with_their_rule(spark, cfg):
    faulty = landing(spark, "nothing", source="binance", dataset="klines_1d", entity="X", interval="1d", start=50)
    payloads = all_payloads(spark).filter("dataset != 'klines_1d'").unionByName(faulty)
    with pytest.raises(QualityGateError, match="malformed"):
        runs.run_daily(spark, cfg, payloads, RUN)
    kept = spark.read.parquet(table_uri(cfg, "quality", "input_results"))
    assert kept.filter("rule = 'malformed' AND NOT success").count() == 1


def test_a_backfill_parses_each_document_once(spark, cfg, tmp_path):
    """Every document passes an accumulator on its way to the parser; a failed dataset leaves no draft."""
    passed = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            passed.add(part.num_rows)
            yield part

    payloads = all_payloads(spark).mapInArrow(count, all_payloads(spark).schema)
    report = runs.run_backfill(spark, cfg, payloads, RUN)
    assert report.ok and passed.value == 4 * 4  # each dataset filters the four documents of all
    broken = all_payloads(spark, daily=[]).filter("dataset = 'klines_1d'")
    assert not runs.run_backfill(spark, cfg, broken, datetime(2024, 1, 9)).ok
    for source, dataset in (("binance", "klines_1d"), ("coingecko", "market_chart"), ("feargreed", "index")):
        assert files.folders(spark, f"{cfg.root}/staging/{source}/{dataset}") == []
