from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pandas as pd
import pytest
from helpers import chart_doc, landing, plan_of
from pyspark.sql import functions as F

from candlewick.config import LakeConfig, as_utc, dataset_uri, prepare_session, run_uri, shared_scratch
from candlewick.contracts import dataset_spec
from candlewick.sources import bronze, drift
from candlewick.sources.payloads import parse_market_chart

RUN = datetime(2024, 3, 9, 14, 30, 5)
CHART = dataset_spec("market_chart")
INDEX = dataset_spec("index")


@pytest.fixture()
def chart(spark):
    return parse_market_chart(landing(spark, chart_doc()))


def test_local_layout(spark, cfg, chart):
    receipt = bronze.write_bronze(chart, cfg, CHART, RUN)
    assert receipt.path == (
        f"{cfg.data_dir}/bronze/coingecko/market_chart/year=2024/month=03/day=09/"
        "market_chart_20240309_143005.parquet"
    )
    assert (receipt.row_count, receipt.min_time, receipt.max_time) == (
        2, datetime(2024, 1, 1), datetime(2024, 1, 2),
    )
    assert bronze.read_run(spark, receipt.path).count() == 2


def test_run_times_are_utc():
    cfg = LakeConfig(data_dir="/lake")
    evening = datetime(2024, 3, 9, 23, 30, tzinfo=timezone(timedelta(hours=-2)))
    assert run_uri(cfg, "s", "d", evening).endswith("month=03/day=10/d_20240310_013000.parquet")
    assert as_utc(RUN) == RUN.replace(tzinfo=timezone.utc)


def test_object_store_route_and_options():
    cfg = LakeConfig(bucket="b", endpoint_url="http://store:9000", access_key="k", secret_key="s")
    assert run_uri(cfg, "binance", "klines_1d", RUN).startswith("s3a://b/bronze/binance/klines_1d/")
    options = cfg.s3a_options()
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert options["spark.hadoop.fs.s3a.access.key"] == "k"
    assert options["spark.hadoop.fs.s3a.secret.key"] == "s"


def test_local_route_needs_no_object_store():
    cfg = LakeConfig(data_dir="C:\\lake\\data")
    assert cfg.s3a_options() == {}
    assert dataset_uri(cfg, "feargreed", "index") == "C:/lake/data/bronze/feargreed/index"


def test_config_from_environment(monkeypatch):
    monkeypatch.setenv("S3_ENDPOINT_URL", "http://store:9000")
    monkeypatch.setenv("S3_BUCKET", "bucket")
    assert LakeConfig.from_env().root == "s3a://bucket"
    monkeypatch.setenv("S3_ENDPOINT_URL", "")
    monkeypatch.setenv("DATA_DIR", "/lake")
    assert LakeConfig.from_env().root == "/lake"


def test_same_run_replaces_itself_and_other_runs_stay(spark, cfg, chart):
    bronze.write_bronze(chart, cfg, CHART, RUN)
    bronze.write_bronze(chart.limit(1), cfg, CHART, RUN)
    assert bronze.read_bronze(spark, cfg, CHART).count() == 1
    bronze.write_bronze(chart, cfg, CHART, RUN.replace(hour=20))
    bronze.write_bronze(chart, cfg, CHART, datetime(2024, 12, 31))
    rows = bronze.read_bronze(spark, cfg, CHART)
    assert rows.count() == 5
    assert {tuple(r) for r in rows.select("year", "month", "day").collect()} == {
        (2024, 3, 9), (2024, 12, 31),
    }


def test_timestamps_are_stored_as_micros(cfg, chart):
    import pyarrow.parquet as pq

    path = Path(bronze.write_bronze(chart, cfg, CHART, RUN).path)
    schema = pq.read_schema(next(path.glob("part-*.parquet")))
    assert str(schema.field("date").type) == "timestamp[us, tz=UTC]"


def test_read_prunes_run_partitions_and_columns(spark, cfg, chart):
    bronze.write_bronze(chart, cfg, CHART, RUN)
    plan = plan_of(
        bronze.read_bronze(spark, cfg, CHART).filter("month = 3 AND price_usd > 1").select("coin_id")
    )
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "GreaterThan(price_usd,1.0)" in plan
    assert "ReadSchema: struct<coin_id:string,price_usd:double>" in plan


def test_empty_paths_and_empty_frames(spark, cfg, chart):
    with pytest.raises(ValueError):
        bronze.read_run(spark, "")
    empty = bronze.logical_date_slice(chart, date(2030, 1, 1))
    assert bronze.write_bronze_if_any(empty, cfg, CHART, RUN) is None
    assert not Path(cfg.data_dir).exists()
    assert bronze.write_bronze_if_any(chart, cfg, CHART, RUN).row_count == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_logical_date_slice_is_one_utc_day(spark, kind):
    stamps = ["2024-01-01 23:59:59.999", "2024-01-02", "2024-01-02 23:59:59.999", "2024-01-03"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        "s", F.col("s").cast("timestamp").cast(kind).alias("date")
    )
    found = bronze.logical_date_slice(rows, date(2024, 1, 2)).select("s")
    assert sorted(r["s"] for r in found.collect()) == stamps[1:3]


def test_kline_window_includes_both_ends(spark):
    stamps = ["2024-01-01 23:00", "2024-01-02", "2024-01-02 23:00", "2024-01-03", "2024-01-03 01:00"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        "s", F.col("s").cast("timestamp").alias("open_time")
    )
    found = bronze.kline_run_window(rows, date(2024, 1, 2)).select("s")
    assert sorted(r["s"] for r in found.collect()) == stamps[1:4]


def _store(frame: pd.DataFrame, cfg, name, day, **kwargs):
    folder = Path(dataset_uri(cfg, "feargreed", "index")) / f"year=2024/month=03/day={day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    frame.to_parquet(folder / name, index=False, engine="pyarrow", **kwargs)


def test_drifted_files_are_brought_to_the_contract(spark, cfg):
    stamp = pd.Timestamp("2024-03-09 01:02:03.123456", tz="UTC")
    base = {
        "fear_greed_value": [55], "sentiment_label": ["Greed"], "sentiment_bucket": ["Greed"],
        "ingested_at": pd.Series([stamp]).astype("datetime64[ns, UTC]"),
    }
    # Nanoseconds without zone; a date; a file of old column names; micros with an extra column.
    naive = pd.Series([pd.Timestamp("2024-03-01")]).astype("datetime64[ns]")
    _store(pd.DataFrame({"date": naive, **base}), cfg, "index_20240309_000000.parquet", 9)
    _store(pd.DataFrame({"date": [date(2024, 3, 2)], **base}), cfg, "index_20240309_010000.parquet", 9)
    old = pd.DataFrame({"date": [date(2024, 3, 3)], **base}).rename(
        columns={"fear_greed_value": "value"}
    ).drop(columns="sentiment_bucket")
    _store(old, cfg, "index_20240310_000000.parquet", 10)
    _store(
        pd.DataFrame({"date": [pd.Timestamp("2024-03-04", tz="UTC")], **base, "note": ["x"]}),
        cfg, "index_20240311_000000.parquet", 11, coerce_timestamps="us",
    )
    # A run of our own writer next to the loose files of the same day.
    ours = spark.createDataFrame(
        [(datetime(2024, 3, 5), 10, "Extreme Fear", "Extreme Fear", datetime(2024, 3, 9, 1, 2, 3, 123456))],
        INDEX.schema,
    )
    bronze.write_bronze(ours, cfg, INDEX, datetime(2024, 3, 9, 5))

    floats = pd.DataFrame({"date": [date(2024, 3, 6)] * 2, **base, "fear_greed_value": [2.5, None]}
                          | {k: list(v) * 2 for k, v in base.items() if k.startswith("sent")}
                          | {"ingested_at": pd.concat([base["ingested_at"]] * 2).values})
    _store(floats, cfg, "index_20240312_000000.parquet", 12)

    df = drift.read_drifted(spark, cfg, INDEX)
    floats_read = df.filter("day = 12").orderBy("fear_greed_value").collect()
    assert [r["fear_greed_value"] for r in floats_read] == [None, 2]
    df = df.filter("day < 12")
    assert df.columns == [*INDEX.schema.names, "year", "month", "day"]
    assert [f.dataType for f in df.schema.fields[:5]] == [f.dataType for f in INDEX.schema.fields]
    rows = df.orderBy("date").collect()
    assert [(r["date"], r["fear_greed_value"], r["sentiment_bucket"], r["day"]) for r in rows] == [
        (datetime(2024, 3, 1), 55, "Greed", 9),
        (datetime(2024, 3, 2), 55, "Greed", 9),
        (datetime(2024, 3, 3), None, None, 10),
        (datetime(2024, 3, 4), 55, "Greed", 11),
        (datetime(2024, 3, 5), 10, "Extreme Fear", 9),
    ]
    assert {r["ingested_at"] for r in rows} == {datetime(2024, 3, 9, 1, 2, 3, 123456)}


def test_empty_run_can_be_written(spark, cfg, chart):
    receipt = bronze.write_bronze(chart.limit(0), cfg, CHART, RUN)
    assert (receipt.row_count, receipt.min_time) == (0, None)
    assert bronze.read_bronze(spark, cfg, CHART).count() == 0


def test_shared_scratch_uses_the_session_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_scratch(spark, "x"), shared_scratch(spark, "x")
    assert first.startswith(base) and first != second


def test_store_settings_reach_the_session_and_the_footer_reader(spark):
    from pyarrow.fs import S3FileSystem

    cfg = LakeConfig(endpoint_url="http://store:9000", access_key="a", secret_key="b")
    session = spark.newSession()
    prepare_session(session, cfg)
    hadoop = session._jsparkSession.sessionState().newHadoopConf()
    assert hadoop.get("fs.s3a.endpoint") == "http://store:9000" and hadoop.get("fs.s3a.secret.key") == "b"
    assert cfg.arrow_options()["endpoint_override"] == "store:9000"
    S3FileSystem(**cfg.arrow_options())
    assert LakeConfig().arrow_options() == {}
