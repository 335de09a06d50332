"""Versioned tables and incremental builds: what is visible, and equality with whole rebuilds."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from candlewick.contracts import GRAINS, dataset_spec
from candlewick.plans import models, runs
from candlewick.sources import bronze, files, versions

START = datetime(2023, 10, 20)


def candle(day, symbol="AAA", close=10.0, ingested=None, interval="1d"):
    close = float(close)
    return (
        day, day + timedelta(days=1), symbol, interval, close, close + 1, close - 1, close, close * 3, close * 9, 5,
        1.0, 2.0, ingested or day + timedelta(days=1),
    )


def store(spark, cfg, run_ts, klines=(), hours=(), chart=(), mood=()):
    """Write runs of some datasets and log them, as an ingest does."""
    frames = {"klines_1d": klines, "klines_1h": hours, "market_chart": chart, "index": mood}
    receipts = {}
    for name, rows in frames.items():
        if rows:
            spec = dataset_spec(name)
            made = spark.createDataFrame(rows, spec.schema)
            receipts[name] = bronze.write_bronze(made, cfg, spec, run_ts)
    runs.log_ingest(spark, cfg, receipts, run_ts)


HOUR = [candle(START, interval="1h")]


def days(n, start=START):
    return [start + timedelta(days=i) for i in range(n)]


def point(day, price=5.0, ingested=None):
    return (day, "coin", float(price), price * 100.0, price * 7.0, ingested or day + timedelta(hours=26))


def mood(day, value=40, ingested=None):
    return (day, value, "Fear", "Fear", ingested or day + timedelta(hours=30))


def contents(tables):
    return {name: sorted(map(str, rows.select(*sorted(rows.columns)).collect())) for name, rows in tables.items()}


def rebuilt(spark, cfg, tmp_path, monkeypatch):
    """What a whole rebuild from the same Bronze gives, without touching the lake's pointer."""
    seen = {}

    def keep(spark, cfg, snapshot):
        seen["snapshot"] = snapshot

    with monkeypatch.context() as patch:
        patch.setattr(versions, "switch", keep)
        return contents(models.rebuild(spark, cfg, datetime(2030, 1, 1)))


def by_month(day):
    column = F.to_date(day) if isinstance(day, str) else day
    return F.year(column) * 100 + F.month(column)


def test_pointer_is_replaced_as_a_whole(spark, cfg):
    assert versions.current(spark, cfg) is None and runs.stored_tables(spark, cfg) == {}
    state = versions.TableState("{}", (((None, "2024"), "v1"), (("1d", "2024"), "v2")))
    first = versions.Snapshot("v1", {"silver_klines": state}, {"a/b": {"written": "x", "first": None, "last": None}})
    versions.switch(spark, cfg, first)
    assert versions.current(spark, cfg) == first
    versions.switch(spark, cfg, versions.Snapshot("v2"))
    assert versions.current(spark, cfg) == versions.Snapshot("v2")
    names = [found.rpartition("/")[2] for found in files.folders(spark, f"{cfg.root}/models")]
    assert [name for name in names if not name.startswith(".")] == ["current.json"]


def test_a_killed_or_failing_build_changes_nothing_visible(spark, cfg, monkeypatch):
    store(spark, cfg, START, [candle(d) for d in days(40)], HOUR, [point(d) for d in days(40)], [mood(d) for d in days(40)])
    before = contents(models.refresh(spark, cfg, START))
    pointer = files.read_text(spark, versions.pointer_uri(cfg))
    later = START + timedelta(days=50)
    store(spark, cfg, later, [candle(days(40)[3], close=99.0, ingested=later)])

    for failing in ("daily_enriched", "mart_price_analysis", "mart_volume_anomalies"):

        def check(tables, names, failing=failing):
            if failing in names:
                raise RuntimeError("found wanting")

        with pytest.raises(RuntimeError, match="found wanting"):
            models.refresh(spark, cfg, later, check=check)
        assert files.read_text(spark, versions.pointer_uri(cfg)) == pointer
        assert contents(runs.stored_tables(spark, cfg)) == before

    whole = versions.write_version

    def killed(rows, cfg, name, *rest):
        if name == "mart_price_analysis":  # half of its rows are written when the run dies
            whole(rows.limit(5), cfg, name, *rest)
            raise KeyboardInterrupt
        return whole(rows, cfg, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "write_version", killed)
        with pytest.raises(KeyboardInterrupt):
            models.refresh(spark, cfg, later)
    assert contents(runs.stored_tables(spark, cfg)) == before

    after = models.refresh(spark, cfg, later)
    assert after["mart_price_analysis"].filter("close = 99").count() == 1
    removed = versions.vacuum(spark, cfg)
    assert len(removed) >= 8 and contents(runs.stored_tables(spark, cfg)) == contents(after)
    assert versions.vacuum(spark, cfg) == []


def test_readers_keep_the_snapshot_they_resolved(spark, cfg):
    store(spark, cfg, START, [candle(d) for d in days(5)], HOUR, [point(d) for d in days(5)], [mood(d) for d in days(5)])
    models.refresh(spark, cfg, START)
    old = runs.stored_tables(spark, cfg)["mart_price_analysis"]
    store(spark, cfg, START + timedelta(days=9), [candle(days(5)[0], close=77.0, ingested=START + timedelta(days=9))])
    models.refresh(spark, cfg, START + timedelta(days=9))
    assert old.filter("close = 77").count() == 0
    assert runs.stored_tables(spark, cfg)["mart_price_analysis"].filter("close = 77").count() == 1


@pytest.mark.parametrize("seed", [1])
def test_incremental_builds_equal_rebuilds(spark, cfg, tmp_path, monkeypatch, seed):
    """Late corrections, new days, ties, sparse symbols, days without sentiment, runs written again."""
    monkeypatch.setattr(versions, "period_of", by_month)
    pick = random.Random(seed)
    span = days(250)
    klines = [candle(d, s, pick.randint(5, 50)) for s in ("AAA", "BBB") for d in span]
    klines += [candle(d, "SPARSE", pick.randint(5, 50)) for d in span[::23]]
    hours = [candle(d, "AAA", 3.0, interval="1h") for d in span[:50]]
    moods = [mood(d, pick.randint(0, 100)) for d in span if pick.random() < (0.2 if d < span[150] else 0.9)]
    store(spark, cfg, datetime(2025, 1, 1), klines, hours, [point(d, pick.randint(1, 9)) for d in span], moods)
    models.refresh(spark, cfg, datetime(2025, 1, 1))

    changes = [
        dict(klines=[(span[100], "AAA", 1)]),
        dict(klines=[(span[3], "SPARSE", 2), (span[23], "SPARSE", 3)], mood=[span[249]]),
        dict(chart=[span[77]], hours=[span[10]]),
        dict(mood=[span[149], span[2]], klines=[(span[249] + timedelta(days=40), "NEW", 7)]),
    ]
    for i, change in enumerate(changes, 2):
        run_ts = datetime(2025, 1, i)
        store(
            spark, cfg, run_ts,
            [candle(d, s, v, run_ts) for d, s, v in change.get("klines", ())],
            [candle(d, "AAA", 8.0, run_ts, "1h") for d in change.get("hours", ())],
            [point(d, 99.0, run_ts) for d in change.get("chart", ())],
            [mood(d, 1, run_ts) for d in change.get("mood", ())],
        )
        old = versions.current(spark, cfg)
        found = contents(models.refresh(spark, cfg, run_ts))
        new = versions.current(spark, cfg)
        assert found == rebuilt(spark, cfg, tmp_path, monkeypatch), change
        if i == 2:  # one symbol's day: few periods are written, the others shared
            for name in ("silver_klines", "daily_enriched", "mart_price_analysis", "mart_sentiment_correlation"):
                written = dict(new.tables[name].parts).items() - dict(old.tables[name].parts).items()
                assert 0 < len(written) <= 8 < len(new.tables[name].parts)
            assert new.tables["silver_sentiment"] == old.tables["silver_sentiment"]
        if i == 4:  # hourly candles concern no daily table
            assert {v for _, v in new.tables["mart_price_analysis"].parts} > {new.version}

    # a run is written again with fewer rows: its days come from the runs that are left
    store(spark, cfg, datetime(2025, 1, 5), [candle(span[5], "BBB", 4.0, datetime(2025, 1, 5))], mood=[mood(span[2], 3)])
    found = contents(models.refresh(spark, cfg, datetime(2025, 1, 6)))
    assert found == rebuilt(spark, cfg, tmp_path, monkeypatch)
    assert not any("NEW" in row for row in found["mart_price_analysis"])
    # nothing new: nothing is written
    again = versions.current(spark, cfg)
    assert contents(models.refresh(spark, cfg, datetime(2025, 1, 7))) == found
    assert versions.current(spark, cfg).tables == again.tables


def test_reads_of_some_periods_list_only_those(spark, cfg):
    span = [datetime(2019 + i, 6, 1) for i in range(6)]
    store(spark, cfg, datetime(2025, 1, 1), [candle(d) for d in span], HOUR, [point(d) for d in span], [mood(d) for d in span])
    models.refresh(spark, cfg, datetime(2025, 1, 1))
    state = versions.current(spark, cfg).tables["mart_price_analysis"]
    parts = versions.parts_of("mart_price_analysis", state, [2020, 2021])
    rows = versions.read_version(spark, cfg, "mart_price_analysis", state, parts)
    assert len(rows.inputFiles()) == 2 and {r["date_day"].year for r in rows.collect()} == {2020, 2021}
    assert "InMemoryFileIndex(2 paths)" in plan_of(rows)
    assert json.loads(files.read_text(spark, versions.pointer_uri(cfg)))["absorbed"]


def test_periods_that_a_change_reaches(spark):
    series = spark.createDataFrame(
        [("A", p, 12, 12 if p != 5 else 0) for p in range(1, 12)] + [("B", 3, 1, 1), ("B", 9, 40, 0), ("C", 1, 9, 9)],
        "symbol string, period int, n_rows int, n_mood int",
    )
    changed = spark.createDataFrame([("A", 6), ("B", 9), ("GONE", 4)], "symbol string, period int")
    found = {r[0]: tuple(r)[1:] for r in models.affected_periods(changed, series).collect()}
    # A: sentiment before 6 is in 4; 32 rows of it in 3, 2, 1; 32 rows after 6 in 7, 8, 9; the next one is 10
    assert found == {"A": (1, 4, 9, 10), "B": (3, 3, 9, 9), "GONE": (4, 4, 4, 4)}


def test_days_of_grains_have_layouts():
    assert set(GRAINS) < set(models.LAYOUTS) and date.today()
