"""Building Silver, the enriched table and the marts as versions: whole, or from what has changed.

A build writes new versions of partitions, tests each layer and switches the pointer at the end.  The
incremental build reads the Bronze runs that the snapshot does not hold yet, merges them into the touched
Silver partitions, and finds the (symbol, day) rows of the enriched table that differ.  A changed row
reaches as far as the marts' frames do: ``series_periods`` tells how many periods that is for a symbol,
so only those partitions are read and written, and the rows of other symbols in them are kept as stored.
The result is that of a whole rebuild.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.config import LakeConfig, dataset_uri, prepare_session, table_uri
from candlewick.contracts import GRAINS, LAYOUTS, DatasetSpec, dataset_spec
from candlewick.operators.enrich import daily_enriched
from candlewick.plans import gold, silver
from candlewick.sources import files, versions
from candlewick.sources.bronze import read_bronze, time_span, with_run_partitions
from candlewick.sources.versions import PERIOD, Part, Snapshot, TableState

BronzeReader = Callable[[SparkSession, LakeConfig, DatasetSpec], DataFrame]
# Called with all tables built so far and the names of the newest; it raises to stop a build.
TableCheck = Callable[[dict[str, DataFrame], Collection[str]], None]
# Rows on either side of a changed row that its marts' values may depend on: frames of 30, a lag and a lead.
REACH = 32


@dataclass(frozen=True)
class SilverModel:
    """A Silver table: its Bronze datasets, their typed rows, and which of several rows of a grain stays."""

    datasets: tuple[str, ...]
    typed: Callable[[DataFrame], DataFrame]
    latest: Callable[[DataFrame], DataFrame]


SILVER = {
    "silver_klines": SilverModel(("klines_1d", "klines_1h"), silver.typed_klines, silver.latest_klines),
    "silver_market_chart": SilverModel(
        ("market_chart",), silver.typed_market_chart, silver.latest_market_chart
    ),
    "silver_sentiment": SilverModel(("index",), silver.typed_sentiment, silver.latest_sentiment_day),
}
CORRELATION, ANOMALIES = "mart_sentiment_correlation", "mart_volume_anomalies"


def in_parallel(tasks: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Submit independent Spark jobs together; results under their names."""
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: future.result() for name, future in futures.items()}


# ---------------------------------------------------------------------------------------------
# Bronze runs
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LoggedRun:
    """A line of the ingest log: what a run stored, when it was written, and its time bounds."""

    dataset: str
    path: str
    written: str
    first: str | None
    last: str | None

    def mark(self) -> dict[str, str | None]:
        return {"written": self.written, "first": self.first, "last": self.last}


def logged_runs(spark: SparkSession, cfg: LakeConfig) -> list[LoggedRun]:
    """The runs of the ingest log (one small row each)."""
    uri = table_uri(cfg, "quality", "ingest_log")
    if not files.exists(spark, uri):
        return []
    rows = prepare_session(spark, cfg).read.parquet(uri).collect()

    def text(moment: datetime | None) -> str | None:
        return None if moment is None else moment.isoformat()

    return [
        LoggedRun(r["dataset"], r["path"], text(r["written_at"]), text(r["min_time"]), text(r["max_time"]))
        for r in rows
    ]


def read_runs(spark: SparkSession, cfg: LakeConfig, spec: DatasetSpec, paths: Collection[str]) -> DataFrame:
    """Some runs of a dataset, as ``read_bronze`` gives all of them."""
    schema = with_run_partitions(spec.schema)
    if not paths:
        return spark.createDataFrame([], schema)
    root = dataset_uri(cfg, spec.source, spec.dataset)
    return spark.read.option("basePath", root).schema(schema).parquet(*sorted(paths))


# ---------------------------------------------------------------------------------------------
# A build
# ---------------------------------------------------------------------------------------------


class Build:
    """One run's versions: what it wrote so far over the snapshot before it.  Nothing is visible until
    ``finish`` switches the pointer."""

    def __init__(
        self, spark: SparkSession, cfg: LakeConfig, run_ts: datetime, before: Snapshot | None, check: TableCheck | None
    ):
        self.spark, self.cfg, self.check = prepare_session(spark, cfg), cfg, check
        self.before = before or Snapshot("")
        self.snapshot = replace(self.before, version=versions.new_version(run_ts))
        self._work = f"{cfg.root}/models/work/{self.snapshot.version}"

    def state(self, name: str) -> TableState | None:
        return self.snapshot.tables.get(name)

    def table(self, name: str, periods: Collection[int] | None = None, old: bool = False) -> DataFrame:
        """A table as built so far (or as it was before), or its partitions of some periods."""
        state = (self.before if old else self.snapshot).tables[name]
        parts = None if periods is None else versions.parts_of(name, state, periods)
        return versions.read_version(self.spark, self.cfg, name, state, parts)

    def shown(self, name: str) -> DataFrame:
        return self.table(name).drop(*LAYOUTS[name].hidden)

    def write(self, frames: Mapping[str, DataFrame], gone: Mapping[str, Iterable[Part]] | None = None) -> None:
        """Write partitions of several tables at the same time; others are carried on where ``gone`` is given."""

        def task(name: str, rows: DataFrame) -> Callable[[], TableState]:
            before = None if gone is None else self.state(name)
            return lambda: versions.write_version(
                rows, self.cfg, name, self.snapshot.version, before, (gone or {}).get(name, ())
            )

        for name, state in in_parallel({n: task(n, rows) for n, rows in frames.items()}).items():
            self.snapshot = self.snapshot.with_table(name, state)

    def test(self, *names: str) -> None:
        if self.check is not None:
            built = {name: self.shown(name) for name in GRAINS if self.state(name)}
            self.check(built, list(names))

    def kept(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows in a table of this run alone; later steps start from it."""
        uri = f"{self._work}/{name}"
        rows.write.mode("overwrite").parquet(uri)
        return self.spark.read.schema(rows.schema).parquet(uri)

    def finish(self, absorbed: Mapping[str, Mapping[str, str | None]]) -> dict[str, DataFrame]:
        """Switch the pointer to what was built; the tables."""
        self.snapshot = replace(self.snapshot, absorbed=dict(absorbed))
        versions.switch(self.spark, self.cfg, self.snapshot)
        files.remove(self.spark, self._work)
        return {name: self.shown(name) for name in GRAINS}


def series_periods(enriched: DataFrame) -> DataFrame:
    """(symbol, first_day, n_rows, n_mood) of each symbol and period: rows, and rows with sentiment."""
    return enriched.groupBy("symbol", versions.period_of("date_day").alias("_period")).agg(
        F.min("date_day").alias("first_day"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("fear_greed_value").alias("n_mood"),
    ).drop("_period")


def rebuild(
    spark: SparkSession,
    cfg: LakeConfig,
    run_ts: datetime,
    coin_of_symbol: DataFrame | None = None,
    reader: BronzeReader = read_bronze,
    check: TableCheck | None = None,
) -> dict[str, DataFrame]:
    """All tables from all of Bronze."""
    build = Build(spark, cfg, run_ts, None, check)
    log = logged_runs(spark, cfg)

    def typed(model: SilverModel) -> DataFrame:
        bronze = [reader(spark, cfg, dataset_spec(dataset)) for dataset in model.datasets]
        return model.typed(silver.union_intervals(*bronze))

    build.write({name: model.latest(typed(model)) for name, model in SILVER.items()})
    build.test(*SILVER)
    enriched = daily_enriched(*(build.table(name) for name in SILVER), coin_of_symbol)
    build.write({"daily_enriched": enriched})
    build.test("daily_enriched")
    enriched = build.table("daily_enriched")
    build.write(
        {"mart_price_analysis": gold.price_analysis(enriched), "series_periods": series_periods(enriched)}
    )
    build.test("mart_price_analysis")
    price = build.table("mart_price_analysis")
    build.write({CORRELATION: gold.sentiment_correlation(price), ANOMALIES: gold.volume_anomalies(price)})
    build.test(CORRELATION, ANOMALIES)
    return build.finish({run.path: run.mark() for run in log})


# ---------------------------------------------------------------------------------------------
# Incremental build
# ---------------------------------------------------------------------------------------------


def refresh(
    spark: SparkSession,
    cfg: LakeConfig,
    run_ts: datetime,
    coin_of_symbol: DataFrame | None = None,
    check: TableCheck | None = None,
) -> dict[str, DataFrame]:
    """The tables with the logged Bronze runs that they do not hold yet; the first time, a rebuild.

    Only runs in the ingest log are seen (runs of other writers need ``rebuild``).  A run that was written
    again since may have lost rows, which no merge can undo: the periods between its bounds are then
    derived anew from all runs.  Days must not be null, which the tables' tests require anyway.
    """
    before = versions.current(prepare_session(spark, cfg), cfg)
    if before is None:
        return rebuild(spark, cfg, run_ts, coin_of_symbol, check=check)
    build = Build(spark, cfg, run_ts, before, check)
    log = logged_runs(spark, cfg)
    new = [run for run in log if run.path not in before.absorbed]
    again = [run for run in log if before.absorbed.get(run.path, run.mark())["written"] != run.written]
    merges = in_parallel({name: lambda name=name: _merged_silver(build, name, new, again) for name in SILVER})
    merges = {name: merge for name, merge in merges.items() if merge is not None}
    build.write({name: rows for name, (rows, _) in merges.items()}, {name: gone for name, (_, gone) in merges.items()})
    build.test(*SILVER)

    changed = _changed_days(build)
    if changed:
        _refresh_enriched(build, changed, coin_of_symbol)
        build.test("daily_enriched")
        _refresh_marts(build, changed)
    return build.finish({**before.absorbed, **{run.path: run.mark() for run in log}})


def _merged_silver(
    build: Build, name: str, new: list[LoggedRun], again: list[LoggedRun]
) -> tuple[DataFrame, list[Part]] | None:
    """The partitions that new runs touch, merged with them, and the periods of rewritten runs derived anew;
    with the partitions of the latter.  None where nothing is new."""
    spark, cfg, model, layout = build.spark, build.cfg, SILVER[name], LAYOUTS[name]
    state = build.state(name)
    paths = {d: [run.path for run in new if run.dataset == d] for d in model.datasets}
    bounds = _bounds([run for run in again if run.dataset in model.datasets], build.before)
    if not any(paths.values()) and bounds is None:
        return None

    fresh = model.typed(
        silver.union_intervals(*(read_runs(spark, cfg, dataset_spec(d), paths[d]) for d in model.datasets))
    )
    period = versions.period_of(layout.day)
    redone: list[Part] = []
    if bounds is not None:
        first, last = spark.range(1).select(
            *(versions.period_of(F.lit(day)) for day in bounds)
        ).first()
        periods = {int(p) for part, _ in state.parts if (p := part[layout.keys.index(PERIOD)]) is not None}
        redone = versions.parts_of(name, state, [p for p in periods if first <= p <= last])
        fresh = fresh.filter(~period.between(first, last))
    keys = [(period if key == PERIOD else F.col(key)).cast("string").alias(key) for key in layout.keys]
    touched = {tuple(row) for row in fresh.select(*keys).distinct().collect()}

    stored = versions.read_version(spark, cfg, name, state, touched - set(redone))
    rows = stored.unionByName(fresh)
    if bounds is not None:
        year = (date(bounds[0].year, 1, 1), date(bounds[1].year + 1, 1, 1))
        whole = [
            time_span(read_bronze(spark, cfg, spec), *year, spec.time_col)
            for spec in map(dataset_spec, model.datasets)
        ]
        anew = model.typed(silver.union_intervals(*whole)).filter(period.between(first, last))
        rows = rows.unionByName(anew)
    return model.latest(rows).select(*state.struct().names), redone


def _bounds(again: list[LoggedRun], before: Snapshot) -> tuple[date, date] | None:
    """First and last day that rewritten runs hold now or held before."""
    marks = [mark for run in again for mark in (run.mark(), before.absorbed[run.path])]
    days = [datetime.fromisoformat(mark[end]).date() for mark in marks for end in ("first", "last") if mark[end]]
    return (min(days), max(days)) if days else None


def _differing(build: Build, name: str, keys: Collection[str], where: str = "true") -> DataFrame | None:
    """Keys of rows that a table has now and had not, or had and has not; None if nothing was written."""
    was, now = build.before.tables[name], build.state(name)
    parts = dict(was.parts).items() ^ dict(now.parts).items()
    touched = {part for part, _ in parts}
    if not touched:
        return None
    old, new = (
        versions.read_version(build.spark, build.cfg, name, state, touched).filter(where) for state in (was, now)
    )
    return new.subtract(old).select(*keys).union(old.subtract(new).select(*keys)).distinct()


def _periods(rows: DataFrame, day: str = "date_day") -> list[int]:
    return [row[0] for row in rows.select(versions.period_of(day)).distinct().collect()]


def _changed_days(build: Build) -> list[int]:
    """The periods in which a Silver row behind the daily tables differs from what it was."""
    days = [
        _differing(build, "silver_klines", ["open_time"], "interval = '1d'"),
        _differing(build, "silver_market_chart", ["date_day"]),
        _differing(build, "silver_sentiment", ["date_day"]),
    ]
    found = [rows.select(F.to_date(rows.columns[0]).alias("date_day")) for rows in days if rows is not None]
    return sorted(_periods(reduce(DataFrame.union, found))) if found else []


def _refresh_enriched(build: Build, periods: list[int], coin_of_symbol: DataFrame | None) -> None:
    """The enriched rows of changed periods; days join within their period only."""
    enriched = daily_enriched(*(build.table(name, periods) for name in SILVER), coin_of_symbol)
    gone = versions.parts_of("daily_enriched", build.state("daily_enriched"), periods)
    build.write({"daily_enriched": enriched}, {"daily_enriched": gone})
    counts = series_periods(build.table("daily_enriched", periods))
    build.write({"series_periods": counts}, {"series_periods": gone})


def affected_periods(changed: DataFrame, series: DataFrame, reach: int = REACH) -> DataFrame:
    """(symbol, read_from, write_from, write_to, read_to): the periods that changed days reach.

    ``changed`` has (symbol, period), ``series`` (symbol, period, n_rows, n_mood).  Written are the periods
    from the last sentiment row before the first change (its next day changes) to the one in which ``reach``
    rows, with and without sentiment, follow the last change.  Read are ``reach`` more rows before, and the
    next sentiment row after.
    """
    spans = changed.groupBy("symbol").agg(F.min("period").alias("first"), F.max("period").alias("last"))
    known = spans.join(series, "symbol", "left")
    one = Window.partitionBy("symbol")
    has_mood = F.col("n_mood") > 0
    edges = known.withColumn(
        "write_from",
        F.coalesce(F.max(F.when((F.col("period") < F.col("first")) & has_mood, F.col("period"))).over(one), "first"),
    )
    is_before, is_after = F.col("period") < F.col("write_from"), F.col("period") > F.col("last")
    newest, oldest = one.orderBy(F.col("period").desc()), one.orderBy("period")

    def enough(inside: Column, order) -> Column:
        rows, mood = (F.sum(F.when(inside, F.col(name))).over(order) for name in ("n_rows", "n_mood"))
        return inside & (rows >= reach) & (mood >= reach)

    marked = edges.withColumns(
        {"far_before": enough(is_before, newest), "far_after": enough(is_after, oldest)}
    )
    ends = marked.groupBy("symbol", "write_from").agg(
        F.coalesce(F.max(F.when(F.col("far_before"), F.col("period"))), F.min("period"), F.min("first")).alias("read_from"),
        F.coalesce(
            F.min(F.when(F.col("far_after"), F.col("period"))), F.greatest(F.max("period"), F.max("last"))
        ).alias("write_to"),
    )
    later = (F.col("period") > F.col("write_to")) & has_mood
    return (
        ends.join(series, "symbol", "left").groupBy("symbol", "read_from", "write_from", "write_to")
        .agg(F.min(F.when(later, F.col("period"))).alias("next"))
        .select(
            "symbol", F.least("read_from", "write_from").alias("read_from"), "write_from", "write_to",
            F.coalesce("next", "write_to").alias("read_to"),
        )
    )


def _refresh_marts(build: Build, periods: list[int]) -> None:
    """Compute the marts' rows that changed days reach; keep all others as stored."""
    period = versions.period_of("date_day")
    rows = _differing(build, "daily_enriched", ["symbol", "date_day"])
    if rows is None:
        return
    changed = rows.select("symbol", period.alias("period")).distinct()
    series = build.table("series_periods").select(
        "symbol", versions.period_of("first_day").alias("period"), "n_rows", "n_mood"
    )
    ranges = build.kept("ranges", affected_periods(changed, series))

    def between(first: str, last: str) -> list[int]:
        each = ranges.select(F.explode(F.sequence(first, last))).distinct().collect()
        return [row[0] for row in each]

    read, write = _inside(build, between("read_from", "read_to")), between("write_from", "write_to")

    def renewed(name: str, source: str, mart: Callable[[DataFrame], DataFrame]) -> DataFrame:
        near = build.table(source, read).join(ranges, "symbol").filter(period.between(F.col("read_from"), F.col("read_to")))
        fresh = mart(near.drop(*ranges.columns[1:])).join(ranges, "symbol")
        stored = build.table(name, write).join(ranges, "symbol", "left")
        inside = period.between(F.col("write_from"), F.col("write_to"))
        names = build.state(name).struct().names
        return fresh.filter(inside).select(*names).unionByName(
            stored.filter(F.col("write_from").isNull() | ~inside).select(*names)
        )

    def write_marts(**marts: tuple[str, Callable[[DataFrame], DataFrame]]) -> None:
        frames = {name: renewed(name, *how) for name, how in marts.items()}
        build.write(frames, {name: versions.parts_of(name, build.state(name), write) for name in marts})
        build.test(*marts)

    write_marts(mart_price_analysis=("daily_enriched", gold.price_analysis))
    write_marts(**{
        CORRELATION: ("mart_price_analysis", gold.sentiment_correlation),
        ANOMALIES: ("mart_price_analysis", gold.volume_anomalies),
    })


def _inside(build: Build, periods: Collection[int]) -> list[int]:
    """Those of some periods that have enriched rows."""
    state = build.state("daily_enriched")
    return [p for p in periods if versions.parts_of("daily_enriched", state, [p])]
