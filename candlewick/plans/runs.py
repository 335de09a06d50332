"""Whole runs: the daily run, the backfill and the Bronze-to-Gold transform.

Scheduling and retries belong to an external scheduler; a run is a plain function that may be
called again with the same ``run_ts`` and replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from candlewick.config import LakeConfig, as_utc, prepare_session, run_partition, table_uri
from candlewick.contracts import DATASETS, GRAINS, LAYOUTS, MARTS, DatasetSpec, dataset_spec
from candlewick.operators.quality import (
    DocumentCount,
    Suite,
    document_results,
    enforce,
    gate,
    klines_suite,
    market_chart_suite,
    output_tests,
    profile_measures,
    profile_of,
    sentiment_suite,
)
from candlewick.plans import models
from candlewick.plans.models import BronzeReader, TableCheck, in_parallel
from candlewick.plans.serving import publish
from candlewick.sources import versions
from candlewick.sources.bronze import (
    WriteReceipt,
    kline_run_window,
    logical_date_slice,
    read_bronze,
    stage_bronze,
    write_bronze_if_any,
)
from candlewick.sources.files import remove
from candlewick.sources.payloads import rejected, tolerant_rows

# A half-open span of fetch times.
Span = tuple[datetime, datetime]
FETCH_DATE = "fetch_date"
INGEST_LOG = (
    "source STRING, dataset STRING, ingested_at TIMESTAMP, row_count BIGINT, path STRING, "
    "written_at TIMESTAMP, min_time TIMESTAMP, max_time TIMESTAMP"
)
SUMMARY = (
    "source STRING, dataset STRING, status STRING, row_count BIGINT, min_time TIMESTAMP, "
    "max_time TIMESTAMP, path STRING, "
    "errors ARRAY<STRUCT<rule: STRING, column: STRING, n_bad: BIGINT>>, problem STRING"
)


def _payloads(landing: DataFrame, spec: DatasetSpec) -> DataFrame:
    return landing.filter((F.col("source") == spec.source) & (F.col("dataset") == spec.dataset))


def fetched_within(landing: DataFrame, span: Span | None) -> DataFrame:
    """Payload documents fetched in a span (all without one).

    Where the landing table is partitioned by ``fetch_date`` (UTC), other dates are never read, so a
    run neither parses old documents nor fails on a malformed one among them.
    """
    if span is None:
        return landing
    start, end = (as_utc(moment) for moment in span)
    chosen = landing.filter((F.col("fetched_at") >= F.lit(start)) & (F.col("fetched_at") < F.lit(end)))
    if FETCH_DATE in landing.columns:
        last = (end - timedelta(microseconds=1)).date()
        chosen = chosen.filter(F.col(FETCH_DATE).between(F.lit(start.date()), F.lit(last)))
    return chosen


def materialise_all(
    tables: Mapping[str, DataFrame], partitions: Mapping[str, Sequence[str]] | None = None
) -> dict[str, DataFrame]:
    """Rebuild several independent tables at the same time; keys are their URIs."""

    def rebuild(uri: str, rows: DataFrame) -> Callable[[], DataFrame]:
        return lambda: materialise(rows, uri, (partitions or {}).get(uri, ()))

    return in_parallel({uri: rebuild(uri, rows) for uri, rows in tables.items()})


def materialise(df: DataFrame, uri: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rebuild a table and read it back: later plans start from files, with known sizes."""
    spark = prepare_session(df.sparkSession)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(uri)
    return spark.read.schema(df.schema).parquet(uri).select(*df.columns)


# ---------------------------------------------------------------------------------------------
# Transform
# ---------------------------------------------------------------------------------------------


def transform(
    spark: SparkSession,
    cfg: LakeConfig,
    coin_of_symbol: DataFrame | None = None,
    reader: BronzeReader = read_bronze,
    check: TableCheck | None = None,
    run_ts: datetime | None = None,
) -> dict[str, DataFrame]:
    """Rebuild Silver, the enriched table and the marts from all of Bronze.

    The tables are written as a new version: ``check`` sees each step's tables, and only when it has let
    all of them pass are they made visible.
    ``reader`` is ``read_bronze`` for trees written here; use ``drift.read_drifted`` for trees that
    (also) hold files of other writers.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    return models.rebuild(spark, cfg, run_ts, coin_of_symbol, reader, check)


def stored_tables(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """The visible Silver and Gold tables; none before the first transform."""
    snapshot = versions.current(spark, cfg)
    return {
        name: versions.read_version(spark, cfg, name, snapshot.tables[name]).drop(*LAYOUTS[name].hidden)
        for name in (GRAINS if snapshot else ())
    }


# ---------------------------------------------------------------------------------------------
# Daily run
# ---------------------------------------------------------------------------------------------


def default_suites() -> dict[str, Suite]:
    """Input suites per dataset; both stored candle intervals are gated."""
    return {
        "market_chart": market_chart_suite(),
        "klines_1d": klines_suite(intervals=("1d",)),
        "klines_1h": klines_suite(intervals=("1h",)),
        "index": sentiment_suite(),
    }


def daily_slice(rows: DataFrame, dataset: str, day: date) -> DataFrame:
    """What one logical date takes from the rows of a dataset."""
    take = kline_run_window if dataset.startswith("klines") else logical_date_slice
    return take(rows, day, dataset_spec(dataset).time_col)


@dataclass(frozen=True)
class Ingest:
    """What a run took in: the path of each dataset ("" where it has no rows) and its documents."""

    written: dict[str, str]
    documents: tuple[DocumentCount, ...]


def _counted(spec: DatasetSpec, seen: Observation) -> DocumentCount:
    return DocumentCount(spec.source, spec.dataset, seen.get["n_documents"], seen.get["n_rejected"])


def quarantine(
    spark: SparkSession, cfg: LakeConfig, documents: DataFrame, counts: Collection[DocumentCount], run_ts: datetime
) -> None:
    """Keep a run's faulty documents with their reasons in the ``quarantine`` table, by run and dataset.

    Only datasets that have any are read again; what an earlier try of the run left is replaced.
    """
    for count in counts:
        uri = run_partition(table_uri(cfg, "quality", "quarantine"), run_ts) + f"/dataset={count.dataset}"
        if count.n_rejected:
            faulty = rejected(_payloads(documents, dataset_spec(count.dataset)), count.dataset)
            faulty.drop("dataset").write.mode("overwrite").parquet(uri)
        else:
            remove(spark, uri)


def ingest_day(
    spark: SparkSession,
    landing: DataFrame,
    cfg: LakeConfig,
    run_ts: datetime,
    fetched: Span | None = None,
) -> Ingest:
    """Write one logical date of every dataset; faulty documents are set apart.

    Documents are parsed once: rows, times and faulty documents are counted while the run is written.
    """
    documents = fetched_within(landing, fetched)

    def ingest(spec: DatasetSpec) -> Callable[[], tuple[WriteReceipt | None, DocumentCount]]:
        def task() -> tuple[WriteReceipt | None, DocumentCount]:
            seen = Observation()
            rows = tolerant_rows(_payloads(documents, spec), spec.dataset, seen)
            receipt = write_bronze_if_any(daily_slice(rows, spec.dataset, as_utc(run_ts).date()), cfg, spec, run_ts)
            return receipt, _counted(spec, seen)

        return task

    outcome = in_parallel({spec.dataset: ingest(spec) for spec in DATASETS})
    counts = tuple(count for _, count in outcome.values())
    quarantine(spark, cfg, documents, counts, run_ts)
    log_ingest(spark, cfg, {name: receipt for name, (receipt, _) in outcome.items()}, run_ts)
    return Ingest({name: receipt.path if receipt else "" for name, (receipt, _) in outcome.items()}, counts)


def log_ingest(
    spark: SparkSession,
    cfg: LakeConfig,
    receipts: Mapping[str, WriteReceipt | None],
    run_ts: datetime,
) -> None:
    """Keep what a run stored (source, dataset, time, rows, path) in the ``ingest_log`` table."""
    now = datetime.now(timezone.utc)
    rows = [
        (
            dataset_spec(name).source, name, as_utc(run_ts), receipt.row_count, receipt.path, now,
            receipt.min_time, receipt.max_time,
        )
        for name, receipt in receipts.items() if receipt
    ]
    if rows:
        # other datasets' lines of the same run stay
        spark.createDataFrame(rows, INGEST_LOG).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("dataset").parquet(run_partition(table_uri(cfg, "quality", "ingest_log"), run_ts))


def run_daily(
    spark: SparkSession,
    cfg: LakeConfig,
    landing: DataFrame,
    run_ts: datetime,
    suites: Mapping[str, Suite] | None = None,
    coin_of_symbol: DataFrame | None = None,
    sink=None,
    as_of: date | None = None,
    reader: BronzeReader = read_bronze,
    fetched: Span | None = None,
    max_rejected: int = 0,
) -> dict[str, DataFrame]:
    """Ingest one date, gate it, bring the models up to date, test them and publish the marts.

    Models take in the runs that they do not hold yet (``models.refresh``); with another ``reader`` they are
    rebuilt from all of Bronze.  A failing gate raises before any model is touched.  Each step's tables are
    tested as they are built, and a failing test leaves all visible tables and the serving store as they
    were.  Both leave their results in the quality tables.  ``fetched`` limits the run to the documents of a
    span.  Faulty documents go to the ``quarantine`` table; more than ``max_rejected`` in a dataset fail the
    gate, after the sound ones were stored.
    """
    prepare_session(spark, cfg)
    taken = ingest_day(spark, landing, cfg, run_ts, fetched)
    input_results = gate(
        spark, taken.written, dict(suites or default_suites()),
        table_uri(cfg, "quality", "input_results"), run_ts,
        document_results(spark, taken.documents, max_rejected),
    )
    results_uri = run_partition(table_uri(cfg, "quality", "output_results"), run_ts)
    steps: list[DataFrame] = []

    def check(tables: dict[str, DataFrame], names: Collection[str]) -> None:
        found = output_tests(tables, as_of or as_utc(run_ts).date(), names)
        stamped = found.withColumns({"run_ts": F.lit(as_utc(run_ts)), "step": F.lit(len(steps))})
        # the first step replaces what an earlier try of this run left, the others add to it
        mode = "append" if steps else "overwrite"
        stamped.write.mode(mode).partitionBy("step").parquet(results_uri)
        kept = spark.read.schema(stamped.schema).parquet(results_uri)
        steps.append(kept.filter(F.col("step") == len(steps)).drop("run_ts", "step"))
        enforce(steps[-1])

    if reader is read_bronze:
        tables = models.refresh(spark, cfg, run_ts, coin_of_symbol, check)
    else:
        tables = transform(spark, cfg, coin_of_symbol, reader, check, run_ts)
    output_results = reduce(DataFrame.unionByName, steps)
    if sink is not None:
        publish({name: tables[name] for name in MARTS}, sink)
    return {**tables, "input_results": input_results, "output_results": output_results}


# ---------------------------------------------------------------------------------------------
# Backfill
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BackfillReport:
    """One summary row per dataset; ``ok`` is false if any dataset did not pass.

    ``errors`` are the broken rules of a dataset with status FAIL, ``problem`` says what stopped one
    with status ERROR.
    """

    summary: DataFrame
    ok: bool


@dataclass(frozen=True)
class DatasetBackfill:
    """One dataset's summary row, what it stored, and its documents (None where an error came first)."""

    row: tuple
    receipt: WriteReceipt | None = None
    documents: DocumentCount | None = None


def backfill_dataset(
    landing: DataFrame, cfg: LakeConfig, spec: DatasetSpec, run_ts: datetime, since: date | None,
    max_rejected: int = 0,
) -> DatasetBackfill:
    """Write, validate and publish one dataset's whole history; any error becomes its summary row.

    Documents are parsed once: the run is staged while its rules are counted, then put in place or dropped.
    """
    try:
        seen = Observation()
        rows = tolerant_rows(_payloads(landing, spec), spec.dataset, seen)
        if since is not None:
            rows = rows.filter(F.col(spec.time_col) >= F.lit(since.isoformat()).cast("timestamp"))
        staged = stage_bronze(rows, cfg, spec, run_ts, profile_measures(rows.schema, spec))
        found, documents = profile_of(staged.counts, rows.schema, spec), _counted(spec, seen)
        errors = [*found.errors, *filter(None, [documents.failure(max_rejected)])]
        receipt = None
        if errors:
            staged.drop()
        else:
            receipt = staged.publish()
    except Exception as problem:  # one dataset must not stop the others
        return DatasetBackfill((spec.source, spec.dataset, "ERROR", 0, None, None, None, [], str(problem)))
    row = (
        spec.source, spec.dataset, "FAIL" if errors else "PASS", found.row_count, found.min_time, found.max_time,
        receipt.path if receipt else None, [(error.rule, error.column, error.n_bad) for error in errors], None,
    )
    return DatasetBackfill(row, receipt, documents)


def run_backfill(
    spark: SparkSession,
    cfg: LakeConfig,
    landing: DataFrame,
    run_ts: datetime,
    since: Mapping[str, date] | None = None,
    specs: Sequence[DatasetSpec] = DATASETS,
    max_rejected: int = 0,
) -> BackfillReport:
    """Write the full history of every dataset under the run date; Silver absorbs the overlap.

    A dataset with more than ``max_rejected`` faulty documents fails and stores nothing; they are kept in the
    ``quarantine`` table.
    """
    prepare_session(spark, cfg)
    starts = since or {}
    outcome = in_parallel({
        spec.dataset: (
            lambda spec=spec: backfill_dataset(
                landing, cfg, spec, run_ts, starts.get(spec.dataset), max_rejected
            )
        )
        for spec in specs
    })
    counts = [done.documents for done in outcome.values() if done.documents]
    quarantine(spark, cfg, landing, counts, run_ts)
    log_ingest(spark, cfg, {name: done.receipt for name, done in outcome.items()}, run_ts)
    rows = [done.row for done in outcome.values()]
    return BackfillReport(
        spark.createDataFrame(rows, SUMMARY), all(row[2] == "PASS" for row in rows)
    )
