"""Data quality: row rules compiled into one aggregation, suites, output tests and the gate.

All row rules of a suite become ``count_if`` columns of a single ``agg``: one scan with map-side
partial results, whatever the number of rules.  Results have one row per rule: source, dataset, path,
rule, column, severity, n_rows, n_bad, success; dataset and path are null where rows were not read
from a stored run.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from candlewick.config import as_utc, run_partition
from candlewick.contracts import (
    DEFAULT_COINS,
    DEFAULT_SYMBOLS,
    GRAINS,
    SENTIMENT_BUCKETS,
    STORED_INTERVALS,
    DatasetSpec,
)
from candlewick.operators.grain import duplicate_keys, orphan_values
from candlewick.sources.bronze import read_run

ERROR, WARN = "error", "warn"
IMPLAUSIBLE = "close <= 0 OR volume < 0 OR quote_volume < 0"


@dataclass(frozen=True)
class Failure:
    """A rule that was broken, and how often."""

    source: str
    dataset: str | None
    rule: str
    column: str
    n_bad: int

    def __str__(self) -> str:
        checked = f"{self.source}/{self.dataset}" if self.dataset else self.source
        return f"{checked} {self.rule}({self.column}) x {self.n_bad}"


class QualityGateError(RuntimeError):
    """Raised when a gate stops a run; ``failures`` are the broken rules, ``sources`` theirs."""

    def __init__(self, failures: Sequence[Failure]):
        super().__init__("; ".join(sorted(map(str, failures))))
        self.failures = tuple(failures)
        self.sources = sorted({failure.source for failure in failures})


@dataclass(frozen=True)
class Rule:
    """A row rule: ``violation(schema)`` is an SQL condition, true for rows that break it."""

    name: str
    column: str
    violation: Callable[[StructType], str]
    severity: str = ERROR


@dataclass(frozen=True)
class Suite:
    source: str
    rules: tuple[Rule, ...]
    min_rows: int = 1


# ---------------------------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------------------------


def _missing(schema: StructType, column: str) -> str:
    """Null, or NaN for floating-point columns."""
    if isinstance(schema[column].dataType, (DoubleType, FloatType)):
        return f"(`{column}` IS NULL OR isnan(`{column}`))"
    return f"(`{column}` IS NULL)"


def not_null(column: str, severity: str = ERROR, nan_is_null: bool = True) -> Rule:
    """Raw input counts NaN as missing; modelled tables are tested for null alone."""

    def violation(schema: StructType) -> str:
        return _missing(schema, column) if nan_is_null else f"`{column}` IS NULL"

    return Rule("not_null", column, violation, severity)


def in_set(column: str, values: Sequence[str], severity: str = ERROR) -> Rule:
    """Nulls pass; ``not_null`` is their rule."""
    literals = ", ".join("'" + value.replace("'", "\\'") + "'" for value in values)
    return Rule("in_set", column, lambda schema: f"`{column}` NOT IN ({literals})", severity)


def between(
    column: str,
    low: float | None = None,
    high: float | None = None,
    above: float | None = None,
    severity: str = ERROR,
) -> Rule:
    """``low``/``high`` are inclusive bounds, ``above`` a strict lower one; missing values pass."""
    limits = {"<": low, "<=": above, ">": high}
    outside = " OR ".join(
        f"`{column}` {op} {bound}" for op, bound in limits.items() if bound is not None
    )
    return Rule(
        "positive" if above == 0 and high is None else "between", column,
        lambda schema: f"NOT {_missing(schema, column)} AND ({outside})", severity,
    )


def at_least(column: str, other: str, severity: str = ERROR) -> Rule:
    """``column >= other``; passes if both are missing, fails if only one is."""

    def violation(schema: StructType) -> str:
        gone, other_gone = _missing(schema, column), _missing(schema, other)
        return f"{gone} != {other_gone} OR (NOT {gone} AND `{column}` < `{other}`)"

    return Rule("at_least", f"{column},{other}", violation, severity)


def required(column: str) -> Rule:
    """The column exists; every row counts where it does not."""
    return Rule(
        "required", column, lambda schema: str(column not in schema.names).lower()
    )


def timestamp(column: str) -> Rule:
    """The column is a timestamp, or absent (then ``required`` is its rule)."""

    def violation(schema: StructType) -> str:
        return str(column in schema.names and not _is_timestamp(schema, column)).lower()

    return Rule("timestamp", column, violation)


def _is_timestamp(schema: StructType, column: str) -> bool:
    return column in schema.names and isinstance(
        schema[column].dataType, (TimestampType, TimestampNTZType)
    )


# ---------------------------------------------------------------------------------------------
# Input suites (Bronze)
# ---------------------------------------------------------------------------------------------


def market_chart_suite(coins: Sequence[str] = DEFAULT_COINS) -> Suite:
    return Suite("coingecko", (
        not_null("date"),
        not_null("coin_id"),
        in_set("coin_id", coins),
        not_null("price_usd"),
        between("price_usd", above=0),
        not_null("volume_usd"),
        between("volume_usd", low=0),
        between("market_cap_usd", low=0),
    ))


def klines_suite(
    symbols: Sequence[str] = DEFAULT_SYMBOLS, intervals: Sequence[str] = ("1d",)
) -> Suite:
    return Suite("binance", (
        in_set("symbol", symbols),
        in_set("interval", intervals),
        not_null("open"),
        between("open", above=0),
        between("high", above=0),
        between("low", above=0),
        not_null("close"),
        between("close", above=0),
        at_least("high", "low"),
        not_null("volume"),
        between("volume", low=0),
    ))


def sentiment_suite() -> Suite:
    return Suite("feargreed", (
        not_null("date"),
        not_null("fear_greed_value"),
        between("fear_greed_value", low=0, high=100),
        in_set("sentiment_bucket", SENTIMENT_BUCKETS),
        not_null("sentiment_label"),
    ))


SUITES: dict[str, Callable[..., Suite]] = {
    "coingecko": market_chart_suite,
    "binance": klines_suite,
    "feargreed": sentiment_suite,
}


def suite_for(source: str, **parameters) -> Suite:
    """The input suite of a source; unknown sources raise ``KeyError``."""
    if source not in SUITES:
        raise KeyError(f"Unknown source '{source}'; suites exist for {sorted(SUITES)}")
    return SUITES[source](**parameters)


# ---------------------------------------------------------------------------------------------
# Evaluation
# ---------------------------------------------------------------------------------------------


def _text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _result(
    source: str, rule: str, column: str, severity: str, n_rows: str, n_bad: str,
    dataset: str | None = None, path: str | None = None,
) -> str:
    return (
        f"named_struct('source', '{source}', 'dataset', {_text(dataset)}, 'path', {_text(path)}, "
        f"'rule', '{rule}', 'column', '{column}', "
        f"'severity', '{severity}', 'n_rows', {n_rows}, 'n_bad', {n_bad}, 'success', {n_bad} = 0)"
    )


def _bad_counts(schema: StructType, suite: Suite) -> list[Column]:
    return [
        F.expr(f"count_if({rule.violation(schema)}) AS bad_{i}")
        for i, rule in enumerate(suite.rules)
    ]


def evaluate(
    rows: DataFrame, suite: Suite, dataset: str | None = None, path: str | None = None
) -> DataFrame:
    """One result row per rule, from a single aggregation over the rows.

    ``dataset`` and ``path`` say what was checked; datasets of one source are told apart by them.
    """
    counts = _bad_counts(rows.schema, suite)
    results = [
        _result(suite.source, rule.name, rule.column, rule.severity, "total", f"bad_{i}", dataset, path)
        for i, rule in enumerate(suite.rules)
    ]
    if suite.min_rows > 0:
        short = f"greatest({suite.min_rows} - total, 0L)"
        results.insert(
            0, _result(suite.source, "row_count", "*", ERROR, "total", short, dataset, path)
        )
    totals = rows.agg(F.expr("count(*) AS total"), *counts)
    return totals.selectExpr(f"inline(array({', '.join(results)}))")


def _check(source: str, rule: str, column: str, severity: str, failures: DataFrame) -> DataFrame:
    """One result row of a set-level check, from its failing groups and their row counts."""
    result = _result(source, rule, column, severity, "CAST(NULL AS BIGINT)", "n_bad")
    bad = failures.agg(F.expr("coalesce(sum(n_rows), 0L) AS n_bad"))
    return bad.selectExpr(f"inline(array({result}))")


def check_unique(
    rows: DataFrame, keys: Sequence[str], source: str, rule: str = "grain", severity: str = ERROR
) -> DataFrame:
    """``n_bad`` is the number of repeated keys."""
    repeated = duplicate_keys(rows, keys).select(F.lit(1).cast("bigint").alias("n_rows"))
    return _check(source, rule, ",".join(keys), severity, repeated)


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, source: str, severity: str = ERROR
) -> DataFrame:
    """``n_bad`` is the number of child rows whose value the parent lacks."""
    return _check(source, "relationships", column, severity, orphan_values(child, column, parent))


def stale_days(rows: DataFrame, as_of: date, max_age_days: int = 3, day: str = "date_day"):
    """(latest_day, today) if the newest row is more than ``max_age_days`` old, else no row."""
    return rows.agg(F.max(day).alias("latest_day")).select(
        "latest_day", F.lit(as_of).alias("today")
    ).filter(F.col("latest_day") < F.date_sub(F.lit(as_of), max_age_days))


def out_of_range_sentiment(silver_sentiment: DataFrame) -> DataFrame:
    """Index rows outside 0 to 100."""
    return silver_sentiment.filter(~F.col("fear_greed_value").between(0, 100))


def implausible_candles(silver_klines: DataFrame) -> DataFrame:
    """Candles with a close that is not positive or a negative volume."""
    return silver_klines.filter(IMPLAUSIBLE)


def output_tests(
    tables: dict[str, DataFrame], as_of: date, only: Collection[str] | None = None
) -> DataFrame:
    """The 38 tests on Silver and Gold; the keys of ``tables`` are those of ``contracts.GRAINS``.

    ``only`` names the tables whose tests are wanted; these tables and the ones that they refer to
    have to be there.
    """

    def row_tests(name: str, *rules: Rule) -> DataFrame:
        return evaluate(tables[name], Suite(name, rules, min_rows=0))

    def grain(name: str) -> DataFrame:
        return check_unique(tables[name], GRAINS[name], name)

    def days_of(name: str, parent: str) -> DataFrame:
        return check_relationship(tables[name], "date_day", tables[parent], name)

    def keys(*names: str) -> list[Rule]:
        return [not_null(name, nan_is_null=False) for name in names]

    def no_stale_day() -> DataFrame:
        stale = stale_days(tables["mart_price_analysis"], as_of)
        found = stale.select(F.lit(1).cast("bigint").alias("n_rows"))
        return _check("mart_price_analysis", "freshness", "date_day", WARN, found)

    def one_row_a_day() -> DataFrame:
        known = tables["silver_sentiment"].filter("date_day IS NOT NULL")
        return check_unique(known, ["date_day"], "silver_sentiment", rule="unique")

    plausible = Rule("plausible", "close,volume,quote_volume", lambda schema: IMPLAUSIBLE)
    tests: dict[str, Callable[[str], list[DataFrame]]] = {
        "silver_market_chart": lambda name: [
            row_tests(name, *keys("date_day", "coin_id", "price_usd", "volume_usd")),
            grain(name),
        ],
        "silver_klines": lambda name: [
            row_tests(
                name,
                *keys("open_time", "symbol", "interval", "close", "volume"),
                in_set("interval", STORED_INTERVALS),
                plausible,
            ),
            grain(name),
        ],
        "silver_sentiment": lambda name: [
            row_tests(
                name,
                *keys("date_day", "fear_greed_value", "sentiment_label", "sentiment_bucket"),
                in_set("sentiment_label", SENTIMENT_BUCKETS, severity=WARN),
                in_set("sentiment_bucket", SENTIMENT_BUCKETS),
                between("fear_greed_value", low=0, high=100),
            ),
            one_row_a_day(),
        ],
        "daily_enriched": lambda name: [
            row_tests(name, *keys("date_day", "symbol", "close")),
            grain(name),
        ],
        "mart_price_analysis": lambda name: [
            row_tests(name, *keys("date_day", "symbol", "close")),
            grain(name),
            days_of(name, "daily_enriched"),
            no_stale_day(),
        ],
        "mart_sentiment_correlation": lambda name: [
            row_tests(name, *keys("date_day", "symbol")),
            days_of(name, "mart_price_analysis"),
        ],
        "mart_volume_anomalies": lambda name: [
            row_tests(name, *keys("date_day", "symbol", "is_volume_anomaly")),
            days_of(name, "mart_price_analysis"),
        ],
    }
    wanted = [name for name in tests if only is None or name in only]
    results = [result for name in wanted for result in tests[name](name)]
    return reduce(DataFrame.unionByName, results).drop("dataset", "path")


# ---------------------------------------------------------------------------------------------
# Pre-write validation
# ---------------------------------------------------------------------------------------------


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_rows, n_null) of several columns, from one aggregation."""
    schema = rows.schema
    counts = [F.expr(f"count_if({_missing(schema, c)}) AS null_{i}") for i, c in enumerate(columns)]
    items = ", ".join(
        f"named_struct('column', '{c}', 'n_rows', total, 'n_null', null_{i})"
        for i, c in enumerate(columns)
    )
    return rows.agg(F.expr("count(*) AS total"), *counts).selectExpr(f"inline(array({items}))")


@dataclass(frozen=True)
class Profile:
    """Counts of one dataset and the rules of its spec that it breaks, from one aggregation."""

    row_count: int
    min_time: datetime | None
    max_time: datetime | None
    errors: tuple[Failure, ...]

    @property
    def status(self) -> str:
        return "FAIL" if self.errors else "PASS"


def contract_suite(spec: DatasetSpec, present: Collection[str]) -> Suite:
    """What rows with these columns must meet before they are stored."""
    return Suite(spec.source, (
        *(required(name) for name in spec.required),
        *(not_null(name) for name in spec.non_null if name in present),
        timestamp(spec.time_col),
    ))


def profile_measures(schema: StructType, spec: DatasetSpec) -> list[Column]:
    """Aggregates that ``profile_of`` needs; they can be observed while rows are written."""
    counts = [F.count(F.lit(1)).alias("total"), *_bad_counts(schema, contract_suite(spec, schema.names))]
    if _is_timestamp(schema, spec.time_col):
        counts += [F.min(spec.time_col).alias("first"), F.max(spec.time_col).alias("last")]
    return counts


def profile_of(found: Mapping[str, object], schema: StructType, spec: DatasetSpec) -> Profile:
    """What the measures of ``profile_measures`` say."""
    suite = contract_suite(spec, schema.names)
    broken = [(rule.name, rule.column, found[f"bad_{i}"]) for i, rule in enumerate(suite.rules)]
    broken.insert(0, ("row_count", "*", max(0, suite.min_rows - found["total"])))
    errors = tuple(Failure(spec.source, spec.dataset, *rule) for rule in broken if rule[-1])
    return Profile(found["total"], found.get("first"), found.get("last"), errors)


def profile(rows: DataFrame, spec: DatasetSpec) -> Profile:
    """Check a dataset against its spec and count its rows; without rows only their number fails."""
    found = rows.agg(*profile_measures(rows.schema, spec)).first().asDict()
    return profile_of(found, rows.schema, spec)


# ---------------------------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class DocumentCount:
    """How many documents of a dataset were parsed, and how many of them were set apart as faulty."""

    source: str
    dataset: str
    n_documents: int
    n_rejected: int

    def failure(self, limit: int = 0) -> Failure | None:
        """The broken rule, if more documents than the limit are faulty."""
        if self.n_rejected <= limit:
            return None
        return Failure(self.source, self.dataset, "malformed", "body", self.n_rejected)


def document_results(spark: SparkSession, counts: Collection[DocumentCount], limit: int = 0) -> DataFrame:
    """One result row per dataset for its documents; it succeeds up to ``limit`` faulty ones."""
    rows = [
        (c.source, c.dataset, None, "malformed", "body", ERROR, c.n_documents, c.n_rejected, c.failure(limit) is None)
        for c in counts
    ]
    return spark.createDataFrame(
        rows,
        "source STRING, dataset STRING, path STRING, rule STRING, column STRING, severity STRING, n_rows BIGINT, "
        "n_bad BIGINT, success BOOLEAN",
    )


# ---------------------------------------------------------------------------------------------
# Gate
# ---------------------------------------------------------------------------------------------


def outcomes(results: DataFrame) -> DataFrame:
    """(source, dataset, success, n_failed, n_warned): warnings are reported but fail nothing.

    Results without a dataset (output tests) are summed up by source alone.
    """
    failed = ~F.col("success") & (F.col("severity") == ERROR)
    warned = ~F.col("success") & (F.col("severity") == WARN)
    checked = [name for name in ("source", "dataset") if name in results.columns]
    return results.groupBy(*checked).agg(
        (F.count_if(failed) == 0).alias("success"),
        F.count_if(failed).alias("n_failed"),
        F.count_if(warned).alias("n_warned"),
    )


def enforce(results: DataFrame) -> None:
    """Stop the run if an error rule failed (only failed rules reach the driver)."""
    failed = results.filter(~F.col("success") & (F.col("severity") == ERROR)).collect()
    if failed:
        rows = [row.asDict() for row in failed]
        raise QualityGateError([
            Failure(row["source"], row.get("dataset"), row["rule"], row["column"], row["n_bad"])
            for row in rows
        ])


def gate(
    spark: SparkSession,
    written: dict[str, str],
    suites: dict[str, Suite],
    results_uri: str | None = None,
    run_ts: datetime | None = None,
    documents: DataFrame | None = None,
) -> DataFrame:
    """Read every written run back, check it against its suite, and stop the run on errors.

    A missing path fails before anything is read, unless faulty documents may be the cause: then their
    results (``documents``, see ``document_results``) are kept and stop the run.  Results are appended to ``results_uri`` (also
    when the gate fails) and returned.
    """
    missing = sorted(name for name in suites if not written.get(name))
    if missing:
        if documents is not None:
            _keep_results(documents, results_uri, run_ts)
            enforce(documents)
        raise QualityGateError([Failure(name, None, "stored_run", "path", 1) for name in missing])
    checked = [
        evaluate(read_run(spark, written[name]), suite, name, written[name]) for name, suite in suites.items()
    ]
    results = reduce(DataFrame.unionByName, checked if documents is None else [*checked, documents])
    results = _keep_results(results, results_uri, run_ts)
    enforce(results)
    return results


def _keep_results(results: DataFrame, results_uri: str | None, run_ts: datetime | None) -> DataFrame:
    """The results as stored in the run's partition of a table, if there is one."""
    if not results_uri:
        return results
    run_dir = run_partition(results_uri, run_ts)
    results.withColumn("run_ts", F.lit(as_utc(run_ts))).write.mode("overwrite").parquet(run_dir)
    return results.sparkSession.read.schema(results.schema).parquet(run_dir)
