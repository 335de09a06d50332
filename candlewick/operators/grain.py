"""Grain, uniqueness, referential and gap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.rolling import series


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (empty = the grain holds)."""
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    )


def orphan_values(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Non-null child values without a parent, with their row count.

    Both sides are reduced to their distinct values first, so the join moves values, not rows.
    """
    values = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return values.join(known, column, "left_anti")


def day_spans(daily: DataFrame, entity: str = "symbol", day: str = "date_day") -> DataFrame:
    """The days of daily rows as spans: (entity, first_day, last_day, n_rows) per run of calendar days."""
    return merged_spans(
        daily.select(entity, F.col(day).alias("first_day"), F.col(day).alias("last_day"), F.lit(1).cast("bigint").alias("n_rows")),
        entity,
    )


def merged_spans(spans: DataFrame, entity: str = "symbol") -> DataFrame:
    """Spans that overlap or follow each other without a gap, as one.

    Stored spans and those of a new day merge like any others, so coverage is kept up to date from a few
    rows per entity.  One exchange, by entity: daily rows of an entity are bounded by the calendar.  Rows
    without a day count to the entity's last span.
    """
    before = series(entity, "first_day").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("last_day").over(before)
    starts = F.coalesce(F.col("first_day") > F.date_add(reached, 1), F.lit(False)).cast("int")
    numbered = spans.withColumn("_starts", starts).withColumn(
        "_span", F.sum("_starts").over(series(entity, "first_day").rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(entity, "_span").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("n_rows").alias("n_rows")
    ).drop("_span")


def span_gaps(spans: DataFrame, entity: str = "symbol", day: str = "date_day") -> DataFrame:
    """The calendar days between an entity's merged spans; only the holes are expanded."""
    pairs = spans.select(
        entity,
        F.col("last_day").alias("_from"),
        F.lead("first_day").over(series(entity, "first_day")).alias("_to"),
    )
    holes = pairs.filter(F.datediff("_to", "_from") > 1)
    return holes.select(
        entity,
        F.explode(F.sequence(F.date_add("_from", 1), F.date_sub("_to", 1))).alias(day),
    )


def span_coverage(spans: DataFrame, entity: str = "symbol") -> DataFrame:
    """Per entity: first and last day, rows and missing days, from its merged spans."""
    covered = F.sum(F.datediff("last_day", "first_day") + 1)
    return spans.groupBy(entity).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("n_rows").alias("n_rows"),
        covered.alias("_covered"),
    ).select(
        entity, "first_day", "last_day", "n_rows",
        (F.datediff("last_day", "first_day") + 1 - F.col("_covered")).alias("n_missing"),
    )


def missing_days(
    daily: DataFrame, entity: str = "symbol", day: str = "date_day"
) -> DataFrame:
    """Calendar days between an entity's first and last row that have no row."""
    return span_gaps(day_spans(daily, entity, day), entity, day)


def series_coverage(
    daily: DataFrame, entity: str = "symbol", day: str = "date_day"
) -> DataFrame:
    """Per entity: first and last day, rows and missing days."""
    return span_coverage(day_spans(daily, entity, day), entity)
