"""Bronze Parquet: run-partitioned idempotent writes, contract reads, logical-date slices.

Partitions hold the *run* date.  A run owns one directory named after its timestamp, so writing
the same run again replaces it and other runs of the day stay.  No shuffle is needed to write:
all rows of a run go to the same partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, StructType, TimestampNTZType

from candlewick.config import LakeConfig, dataset_uri, prepare_session, run_uri
from candlewick.contracts import RUN_PARTITIONS, DatasetSpec
from candlewick.sources.files import move, remove, remove_if_empty


@dataclass(frozen=True)
class WriteReceipt:
    """What a Bronze write stored; measured while writing, not by a second pass."""

    path: str
    row_count: int
    min_time: datetime | None
    max_time: datetime | None


def write_bronze(
    df: DataFrame,
    cfg: LakeConfig,
    spec: DatasetSpec,
    run_ts: datetime,
    layer: str = "bronze",
) -> WriteReceipt:
    """Store one run of a dataset and return its path and counts."""
    path = run_uri(cfg, spec.source, spec.dataset, run_ts, layer)
    seen = Observation()
    measured = df.observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.min(spec.time_col).alias("min_time"),
        F.max(spec.time_col).alias("max_time"),
    )
    prepare_session(df.sparkSession, cfg)
    measured.write.mode("overwrite").parquet(path)
    counts = seen.get
    return WriteReceipt(path, counts["n_rows"], counts["min_time"], counts["max_time"])


@dataclass(frozen=True)
class StagedRun:
    """A run that is written but not part of its dataset yet, with what was measured while writing it."""

    spark: SparkSession
    draft: str
    path: str
    counts: Mapping[str, object]

    def publish(self) -> WriteReceipt:
        """Put the run in its place, instead of an earlier try's."""
        move(self.spark, self.draft, self.path)
        return WriteReceipt(self.path, self.counts["n_rows"], self.counts["min_time"], self.counts["max_time"])

    def drop(self) -> None:
        """Remove the run, and the directories that were made for it alone."""
        remove(self.spark, self.draft)
        folder = self.draft
        for _ in range(4):  # dataset, source, staging, root
            folder = folder.rpartition("/")[0]
            if not remove_if_empty(self.spark, folder):
                break


def stage_bronze(
    df: DataFrame, cfg: LakeConfig, spec: DatasetSpec, run_ts: datetime, measures: Sequence[Column] = ()
) -> StagedRun:
    """Write a run beside its dataset and take ``measures`` of its rows in the same pass."""
    seen = Observation()
    times = [F.min(spec.time_col), F.max(spec.time_col)] if spec.time_col in df.columns else [F.lit(None)] * 2
    own = [F.count(F.lit(1)).alias("n_rows"), times[0].alias("min_time"), times[1].alias("max_time")]
    spark = prepare_session(df.sparkSession, cfg)
    draft = f"{cfg.root}/staging/{spec.source}/{spec.dataset}/{uuid.uuid4().hex}"
    df.observe(seen, *own, *measures).write.mode("overwrite").parquet(draft)
    return StagedRun(spark, draft, run_uri(cfg, spec.source, spec.dataset, run_ts), seen.get)


def write_bronze_if_any(
    df: DataFrame, cfg: LakeConfig, spec: DatasetSpec, run_ts: datetime
) -> WriteReceipt | None:
    """Store a run unless it has no rows; they are computed once."""
    staged = stage_bronze(df, cfg, spec, run_ts)
    if staged.counts["n_rows"]:
        return staged.publish()
    staged.drop()
    return None


def with_run_partitions(schema: StructType) -> StructType:
    full = StructType(list(schema.fields))
    for name in RUN_PARTITIONS:
        full = full.add(name, IntegerType())
    return full


def read_bronze(spark: SparkSession, cfg: LakeConfig, spec: DatasetSpec) -> DataFrame:
    """All runs of a dataset under its contract schema plus year, month, day.

    Columns a file lacks read as null, extra ones are ignored.  Files of other writers with
    drifting types go through ``candlewick.sources.drift`` instead.
    """
    uri = dataset_uri(cfg, spec.source, spec.dataset)
    prepare_session(spark, cfg)
    return spark.read.schema(with_run_partitions(spec.schema)).parquet(uri)


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """Read one written run back (what the gate checks)."""
    if not path:
        raise ValueError("No path given: nothing was written for this dataset")
    if path.startswith("s3://"):
        path = f"s3a://{path[len('s3://'):]}"
    return spark.read.parquet(path)


def _bounds(df: DataFrame, time_col: str, start: date, end: date) -> tuple[Column, Column]:
    """Literals of the column's own type, so that the comparison reaches the Parquet scan."""
    kind = df.schema[time_col].dataType
    if isinstance(kind, DateType):
        return F.lit(start), F.lit(end)
    sql_type = "timestamp_ntz" if isinstance(kind, TimestampNTZType) else "timestamp"
    return F.lit(start.isoformat()).cast(sql_type), F.lit(end.isoformat()).cast(sql_type)


def time_span(df: DataFrame, start: date, end: date, time_col: str = "date") -> DataFrame:
    """Rows from the start of one UTC day to that of another, as a range that pushes down."""
    low, high = _bounds(df, time_col, start, end)
    return df.filter((F.col(time_col) >= low) & (F.col(time_col) < high))


def logical_date_slice(df: DataFrame, day: date, time_col: str = "date") -> DataFrame:
    """Rows of one UTC day, as a half-open range (pushes down, unlike ``to_date(col) = day``)."""
    return time_span(df, day, day + timedelta(days=1), time_col)


def kline_run_window(df: DataFrame, day: date, time_col: str = "open_time") -> DataFrame:
    """Candles of a run: from the run date to the start of the next day, both ends included."""
    start, end = _bounds(df, time_col, day, day + timedelta(days=1))
    return df.filter((F.col(time_col) >= start) & (F.col(time_col) <= end))
