"""Versioned tables: runs write beside what is visible and switch one small pointer file when all is well.

A table is a directory with one sub-directory per version that wrote to it, each partitioned by the
table's keys (``contracts.LAYOUTS``).  The pointer says, for every table, which version holds each
partition, so a run writes the partitions it changes and shares all others with the runs before.  What a
failing or killed run leaves behind is in no pointer and never read.  One run writes a lake at a time;
readers may read at any time and keep what they resolved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from candlewick.config import LakeConfig, as_utc, prepare_session, table_uri
from candlewick.contracts import LAYOUTS, Layout
from candlewick.sources.files import folders, read_text, remove, replace_text

VERSION = "version"
PERIOD = "period"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# A partition's values, as text (None for null), in the order of its table's keys.
Part = tuple[str | None, ...]


@dataclass(frozen=True)
class TableState:
    """A table's stored schema (JSON) and the version that holds each of its partitions."""

    schema: str
    parts: tuple[tuple[Part, str], ...] = ()

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Snapshot:
    """What the pointer says: the tables, and the Bronze runs that they hold (path to write time and bounds)."""

    version: str
    tables: Mapping[str, TableState] = field(default_factory=dict)
    absorbed: Mapping[str, Mapping[str, str | None]] = field(default_factory=dict)

    def with_table(self, name: str, state: TableState) -> "Snapshot":
        return replace(self, tables={**self.tables, name: state})


def new_version(run_ts: datetime) -> str:
    """A version of its own for every try of a run, so that no try touches what another one wrote."""
    return f"{as_utc(run_ts):%Y%m%d_%H%M%S}-{uuid.uuid4().hex[:8]}"


# ---------------------------------------------------------------------------------------------
# The pointer
# ---------------------------------------------------------------------------------------------


def pointer_uri(cfg: LakeConfig) -> str:
    return f"{cfg.root}/models/current.json"


def current(spark: SparkSession, cfg: LakeConfig) -> Snapshot | None:
    """The visible snapshot; None before the first one."""
    text = read_text(prepare_session(spark, cfg), pointer_uri(cfg))
    if text is None:
        return None
    found = json.loads(text)
    tables = {
        name: TableState(state["schema"], tuple((tuple(part), version) for part, version in state["parts"]))
        for name, state in found["tables"].items()
    }
    return Snapshot(found["version"], tables, found["absorbed"])


def switch(spark: SparkSession, cfg: LakeConfig, snapshot: Snapshot) -> None:
    """Make a snapshot the visible one."""
    replace_text(prepare_session(spark, cfg), pointer_uri(cfg), json.dumps(asdict(snapshot)))


# ---------------------------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------------------------


def layout_of(name: str) -> Layout:
    return LAYOUTS[name]


def period_of(day: str | Column) -> Column:
    """The period of a day by which tables are partitioned: its year."""
    return F.year(F.to_date(day) if isinstance(day, str) else day)


def _uri(cfg: LakeConfig, name: str) -> str:
    return table_uri(cfg, layout_of(name).layer, name)


def _folder(cfg: LakeConfig, name: str, part: Part, version: str) -> str:
    values = [_NULL_PARTITION if value is None else value for value in part]
    below = "/".join(f"{key}={value}" for key, value in zip(layout_of(name).keys, values))
    return f"{_uri(cfg, name)}/{VERSION}={version}/{below}"


def write_version(
    rows: DataFrame, cfg: LakeConfig, name: str, version: str, before: TableState | None = None,
    gone: Iterable[Part] = (),
) -> TableState:
    """Write rows as partitions of a version; the table's state with them in place of older ones.

    ``before`` is the state that is carried on for all partitions that the rows do not touch; ``gone``
    are partitions that are written anew and so vanish if no row is left for them.  The partitions written
    are observed while writing, and rows are spread so that large partitions have several writers.
    """
    layout = layout_of(name)
    keyed = rows.withColumn(PERIOD, period_of(layout.day)) if PERIOD in layout.keys else rows
    seen = Observation()
    values = F.struct(*(F.col(key).cast("string").alias(key) for key in layout.keys))
    written = keyed.hint("rebalance", *layout.keys).observe(seen, F.collect_set(values).alias("parts"))
    written.write.mode("overwrite").partitionBy(*layout.keys).parquet(f"{_uri(cfg, name)}/{VERSION}={version}")
    parts = {tuple(row): version for row in seen.get["parts"]}
    kept = {part: held for part, held in (before.parts if before else ()) if part not in set(gone)}
    merged = sorted({**kept, **parts}.items(), key=lambda item: [value or "" for value in item[0]])
    return TableState(rows.schema.json(), tuple(merged))


def parts_of(name: str, state: TableState | None, periods: Collection[int | None]) -> list[Part]:
    """The partitions of some periods."""
    wanted, at = {None if p is None else str(p) for p in periods}, layout_of(name).keys.index(PERIOD)
    return [part for part, _ in state.parts if part[at] in wanted] if state else []


def read_version(
    spark: SparkSession, cfg: LakeConfig, name: str, state: TableState, parts: Collection[Part] | None = None
) -> DataFrame:
    """A table as a state has it, or only some of its partitions (others are not even listed)."""
    layout, schema = layout_of(name), state.struct()
    wanted = None if parts is None else set(parts)
    folders = [
        _folder(cfg, name, part, version) for part, version in state.parts if wanted is None or part in wanted
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([f for f in schema.fields if f.name not in layout.keys]).add(VERSION, StringType())
    for key in layout.keys:
        full = full.add(key, IntegerType() if key == PERIOD else StringType())
    rows = spark.read.option("basePath", _uri(cfg, name)).schema(full).parquet(*folders)
    return rows.select(*schema.names)


def vacuum(spark: SparkSession, cfg: LakeConfig) -> list[str]:
    """Remove the versions that the pointer no longer names, and return their folders.

    Only when no reader of an older snapshot is left; the scheduler decides when that is.
    """
    snapshot = current(spark, cfg)
    removed = []
    for name in LAYOUTS if snapshot else ():
        state = snapshot.tables.get(name)
        held = {version for _, version in state.parts} if state else set()
        for folder in folders(spark, _uri(cfg, name)):
            key, _, version = folder.rpartition("/")[2].partition("=")
            if key == VERSION and version not in held:
                remove(spark, folder)
                removed.append(folder)
    return removed
