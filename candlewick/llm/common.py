"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import importlib.util
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of (id, id) pairs that one broadcast may hold; beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or an own one for a local
    master where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """df as a written table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it has few rows, else left for a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@lru_cache
def _shipped(application: str) -> None:
    package = Path(importlib.util.find_spec(__name__).origin).parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}", "zip", package.parent, package.name)
    SparkSession.getActiveSession().sparkContext.addPyFile(archive)


def ship(df: DataFrame) -> DataFrame:
    """df, once the Python workers of its session can import this package."""
    _shipped(df.sparkSession.sparkContext.applicationId)
    return df


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


@lru_cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not in every C library
        return lambda _: 0


def tidied(
    task: Callable[..., Iterator[pd.DataFrame]], done: Callable[[], None] | None = None
) -> Callable[..., Iterator[pd.DataFrame]]:
    """task, a generator function over a partition's frames, that gives its memory back when it ends, after done().

    Python workers serve many tasks; what the C library and Arrow keep for reuse would add up to the
    largest task of every stage.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from task(frames)
        finally:
            if done:
                done()
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return run


def map_texts(
    docs: DataFrame,
    row: Callable[[list[str]], dict[str, Iterable]],
    schema: str,
    keep: tuple[str, ...] = ("doc_id",),
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Columns that row() computes from batches of whole texts, beside the kept columns; a task ends with done()."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                out = frame[list(keep)].copy()
                for name, values in row(frame["__text"].tolist()).items():
                    out[name] = values
                yield out

    chosen = ship(docs).select(*keep, whole_text().alias("__text"))
    types = dict(docs.dtypes)
    head = [f"`{c}` {types[c]}" for c in keep]
    return chosen.mapInPandas(tidied(batches, done), ", ".join([*head, schema]))


def held_out(modulus: int, remainder: int) -> Column:
    """True for documents whose labels are kept for testing: crc32(doc_id as text) mod modulus."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder
