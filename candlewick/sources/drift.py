"""Reading a Bronze tree whose files disagree on their schema.

Other writers store nanosecond timestamps, plain dates where we store timestamps, doubles where we
store whole numbers, miss columns or add some.  Spark refuses to merge those footers, so files are
grouped by how they store the contract's columns; each group is read with its own schema, brought to
the contract, and unioned.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StructField,
    StructType,
    TimestampType,
)

from candlewick.config import LakeConfig, dataset_uri, prepare_session
from candlewick.contracts import RUN_PARTITIONS, DatasetSpec
from candlewick.sources.bronze import with_run_partitions

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def footer_groups(
    spark: SparkSession, uri: str, schema: StructType, store: Mapping[str, str] | None = None
) -> DataFrame:
    """(storage, location): how the footers store the contract's columns, and where.

    Footers are read in parallel by the executors.  A run directory whose files agree is reported
    as one location; loose files (other writers store one per run) are reported one by one.
    ``store`` holds the options of an S3-compatible store (``LakeConfig.arrow_options``).
    """
    wanted = list(schema.names)

    def storage_of(batches: Iterator) -> Iterator:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem, S3FileSystem

        def located(path: str) -> tuple[FileSystem, str]:
            if path.startswith("s3a://"):
                inner = path[len("s3a://"):]
                return (S3FileSystem(**store), inner) if store else FileSystem.from_uri(f"s3://{inner}")
            if path.startswith("file:"):
                path = "file://" + path[len("file:"):].replace("//", "", 1)
            return FileSystem.from_uri(path)

        def kind(column) -> str:
            logical = str(column.logical_type)
            if "nanoseconds" in logical:
                return "nanos"
            return "date" if logical == "Date" else column.physical_type.lower()

        for batch in batches:
            storage = []
            for path in batch["path"]:
                fs, inner = located(path)
                with fs.open_input_file(inner) as handle:
                    footer = pq.read_metadata(handle).schema
                found = {footer.column(i).name: kind(footer.column(i)) for i in range(len(footer))}
                storage.append(
                    ",".join(f"{name}:{found[name]}" for name in wanted if name in found)
                )
            yield batch[["path"]].assign(storage=storage)

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(uri)
        .select("path")
    )
    footers = files.mapInPandas(storage_of, "path string, storage string").withColumn(
        "dir", F.regexp_replace("path", "/[^/]*$", "")
    )
    run_dirs = footers.filter(F.col("dir").endswith(".parquet"))
    per_dir = run_dirs.groupBy("dir").agg(
        F.min("storage").alias("storage"), F.max("storage").alias("other")
    )
    is_uniform = F.col("storage") == F.col("other")
    uniform = per_dir.filter(is_uniform).select("storage", F.col("dir").alias("location"))
    single = footers.join(per_dir.filter(is_uniform), "dir", "left_anti").select(
        "storage", F.col("path").alias("location")
    )
    return uniform.unionByName(single)


# How a stored kind is read where it differs from the contract's type.
_READ_AS = {
    "nanos": LongType(),
    "date": DateType(),
    "int32": IntegerType(),
    "int64": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
}


def _stored_field(field: StructField, kind: str) -> StructField:
    if isinstance(field.dataType, TimestampType) and kind not in ("nanos", "date"):
        return field
    return StructField(field.name, _READ_AS.get(kind, field.dataType))


def _to_contract(field: StructField, kind: str | None) -> Column:
    if kind is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(field.name)
    if kind == "nanos":
        column = F.timestamp_micros(F.expr(f"`{field.name}` DIV 1000"))
    elif kind in ("float", "double") and isinstance(field.dataType, LongType):
        column = F.bround(column)  # whole numbers that became doubles beside missing values
    return column.cast(field.dataType).alias(field.name)


def read_drifted(spark: SparkSession, cfg: LakeConfig, spec: DatasetSpec) -> DataFrame:
    """All files of a dataset under the contract schema plus year, month, day.

    Only locations (directories, one per run) reach the driver.  Nanosecond files need a session
    setting that makes Spark read them as long; it is switched on when such files are found.
    """
    uri = dataset_uri(cfg, spec.source, spec.dataset)
    prepare_session(spark, cfg)
    groups: dict[str, list[str]] = {}
    for row in footer_groups(spark, uri, spec.schema, cfg.arrow_options()).toLocalIterator():
        groups.setdefault(row["storage"], []).append(row["location"])
    if not groups:
        return spark.createDataFrame([], with_run_partitions(spec.schema))

    frames = []
    for storage, locations in sorted(groups.items()):
        kinds = dict(item.split(":", 1) for item in storage.split(",") if item)
        if "nanos" in kinds.values():
            spark.conf.set(NANOS_AS_LONG, "true")
        stored = StructType(
            [_stored_field(f, kinds[f.name]) for f in spec.schema.fields if f.name in kinds]
        )
        raw = (
            spark.read.option("basePath", uri)
            .schema(with_run_partitions(stored))
            .parquet(*sorted(locations))
        )
        frames.append(
            raw.select(
                *[_to_contract(f, kinds.get(f.name)) for f in spec.schema.fields], *RUN_PARTITIONS
            )
        )
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
