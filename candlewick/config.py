"""Storage configuration, URIs and session settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@dataclass(frozen=True)
class LakeConfig:
    """Where the lake lives: an S3-compatible bucket if ``endpoint_url`` is set, else ``data_dir``."""

    data_dir: str = "data"
    bucket: str = "bronze-lake"
    region: str = "us-east-1"
    endpoint_url: str | None = None
    access_key: str | None = None
    secret_key: str | None = None

    @classmethod
    def from_env(cls) -> "LakeConfig":
        env = os.environ.get
        return cls(
            data_dir=env("DATA_DIR", cls.data_dir),
            bucket=env("S3_BUCKET", cls.bucket),
            region=env("AWS_REGION", cls.region),
            endpoint_url=env("S3_ENDPOINT_URL") or None,
            access_key=env("AWS_ACCESS_KEY_ID") or None,
            secret_key=env("AWS_SECRET_ACCESS_KEY") or None,
        )

    @property
    def root(self) -> str:
        if self.endpoint_url:
            return f"s3a://{self.bucket}"
        return self.data_dir.replace("\\", "/").rstrip("/")

    def s3a_options(self) -> dict[str, str]:
        """Session settings an S3-compatible store needs (``spark.hadoop.*``); empty when local."""
        if not self.endpoint_url:
            return {}
        options = {
            "spark.hadoop.fs.s3a.endpoint": self.endpoint_url,
            "spark.hadoop.fs.s3a.endpoint.region": self.region,
            "spark.hadoop.fs.s3a.path.style.access": "true",
        }
        if self.access_key and self.secret_key:
            options["spark.hadoop.fs.s3a.access.key"] = self.access_key
            options["spark.hadoop.fs.s3a.secret.key"] = self.secret_key
        return options

    def arrow_options(self) -> dict[str, str]:
        """The same store for Arrow's S3 file system, which reads footers; empty when local."""
        if not self.endpoint_url:
            return {}
        scheme, _, host = self.endpoint_url.rpartition("://")
        options = {"endpoint_override": host, "scheme": scheme or "https", "region": self.region}
        if self.access_key and self.secret_key:
            options |= {"access_key": self.access_key, "secret_key": self.secret_key}
        return options


def dataset_uri(cfg: LakeConfig, source: str, dataset: str, layer: str = "bronze") -> str:
    """Root of a dataset; the reader and the writer both use it."""
    return f"{cfg.root}/{layer}/{source}/{dataset}"


def as_utc(ts: datetime) -> datetime:
    """A time with zone UTC; times without a zone are UTC already, whatever the driver's zone."""
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def run_uri(
    cfg: LakeConfig, source: str, dataset: str, run_ts: datetime, layer: str = "bronze"
) -> str:
    """Where one run of a dataset is stored: zero-padded run-date partitions, then the run."""
    at = as_utc(run_ts)
    return (
        f"{dataset_uri(cfg, source, dataset, layer)}/year={at:%Y}/month={at:%m}/day={at:%d}"
        f"/{dataset}_{at:%Y%m%d_%H%M%S}.parquet"
    )


def table_uri(cfg: LakeConfig, layer: str, table: str) -> str:
    return f"{cfg.root}/{layer}/{table}"


def run_partition(table: str, run_ts: datetime) -> str:
    """One run's partition of a log or result table; writing it again replaces it."""
    return f"{table}/run={as_utc(run_ts):%Y%m%d_%H%M%S}"


def prepare_session(spark: SparkSession, cfg: LakeConfig | None = None) -> SparkSession:
    """Session settings the contracts rely on, and those of ``cfg``'s object store.

    UTC, because they cast between timestamps and dates; microsecond timestamps in Parquet, because
    Spark's default (INT96) carries no statistics, so ranges of time could not skip row groups.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    for name, value in (cfg.s3a_options() if cfg else {}).items():
        spark.conf.set(name.removeprefix("spark.hadoop."), value)  # a session hands these to Hadoop
    return spark


def shared_scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session that names no such folder gets one of this machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"Set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="candlewick-")
    return f"{base.rstrip('/')}/candlewick/{purpose}-{uuid.uuid4().hex}"
