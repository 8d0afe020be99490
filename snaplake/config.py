"""Load settings and the Spark configuration a deployment starts from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

# Defaults users already rely on.
DEFAULT_NUM_THREADS = 4
DEFAULT_CHUNK_SIZE = 100_000
DEFAULT_LARGE_TABLE_THRESHOLD = 1_000_000
DEFAULT_LARGE_TABLE_BATCH_SIZE = 1_000_000
DEFAULT_LARGE_TABLE_WORKERS = 3
DEFAULT_STATS_MAX_AGE_SECONDS = 86_400
DEFAULT_FETCH_SIZE = 10_000
DEFAULT_TARGET_FILE_BYTES = 268_435_456

# Ours: open connections of one table, and rows of one file, so that a reader's rows don't become one huge file.
DEFAULT_CONNECTIONS = 16
DEFAULT_FILE_ROWS = 10_000_000
DEFAULT_RESUME_SECONDS = 86_400


@dataclass(frozen=True)
class LoadConfig:
    """Tuning knobs of a load.

    ``connections`` bounds the readers of one table that run at a time; their number follows from its rows. A load that
    stopped is gone on with for ``resume_seconds``; 0 starts it anew each time.
    """

    num_threads: int = DEFAULT_NUM_THREADS
    chunk_size: int = DEFAULT_CHUNK_SIZE
    large_table_threshold: int = DEFAULT_LARGE_TABLE_THRESHOLD
    large_table_batch_size: int = DEFAULT_LARGE_TABLE_BATCH_SIZE
    large_table_workers: int = DEFAULT_LARGE_TABLE_WORKERS
    stats_max_age_seconds: int = DEFAULT_STATS_MAX_AGE_SECONDS
    fetch_size: int = DEFAULT_FETCH_SIZE
    target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES
    connections: int = DEFAULT_CONNECTIONS
    even_reads: bool = True
    single_shot: bool = False
    resume_seconds: int = DEFAULT_RESUME_SECONDS

    @classmethod
    def of(cls, settings: Mapping[str, Any]) -> LoadConfig:
        """From a settings mapping; what it does not name keeps its default."""
        unknown = settings.keys() - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**settings)

    def __post_init__(self) -> None:
        for name in (
            "num_threads", "chunk_size", "large_table_threshold", "large_table_batch_size",
            "large_table_workers", "fetch_size", "target_file_bytes", "connections",
        ):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")


def session_conf(
    *,
    warehouse: str,
    catalog: str = "lakehouse",
    endpoint: str | None = None,
    region: str = "us-east-1",
    ssl_enabled: bool = False,
) -> dict[str, str]:
    """Spark conf of a cluster that lands tables in an Iceberg catalog on an object store.

    Holds no credentials: those come from the environment, an instance role or the submit command.
    The Iceberg and object-store jars are given at submit time.
    """
    conf = {
        "spark.scheduler.mode": "FAIR",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{catalog}.type": "hadoop",
        f"spark.sql.catalog.{catalog}.warehouse": warehouse,
    }
    if endpoint:
        conf |= {
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.endpoint": endpoint,
            "spark.hadoop.fs.s3a.endpoint.region": region,
            "spark.hadoop.fs.s3a.path.style.access": "true",
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl_enabled).lower(),
            "spark.hadoop.fs.s3a.fast.upload.buffer": "bytebuffer",
        }
    return conf
