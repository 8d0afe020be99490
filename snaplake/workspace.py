"""Where intermediate and offline tables go: the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A new folder under the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR_KEY} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="snaplake-")
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])
