"""Session settings the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_TASK_BYTES = 256 << 20


def cluster_settings(largest_shuffle_bytes: int) -> dict[str, str]:
    """Sizes for a cluster: scan and shuffle tasks of about 256 MB, which fit an executor core.

    Adaptive execution merges the shuffle partitions that turn out small, so the
    number is sized for the largest shuffle of the job. ``spark.checkpoint.dir``
    has to name a folder that all executors share.
    """
    partitions = min(max(largest_shuffle_bytes // _TASK_BYTES, 200), 200_000)
    return SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(_TASK_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * _TASK_BYTES),
    }


def local_session(cpus: int = 8, app: str = "martkit") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own master and sizes."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("MARTKIT_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
