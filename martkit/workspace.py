"""The shared folder for tables that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix="run-")
    print(f"spark.checkpoint.dir is unset: this local session keeps its intermediate tables in {folder}")
    return folder


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        of_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = of_context.get() if of_context.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def run_dir(spark: SparkSession) -> str:
    """This session's own part of the shared folder."""
    return f"{shared_dir(spark)}/martkit-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder that no other run uses."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut.

    A lost executor cannot change its rows, later steps read only the columns
    they need, and Spark knows its size.
    """
    spark = df.sparkSession
    path = new_folder(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete all tables that this session has written below the shared folder.

    For when the results are written: frames built before still read them.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the session's intermediate tables at the end, also after an error."""
    try:
        yield
    finally:
        drop_intermediates(spark)
