"""Table writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.workspace import new_folder

LOAD_COL = "load_ts"
_BOM = "\ufeff"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace a Parquet table (snappy)."""
    df.write.mode(mode).parquet(path)


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Add a version beside older ones; writing the same version again replaces it."""
    (
        df.withColumn(LOAD_COL, F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_COL)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, bom: bool = False, sep: str = ",") -> None:
    """CSV with a header, on request with a byte order mark for spreadsheets.

    Values keep their surrounding white space, which Spark's writer drops by default.
    """
    if bom:
        df = df.withColumnRenamed(df.columns[0], _BOM + df.columns[0])
    options = {
        "header": True, "sep": sep, "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    df.write.mode("overwrite").options(**options).csv(path)


def backup_table(spark: SparkSession, path: str, backup: str) -> None:
    """Copy a table and check that the copy is whole."""
    spark.read.parquet(path).write.mode("overwrite").parquet(backup)
    have, want = spark.read.parquet(backup).count(), spark.read.parquet(path).count()
    if have != want:
        raise RuntimeError(f"backup of {path} has {have} of {want} rows")


def rewrite_versions(
    spark: SparkSession,
    path: str,
    change: Callable[[DataFrame], DataFrame],
    by: str = LOAD_COL,
    only: Sequence[str] | None = None,
) -> None:
    """A10: apply a computation over all versions, or ``only`` some, and write each version back in place.

    The result is first written to the shared folder, so the table is never
    read and overwritten by the same job, and a run that fails before that is
    done leaves it as it was. The versions are then replaced one after the other.
    """
    staged = new_folder(spark, "rewrite")
    df = spark.read.parquet(path)
    change(df if only is None else df.where(F.col(by).isin(*only))).write.parquet(staged)
    overwrite_versions(spark.read.parquet(staged), path, by)


def overwrite_versions(df: DataFrame, path: str, by: str = LOAD_COL) -> None:
    """Replace the versions that occur in the frame, leave the others alone.

    Rows are gathered by version in tasks of even size: a version gets few files,
    a very large one several tasks.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def promote(spark: SparkSession, src: str, dst: str) -> None:
    """Hand a table to the next layer unchanged."""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)
