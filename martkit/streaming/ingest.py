"""Take in each landed file exactly once, as it is or merged with the rows before it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.state import BUCKET, bucket_of, merge_last_wins
from martkit.sources.pointed import PointedTable

ORIGIN = "source_file"
BUCKETS = 16


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    archive: str | None = None,
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Process the files that are new since the last run, then stop.

    The checkpoint remembers the files, the Parquet sink commits each batch
    once, so a run that failed or is repeated neither loses nor doubles rows.
    The option ``maxFilesPerTrigger`` divides a large backlog into batches.
    With ``archive`` a file is moved there in the run after the one that read
    it; no file is removed before its rows are committed.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


def last_wins_table(spark: SparkSession, path: str, schema: T.StructType) -> PointedTable:
    """Where :func:`ingest_last_wins` keeps its rows: the feed's columns, the file of each row and its bucket."""
    more = [T.StructField(ORIGIN, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    return PointedTable(spark, path, T.StructType([*schema.fields, *more]), [BUCKET])


def ingest_last_wins(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    key: str,
    newest_first: Sequence[Column],
    fmt: str = "json",
    options: Mapping[str, object] | None = None,
) -> None:
    """Take in the files that are new since the last run, keeping the newest row of each key.

    Each batch is merged with the kept rows of the buckets that its keys touch,
    and committed at once. A batch that is delivered again after a failure
    replaces its own rows, so it counts once; rows without a key are all kept.
    ``newest_first`` may use the file's name, ``source_file``.
    """

    def take(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn(BUCKET, bucket_of(key, BUCKETS))
        last_wins_table(batch.sparkSession, target, schema).merge(
            rows, lambda kept, got: merge_last_wins(kept, got, key, newest_first, ORIGIN)
        )

    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    stream = reader.load(source).withColumn(ORIGIN, F.col("_metadata.file_path"))
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
