"""What is loaded and what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import ts_to_epoch_ms
from martkit.functions.text import strip
from martkit.operators.project import q

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def high_watermark(names: DataFrame, name_col: str, pattern: str = DATE_IN_NAME) -> DataFrame:
    """Newest date in the file names, as one row; an error when none has a date."""
    date = F.try_to_date(F.regexp_extract(q(name_col), pattern, 1), "yyyy-MM-dd")
    newest = names.agg(F.max(date).alias("watermark"))
    missing = F.raise_error(F.lit("no file name carries a date")).cast("date")
    return newest.select(F.coalesce("watermark", missing).alias("watermark"))


def missing_days(watermark: DataFrame, upto: Column, col: str = "watermark") -> DataFrame:
    """Every day after the watermark up to and including ``upto``."""
    start = F.date_add(q(col), 1)
    return watermark.where(start <= upto).select(F.explode(F.sequence(start, upto)).alias("day"))


def load_windows(bounds: DataFrame, start: str, end: str, days: int = 30) -> DataFrame:
    """Half-open windows of ``days`` days covering [start, end), in epoch milliseconds too."""
    step = F.make_dt_interval(days=F.lit(days))
    begin, stop = q(start).cast("timestamp_ntz"), q(end).cast("timestamp_ntz")
    rows = bounds.where(begin < stop).select(
        stop.alias("__stop"), F.posexplode(F.sequence(begin, stop, step)).alias("__n", "window_start")
    )
    return (
        rows.where(F.col("window_start") < F.col("__stop"))
        .select(
            (F.col("__n") + 1).cast("bigint").alias("window_no"),
            "window_start",
            F.least(F.col("window_start") + step, F.col("__stop")).alias("window_end"),
        )
        .withColumns(
            {
                "start_ms": ts_to_epoch_ms(F.col("window_start")),
                "end_ms": ts_to_epoch_ms(F.col("window_end")),
            }
        )
    )


def upsert_control(control: DataFrame, updates: DataFrame, key: str, value: str) -> DataFrame:
    """New value per feed, feeds matched on their trimmed lower-case name.

    Feeds that have no update keep their row, new feeds are added. Updates are
    reduced to their newest value per feed before anything is joined.
    """
    def norm(df: DataFrame) -> Column:
        return F.lower(strip(df[key]))

    new = updates.groupBy(norm(updates).alias("__key")).agg(
        F.min(q(key)).alias("__name"), F.max(q(value)).alias("__value")
    )
    old = control.withColumn("__key", norm(control))
    return old.join(new, "__key", "full").select(
        F.coalesce(q(key), F.col("__name")).alias(key),
        F.coalesce(F.col("__value"), q(value)).alias(value),
    )
