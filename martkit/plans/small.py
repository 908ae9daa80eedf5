"""Marts of one or two tables: follower counts, calls, exchange rates, web reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import BR_DATE, parse_date
from martkit.operators.combine import stack_diagonal
from martkit.operators.explode import explode_map, flatten_report
from martkit.operators.project import lenient_cast, q, select_all
from martkit.plans import contracts as c


def build_social(feeds: dict[str, list[DataFrame]]) -> dict[str, DataFrame]:
    """Daily snapshots per channel, stacked; a failed pull stays as a row with its error."""
    return {name: stack_diagonal(*frames) for name, frames in feeds.items()}


def failed_pulls(snapshots: DataFrame) -> DataFrame:
    """Snapshots that hold an error instead of a count."""
    return snapshots.where(F.col("erro").isNotNull())


def build_calls(feed: DataFrame) -> DataFrame:
    """Call log with typed date and counts; other columns unchanged."""
    df = lenient_cast(feed, ints=c.CALLS_INTS)
    return df.withColumn(c.CALLS_DATE, parse_date(q(c.CALLS_DATE), BR_DATE))


def build_fx(days: DataFrame, extracted_at: Column) -> DataFrame:
    """One row per day and currency; answers without success are left out."""
    ok = days.where(F.coalesce(F.col("success"), F.lit(False)))
    rates = explode_map(ok, "rates", "moeda_destino", "resultado", carry=["base", "date"])
    named = rates.select(
        extracted_at.cast("string").alias("data_extracao"),
        F.col("date").alias("data_referencia"),
        F.col("base").alias("moeda_origem"),
        "moeda_destino",
        F.lit(1).alias("quantidade"),
        "resultado",
    )
    return select_all(named, c.FX_COLUMNS)


def build_web(reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Report answers (one row per report row) to named tables."""
    return {
        name: flatten_report(df, *c.WEB_REPORTS[name]) for name, df in reports.items()
    }
