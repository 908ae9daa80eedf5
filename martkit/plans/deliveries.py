"""Incremental runs of the dated feeds: advertising A and sales A.

A control table names the files that are in. A run lists the landed files,
takes those of the days up to its last one that the table lacks, reads them
once, and merges their rows with what earlier runs kept; no other file is
opened. The control table is written last, so a run that stopped is done again
by the next one, with the same result. What reaches the driver are names: files
of the delivery, days, partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.combine import stack_strict
from martkit.operators.dedup import dedup_by_key
from martkit.operators.incremental import DATE_IN_NAME, load_windows, missing_days
from martkit.operators.joins import new_rows
from martkit.operators.state import BUCKET, bucket_of, merge_last_wins
from martkit.operators.star import build_dim
from martkit.plans import ads_a, sales_a
from martkit.plans import contracts as c
from martkit.sources.pointed import PointedTable
from martkit.sources.readers import REJECTS, as_schema, split_json_envelope, split_json_records
from martkit.workspace import written

CONTROL = "path string, day date, feed string"
FILE_DAY = "file_day"
BUCKETS = 16


@dataclass
class Delivery:
    """What one run takes in of a feed."""

    paths: list[str]  # files to read
    days: list[date]  # of these files

    def __bool__(self) -> bool:
        return bool(self.paths)


def control_table(spark: SparkSession, gold: str) -> PointedTable:
    """The files that are in, by feed."""
    return PointedTable(spark, f"{gold}/control", CONTROL, ["feed"])


def _day_text(path: Column) -> Column:
    """The last date in a path."""
    return F.regexp_extract(path, f"^.*{DATE_IN_NAME}", 1)


def landed_files(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    """Path and day of a feed's files; the day is a date in the file's or its folder's name. Only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    try:
        paths = files.load(f"{bronze}/{feed}").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, day date")
    below = F.element_at(F.split("path", f"/{feed}/"), -1)
    return paths.select("path", F.try_to_date(_day_text(below), "yyyy-MM-dd").alias("day"))


def watermarks(control: DataFrame) -> DataFrame:
    """The newest day that is in, by feed."""
    return control.groupBy("feed").agg(F.max("day").alias("watermark"))


def days_to_pull(spark: SparkSession, control: DataFrame, feed: str, upto: date) -> DataFrame:
    """Every day after the feed's watermark, up to and including the last one, that has to be fetched."""
    mark = watermarks(control).where(F.col("feed") == feed)
    return missing_days(mark, F.lit(upto))


def windows_to_pull(spark: SparkSession, control: DataFrame, feed: str, upto: date, days: int = 30) -> DataFrame:
    """The windows after the feed's watermark that have to be fetched, in epoch milliseconds too."""
    mark = watermarks(control).where(F.col("feed") == feed)
    bounds = mark.select(F.date_add("watermark", 1).alias("start"), F.date_add(F.lit(upto), 1).alias("end"))
    return load_windows(bounds, "start", "end", days)


def _delivery(landed: DataFrame, control: DataFrame, feed: str, upto: date | None, whole_days: bool) -> Delivery:
    """The landed files up to the last day that the control table lacks.

    A late file of a day that is in is taken too. With ``whole_days`` all files
    of such a day are read again, as its rows are replaced together.
    """
    dated = landed.where("day IS NOT NULL")
    if upto is not None:
        dated = dated.where(F.col("day") <= F.lit(upto))
    fresh = new_rows(dated, control.where(F.col("feed") == feed), "path")
    if whole_days:
        fresh = dated.join(fresh.select("day").distinct(), "day", "left_semi")
    rows = fresh.select("path", "day").orderBy("path").collect()
    return Delivery([r["path"] for r in rows], sorted({r["day"] for r in rows}))


def _taken(spark: SparkSession, control: PointedTable, taken: dict[str, Delivery]) -> None:
    """Add the files to the control table: the last step of a run."""
    rows = [(p, None, feed) for feed, d in taken.items() for p in d.paths]
    if not rows:
        return
    new = spark.createDataFrame(rows, CONTROL).withColumn("day", F.try_to_date(_day_text(F.col("path")), "yyyy-MM-dd"))
    both = control.read(list(taken)).unionByName(new)
    control.replace(written(both.dropDuplicates(["feed", "path"])))


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE_DAY, _day_text(F.col("source_file")))


def _rejects_table(spark: SparkSession, gold: str, key: str) -> PointedTable:
    return PointedTable(spark, f"{gold}/rejects", f"{REJECTS}, feed string, {key} string", ["feed", key])


# --- advertising A --------------------------------------------------------------

INSIGHT_FEEDS = {"campaigns": c.ADS_A_CAMPAIGN, "adsets": c.ADS_A_ADSET, "ads": c.ADS_A_AD}
_DIMS = {"adsets": ("dim_adset", c.ADS_A_DIM_ADSET), "ads": ("dim_ad", c.ADS_A_DIM_AD)}


def _ads_a_rows(feed: str, raw: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of one insight feed, with the day of their file."""
    if feed == "campaigns":
        rows = ads_a.insights(raw)
    elif feed == "adsets":
        rows = ads_a.adset_insights(raw, lookups["targeting"])
    else:
        rows = ads_a.ad_insights(raw, lookups["creatives"], lookups["media"])
    return _with_day(rows)


def ads_a_table(spark: SparkSession, gold: str, feed: str, lookups: dict[str, DataFrame] | None = None) -> PointedTable:
    """The fact of an insight feed, by the day of its files."""
    if lookups is None:
        lookups = {
            "targeting": spark.createDataFrame([], c.ADS_A_TARGETING),
            "creatives": spark.createDataFrame([], c.ADS_A_CREATIVE), "media": spark.createDataFrame([], c.ADS_A_MEDIA),
        }
    empty = spark.createDataFrame([], as_schema(f"{INSIGHT_FEEDS[feed]}, source_file string"))
    return PointedTable(spark, f"{gold}/{feed}", _ads_a_rows(feed, empty, lookups).schema, [FILE_DAY])


def run_ads_a(
    spark: SparkSession, bronze: str, gold: str, lookups: dict[str, DataFrame], upto: date | None = None,
    lines: bool = False,
) -> dict[str, list[str]]:
    """Take in the insight files of new days, up to a last day.

    ``lookups`` are the feeds ``targeting``, ``creatives`` and ``media`` in
    full. The rows of a day replace that day's in the facts, so a late file has
    its day read again and nothing else. Each raw file is read once: good rows
    and rejects come from one written scan. Returns the files read, by feed.
    """
    control = control_table(spark, gold)
    known = control.read()
    rejects = _rejects_table(spark, gold, FILE_DAY)
    taken: dict[str, Delivery] = {}
    for feed, schema in INSIGHT_FEEDS.items():
        new = _delivery(landed_files(spark, bronze, feed), known, feed, upto, whole_days=True)
        if not new:
            continue
        good, bad = split_json_records(spark, new.paths, schema, lines)
        days = [d.isoformat() for d in new.days]
        ads_a_table(spark, gold, feed).replace(_ads_a_rows(feed, good, lookups), drop=days)
        rejects.replace(_with_day(bad).withColumn("feed", F.lit(feed)), drop=[f"{feed}|{d}" for d in days])
        taken[feed] = new
    _taken(spark, control, taken)
    return {feed: d.paths for feed, d in taken.items()}


def read_ads_a(spark: SparkSession, gold: str, feeds: Sequence[str] = tuple(INSIGHT_FEEDS)) -> dict[str, DataFrame]:
    """The tables of the mart over all days that are in; a dimension reads only its columns of the facts."""
    tables = {f: ads_a_table(spark, gold, f).read().drop(FILE_DAY) for f in feeds}
    newest = [F.col("date_stop").desc_nulls_last(), F.col("campaign_name"), F.col("spend").desc()]
    if "campaigns" in tables:
        tables["dim_camp"] = ads_a.dim_camp(tables["campaigns"], newest)
    return tables | {dim: build_dim(tables[f], cols) for f, (dim, cols) in _DIMS.items() if f in tables}


# --- sales A --------------------------------------------------------------------


def _flat_sales(records: DataFrame) -> DataFrame:
    """Flat sales with what groups and orders their copies: transaction, file and position."""
    own = {"__tx": F.col("purchase.transaction"), "__file": F.col("source_file"), "__pos": F.col("pos")}
    return sales_a.sales(records.withColumns(own), keep=list(own)).withColumn(BUCKET, bucket_of("__tx", BUCKETS))


def _empty_sales(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], as_schema(f"source_file string, pos int, {c.SALES_A_RECORD}"))


def sales_table(spark: SparkSession, gold: str) -> PointedTable:
    """The newest copy of each sale, by bucket of transactions."""
    return PointedTable(spark, f"{gold}/sales", _flat_sales(_empty_sales(spark)).schema, [BUCKET])


def buyers_table(spark: SparkSession, gold: str) -> PointedTable:
    """Each buyer of the newest pull that shows them, by bucket of buyers."""
    kinds = f"buyer_ucode string, buyer_name string, document_value string, pull string, {BUCKET} int"
    return PointedTable(spark, f"{gold}/users", kinds, [BUCKET])


def run_sales_a(spark: SparkSession, bronze: str, gold: str, upto: date | None = None) -> dict[str, list[str]]:
    """Take in the sales and user pulls that are new, up to a last day.

    Pulls overlap: of the copies of a transaction that of the newest file, and
    in it the last one, stays; sales without a transaction are all kept. Only
    the buckets of the delivered transactions and buyers are read and replaced.
    A file is taken once; a pull that is fetched again is a new file. Returns
    the files read, by feed.
    """
    control = control_table(spark, gold)
    known = control.read()
    rejects = _rejects_table(spark, gold, "pull")
    taken: dict[str, Delivery] = {}
    for feed, record in (("sales", c.SALES_A_RECORD), ("users", c.USERS_A_RECORD)):
        new = _delivery(landed_files(spark, bronze, feed), known, feed, upto, whole_days=False)
        if not new:
            continue
        good, bad = split_json_envelope(spark, new.paths, record)
        if feed == "sales":
            order = [F.col("__file").desc(), F.col("__pos").desc()]
            sales_table(spark, gold).merge(
                _flat_sales(good), lambda kept, got, order=order: merge_last_wins(kept, got, "__tx", order, "__file")
            )
        else:
            pulled = sales_a.buyers(good, with_pull=True).withColumn(BUCKET, bucket_of("buyer_ucode", BUCKETS))
            buyers_table(spark, gold).merge(
                pulled, lambda kept, got: dedup_by_key(kept.unionByName(got), ["buyer_ucode"], [F.col("pull").desc()])
            )
        rejects.replace(bad.withColumns({"feed": F.lit(feed), "pull": F.element_at(F.split("source_file", "/"), -1)}))
        taken[feed] = new
    _taken(spark, control, taken)
    return {feed: d.paths for feed, d in taken.items()}


def read_sales_a(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    """The tables of the mart over all pulls that are in."""
    return {
        "sales": sales_table(spark, gold).read().drop("__tx", "__file", "__pos", BUCKET),
        "users": buyers_table(spark, gold).read().drop("pull", BUCKET),
    }


def read_rejects(spark: SparkSession, gold: str, key: str = FILE_DAY) -> DataFrame:
    """File, text, reason and feed of the records that the runs left out (``key`` is ``pull`` for sales)."""
    return _rejects_table(spark, gold, key).read().drop(key)


def undated_files(spark: SparkSession, bronze: str, feeds: Sequence[str]) -> DataFrame:
    """Landed files that no run takes, as their names carry no date."""
    parts = [landed_files(spark, bronze, f).where("day IS NULL").select("path", F.lit(f).alias("feed")) for f in feeds]
    return stack_strict(*parts)
