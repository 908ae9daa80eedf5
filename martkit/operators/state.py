"""Kept state, merged with a delivery: what a run needs to know of the rows that it doesn't read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import open_end
from martkit.operators.dedup import last_wins
from martkit.operators.project import q
from martkit.operators.spread import left_lookup

BUCKET = "bucket"


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Bucket of a key, of any type, by its hash; a null key has one too."""
    text = (q(key) if isinstance(key, str) else key).cast("string")
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(buckets)).cast("int")


def newest_times(rows: DataFrame, key: str, ts: str, version: str) -> DataFrame:
    """Each key's newest time and the versions that hold a row of it; rows without a time tell nothing.

    Two aggregations that add up before they shuffle; at most one row for each key and version meets.
    """
    per_version = rows.groupBy(q(key).alias("key"), q(version).alias("__v")).agg(F.max(q(ts)).alias("__t"))
    pairs = per_version.where("__t IS NOT NULL").groupBy("key").agg(
        F.max("__t").alias("newest"), F.collect_list(F.struct("__t", "__v")).alias("__all")
    )
    holding = F.filter("__all", lambda x: x["__t"] == F.col("newest"))
    return pairs.select("key", "newest", F.sort_array(F.transform(holding, lambda x: x["__v"])).alias("versions"))


def merge_newest(state: DataFrame, delivered: DataFrame) -> DataFrame:
    """The state after a delivery, both as :func:`newest_times` gives them.

    Adds ``stale``: the versions that held the newest row and no longer do.
    Merging the same delivery again changes nothing.
    """
    both = state.select("key", "newest", "versions", F.lit(True).alias("__old")).unionByName(
        delivered.select("key", "newest", "versions", F.lit(False).alias("__old"))
    )
    merged = both.groupBy("key").agg(
        F.max("newest").alias("newest"), F.collect_list(F.struct("newest", "versions", "__old")).alias("__all")
    )
    now = F.filter("__all", lambda x: x["newest"] == F.col("newest"))
    past = F.filter("__all", lambda x: x["__old"] & (x["newest"] < F.col("newest")))

    def versions(parts: Column) -> Column:
        return F.sort_array(F.array_distinct(F.flatten(F.transform(parts, lambda x: x["versions"]))))

    return merged.select("key", "newest", versions(now).alias("versions"), versions(past).alias("stale"))


def flag_from_state(rows: DataFrame, state: DataFrame, key: str, ts: str, flag: str) -> DataFrame:
    """The latest flag of rows from the kept newest times; a row without a time gets null."""
    newest = state.select(F.col("key").alias("__key"), F.col("newest").alias("__newest"))
    keyed = rows.drop(flag).withColumn("__key", q(key))
    out = left_lookup(keyed, newest, ["__key"], nulls_match=True)
    return out.withColumn(flag, (q(ts) == F.col("__newest")).cast("bigint")).drop("__key", "__newest")


def merge_last_wins(state: DataFrame, delivered: DataFrame, key: str, order: Sequence[Column], origin: str) -> DataFrame:
    """The newest row of each key over the kept rows and a delivery of the same columns.

    ``order`` runs from newest to oldest; ``origin`` names the file of a row.
    Kept rows of the files that are delivered again give way, so that a delivery
    that is merged twice counts once, also where rows have no key.
    """
    again = delivered.select(q(origin).alias("__origin")).distinct()
    older = state.join(again, q(origin).eqNullSafe(F.col("__origin")), "left_anti")
    return last_wins(older.unionByName(delivered), key, order)


def merge_snapshot(
    valid: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    at: Column,
    start_col: str = "dt_inicio_vigencia",
    end_col: str = "dt_fim_vigencia",
) -> DataFrame:
    """The open intervals ``valid`` and the next full snapshot, taken ``at`` a later time, to intervals.

    A key that shows other attributes ends and begins anew, one that is absent
    ends, a new one begins; the others stay. Of several rows of a key the one
    with the lowest attributes counts. Older snapshots and closed intervals are
    not read: both sides are aggregated once by key. Ended intervals come with
    their end, open ones with the open end.
    """
    names = [f"__a{i}" for i in range(len(attrs))]
    packed = F.struct(*[q(a).alias(n) for a, n in zip(attrs, names)])
    old = valid.select(*[q(k) for k in keys], packed.alias("__old"), q(start_col).alias("__start"), F.lit(None).alias("__new"))
    new = snapshot.select(*[q(k) for k in keys], F.lit(None).alias("__old"), F.lit(None).cast("timestamp_ntz").alias("__start"),
                          packed.alias("__new"))
    kind = old.schema["__old"].dataType
    both = old.withColumn("__new", F.col("__new").cast(kind)).unionByName(new.withColumn("__old", F.col("__old").cast(kind)))
    met = both.groupBy(*[q(k) for k in keys]).agg(
        F.min("__old").alias("__old"), F.min("__start").alias("__start"), F.min("__new").alias("__new")
    )
    was, now = F.col("__old"), F.col("__new")
    same = was.isNotNull() & now.isNotNull() & was.eqNullSafe(now)
    moment = at.cast("timestamp_ntz")
    stays = F.struct(was.alias("a"), F.col("__start").alias("s"), open_end().alias("e"))
    ended = F.struct(was.alias("a"), F.col("__start").alias("s"), moment.alias("e"))
    begun = F.struct(now.alias("a"), moment.alias("s"), open_end().alias("e"))
    parts = F.when(same, F.array(stays)).otherwise(
        F.filter(F.array(F.when(was.isNotNull(), ended), F.when(now.isNotNull(), begun)), lambda x: x.isNotNull())
    )
    rows = met.select(*[q(k) for k in keys], F.explode(parts).alias("__i"))
    return rows.select(
        *[q(k) for k in keys], *[F.col(f"__i.a.{n}").alias(a) for n, a in zip(names, attrs)],
        F.col("__i.s").alias(start_col), F.col("__i.e").alias(end_col),
    )
