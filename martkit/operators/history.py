"""Latest-row flags, validity intervals and remapping of replaced ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martkit.functions.dates import open_end
from martkit.operators.filters import current_rows
from martkit.operators.project import q
from martkit.operators.spread import ROWS_PER_TASK, left_lookup


def flag_latest(
    df: DataFrame,
    key: str,
    ts: str,
    alias: str,
    spread_by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    times_from: DataFrame | None = None,
) -> DataFrame:
    """1 where the row has the newest time of its key, else 0.

    Ties are all flagged; a row without a time gets null. Rows without a key
    form one group. A window would pull all rows of a key into one task, so the
    newest time is aggregated map-side and looked up again. ``times_from`` is an
    earlier stage of the frame with the same keys and times that is cheaper to read.
    """
    per_key = (df if times_from is None else times_from).groupBy(q(key)).agg(
        F.max(q(ts)).alias("__newest"), F.count(F.lit(1)).alias("__n")
    )
    out = left_lookup(
        df.drop(alias), per_key, [key], nulls_match=True, count_col="__n",
        spread_by=spread_by, rows_per_task=rows_per_task,
    )
    return out.withColumn(alias, (q(ts) == F.col("__newest")).cast("bigint")).drop("__newest")


def scd2_from_snapshots(
    df: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    ts: str,
    start_col: str = "dt_inicio_vigencia",
    end_col: str = "dt_fim_vigencia",
) -> DataFrame:
    """Validity intervals of each key from full snapshots.

    A version ends when the next snapshot shows other attributes or lacks the
    key; a key that returns opens a new version. Of several rows of a key in one
    snapshot the one with the lowest attributes counts; they are merged map-side,
    so a key has one row per snapshot when it reaches its window task. All windows
    share one shuffle and one sort. The snapshot times, one row per load, are
    numbered in one task and looked up by their measured size.
    """
    by_time = Window.orderBy("__ts")
    df = df.withColumn(ts, F.coalesce(q(ts), F.raise_error(F.lit(f"a snapshot row has no {ts}"))))
    times = (
        df.select(q(ts).alias("__ts"))
        .distinct()
        .select(
            "__ts",
            F.row_number().over(by_time).alias("__idx"),
            F.lead("__ts").over(by_time).alias("__next"),
        )
    )
    key, attr = [f"__k{i}" for i in range(len(keys))], [f"__a{i}" for i in range(len(attrs))]
    merged = df.groupBy(q(ts).alias("__ts"), *[q(k).alias(n) for k, n in zip(keys, key)]).agg(
        F.min(F.struct(*[q(a).alias(n) for a, n in zip(attrs, attr)])).alias("__attrs")
    )
    rows = left_lookup(merged.select("__ts", *key, "__attrs.*"), times, ["__ts"])
    in_time = Window.partitionBy(*key).orderBy("__idx")
    whole = in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = {f"{c}_before": F.lag(c).over(in_time) for c in ("__idx", "__next", *attr)}
    compared = rows.withColumns({**before, "__key_end": F.last("__next").over(whole)})
    changed = reduce(or_, [_differs(F.col(a), F.col(f"{a}_before")) for a in attr])
    gap = F.coalesce(F.col("__idx") - F.col("__idx_before") != 1, F.lit(True))
    # a version lasts until the snapshot after the last one that shows it
    next_start = F.lead("__idx").over(in_time)
    end = F.when(next_start.isNull(), F.col("__key_end")).otherwise(
        F.lead("__next_before").over(in_time)
    )
    return compared.where(gap | changed).select(
        *[F.col(n).alias(k) for n, k in zip(key, keys)],
        *[F.col(n).alias(a) for n, a in zip(attr, attrs)],
        F.col("__ts").alias(start_col),
        F.coalesce(end.cast("timestamp_ntz"), open_end()).alias(end_col),
    )


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """Per key ``added``, ``removed``, ``changed`` or ``same``.

    The full outer join of two snapshots on their key is one aggregation over
    both: each side is merged map-side and shuffled once. Old attributes are
    named ``<attr>_old``, new ones ``<attr>_new``.
    """
    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*[q(k) for k in keys], *[q(a) for a in attrs], F.lit(tag).alias("__tag"))

    packed = F.struct(*[q(a) for a in attrs])
    both = (
        side(old, 0)
        .unionByName(side(new, 1))
        .groupBy(*[q(k) for k in keys])
        .agg(
            F.min(F.when(F.col("__tag") == 0, packed)).alias("__old"),
            F.min(F.when(F.col("__tag") == 1, packed)).alias("__new"),
        )
    )
    before, after = F.col("__old"), F.col("__new")
    changed = reduce(or_, [_differs(before[a], after[a]) for a in attrs])
    status = (
        F.when(before.isNull(), "added")
        .when(after.isNull(), "removed")
        .when(changed, "changed")
        .otherwise("same")
    )
    return both.select(
        *[q(k) for k in keys],
        *[before[a].alias(f"{a}_old") for a in attrs],
        *[after[a].alias(f"{a}_new") for a in attrs],
        status.alias("status"),
    )


def id_mapping(
    history: DataFrame, id_col: str, natural_key: Sequence[str], end_col: str = "dt_fim_vigencia"
) -> DataFrame:
    """``(id, current id)``, one row per id that has a successor or is current.

    An id can have stood for several natural keys; the one it stood for last
    among those that are still valid decides. If several current ids share a
    natural key the lowest is taken.
    """
    now = (
        current_rows(history, end_col)
        .groupBy(*[q(k) for k in natural_key])
        .agg(F.min(q(id_col)).alias("__current"))
    )
    past = history.select(q(id_col), *[q(k) for k in natural_key], q(end_col).alias("__end"))
    return (
        past.join(now, list(natural_key), "inner")
        .groupBy(q(id_col).alias("__id"))
        .agg(
            F.max(
                F.struct(F.col("__end"), (-F.col("__current").cast("bigint")).alias("__order"), F.col("__current"))
            ).alias("__pick")
        )
        .select("__id", F.col("__pick")["__current"].alias("__current"))
    )


def remap_to_current(
    fact: DataFrame,
    history: DataFrame,
    id_cols: Sequence[str],
    history_id: str,
    natural_key: Sequence[str],
    end_col: str = "dt_fim_vigencia",
) -> DataFrame:
    """Replace ids on the fact by the id now valid, else keep them.

    The mapping has one row per id, so the fact keeps its row count.
    """
    mapping = id_mapping(history, history_id, natural_key, end_col)
    source = fact
    for col in id_cols:
        one = mapping.select(
            F.col("__id").cast(fact.schema[col].dataType).alias(col),
            F.col("__current").cast(fact.schema[col].dataType).alias("__to"),
        )
        fact = (
            left_lookup(fact, one, [col], counts_from=source)
            .withColumn(col, F.coalesce("__to", q(col)))
            .drop("__to")
        )
    return fact
