"""Dense surrogate ids 1..n; no global window over more labels than one task should sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martkit.functions.text import strip
from martkit.operators.project import q
from martkit.operators.spread import ROWS_PER_TASK, estimated_bytes, left_lookup
from martkit.workspace import written

_PART = "__part"
# So many labels at most are sorted by one task; the estimate saves counting where it is small already.
ONE_TASK_LABELS = 200_000
ONE_TASK_BYTES = 16 << 20


def label_counts(df: DataFrame, col: str, include_null: bool = False) -> DataFrame:
    counts = df.groupBy(q(col)).agg(F.count(F.lit(1)).alias("__n"))
    return counts if include_null else counts.where(q(col).isNotNull() & (q(col) != ""))


def _in_one_task(counts: DataFrame, col: str, id_col: str, start: int) -> DataFrame:
    order = Window.orderBy(q(col).asc_nulls_last())
    return counts.withColumn(id_col, F.row_number().over(order) + F.lit(start - 1))


def _by_ranges(counts: DataFrame, col: str, id_col: str, start: int) -> DataFrame:
    """Range partitions number their own labels and add the labels before them.

    The partition number is written along with the labels, so it stays the same
    however often it is read; only the partition sizes meet in one task.
    """
    fixed = written(
        counts.repartitionByRange(q(col).asc_nulls_last()).withColumn(
            _PART, F.spark_partition_id()
        )
    )
    sizes = fixed.groupBy(_PART).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(_PART), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before")
    )
    within = Window.partitionBy(_PART).orderBy(q(col).asc_nulls_last())
    return (
        fixed.join(F.broadcast(starts), _PART)
        .withColumn(id_col, F.row_number().over(within) + F.col("__before") + F.lit(start - 1))
        .drop(_PART, "__before")
    )


def number_labels(
    counts: DataFrame, col: str, id_col: str, start: int = 1, one_task_labels: int | None = None
) -> DataFrame:
    """Consecutive ids over distinct labels in sort order, null last.

    Spark's estimate of the labels is that of the rows they come from. If that
    is too large for one task, the labels are written and their number decides
    between one task and range partitions.
    """
    most = ONE_TASK_LABELS if one_task_labels is None else one_task_labels
    small = most > 0 and estimated_bytes(counts) <= ONE_TASK_BYTES
    if not small and most > 0 and ONE_TASK_BYTES >= 0:
        counts = written(counts)
        small = counts.count() <= most
    return (_in_one_task if small else _by_ranges)(counts, col, id_col, start)


def dense_ids(df: DataFrame, col: str, id_col: str, start: int = 1, include_null: bool = False) -> DataFrame:
    """``(label, id)``, one row per distinct label."""
    return number_labels(label_counts(df, col, include_null), col, id_col, start).drop("__n")


def add_dim_ids(
    df: DataFrame,
    col: str,
    id_col: str,
    missing: int | None = 0,
    include_null: bool = False,
    as_text: bool = False,
    counts_from: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    one_task_labels: int | None = None,
) -> DataFrame:
    """Attach the dense id of each row's label; no label gives ``missing``.

    The label counts that the ids are built from also tell which labels are hot.
    They may be taken from an earlier stage of the frame with the same labels.
    """
    base = df if counts_from is None else counts_from
    numbered = number_labels(label_counts(base, col, include_null), col, id_col, 1, one_task_labels)
    out = left_lookup(
        df.drop(id_col), numbered, [col], nulls_match=include_null, count_col="__n",
        rows_per_task=rows_per_task,
    )
    value = q(id_col).cast("bigint")
    if missing is not None:
        value = F.coalesce(value, F.lit(missing).cast("bigint"))
    return out.withColumn(id_col, value.cast("string") if as_text else value)


def strip_label(df: DataFrame, col: str) -> DataFrame:
    """Labels as the audience feed compares them: trimmed, null as empty text."""
    return df.withColumn(col, F.coalesce(strip(q(col)), F.lit("")))
