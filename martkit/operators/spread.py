"""Left joins that survive hot keys.

``left_lookup`` attaches one row per key (an aggregate, a mapping, a dimension)
to a big frame. The size of the small side decides how:

* Spark's own estimate is below the broadcast threshold: broadcast join.
* Otherwise the estimate says little (an aggregate is estimated as large as its
  input), so the small side is computed once, written to the shared folder and
  measured. Below ``BROADCAST_BYTES`` it is broadcast: the big side is not
  shuffled at all, however few and hot its keys are.
* Above that both sides are shuffled. If some keys are hot, their rows are
  spread over several tasks by a hash of the row, and the one matching row is
  repeated once per task. Only hot keys are repeated; without any the join is
  a plain one.

The list of hot keys is broadcast. Its size is bounded: every key on it stands
for more than ``rows_per_task`` rows, so it has fewer than rows / rows_per_task
entries (a trillion rows: at most 200 000 keys).

The spreading hash is a function of the row alone, so a task that runs again
after a lost executor sends its rows to the same place. Identical rows share a
hash; both join inputs are plain shuffles, so adaptive skew splitting still
cuts a partition that such copies fill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.project import q
from martkit.workspace import written

ROWS_PER_TASK = 5_000_000
BROADCAST_BYTES = 64 << 20
_SALT = "__salt"
_COPIES = "__copies"


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame as Spark's optimizer estimates it, without running it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_threshold(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    number = text.strip().lower().removesuffix("b")
    if number and number[-1] in units:
        return int(number[:-1]) * units[number[-1]]
    return int(number)


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of a frame; runs over it once."""
    def width(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):
            return F.coalesce(F.octet_length(q(f.name)), F.lit(0)) + 16
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(q(f.name)))), F.lit(0)) + 16
        return F.lit(16)

    total = reduce(add, [width(f) for f in df.schema.fields]).cast("bigint")
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def _fits(table: DataFrame, limit: int) -> bool:
    """Whether a written table is small in memory; a large file need not be read for that."""
    return estimated_bytes(table) <= limit and measured_bytes(table) <= limit


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than one task should hold, and how many tasks they need.

    Reads the key columns only and counts map-side before it shuffles.
    """
    counts = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    return hot_from_counts(counts, keys, "__n", rows_per_task)


def hot_from_counts(
    counts: DataFrame, keys: Sequence[str], count_col: str, rows_per_task: int
) -> DataFrame:
    return counts.where(q(count_col) > rows_per_task).select(
        *[q(k) for k in keys], F.ceil(q(count_col) / rows_per_task).cast("int").alias(_COPIES)
    )


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _holds_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    return False


def _same(left: Sequence[Column], right: Sequence[Column], nulls_match: bool) -> Column:
    pairs = zip(left, right)
    return reduce(and_, [a.eqNullSafe(b) if nulls_match else a == b for a, b in pairs])


def left_lookup(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    nulls_match: bool = False,
    count_col: str | None = None,
    counts_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    broadcast_estimate: int | None = None,
) -> DataFrame:
    """Left join of ``big`` to ``small``, which has at most one row per key.

    Columns of ``small`` other than the keys are appended; their names must be
    new. ``count_col`` names a column of ``small`` that already tells how many
    rows of ``big`` each key has; it is not appended. Without it the keys are
    counted when both sides have to be shuffled, in ``counts_from`` if given: an
    earlier stage of ``big`` with the same keys that is cheaper to read. Hot keys
    are spread by a hash of all columns, or of ``spread_by`` where only few
    columns of a wide frame are used later. ``broadcast_estimate`` stands in for
    Spark's threshold on the estimated size.
    """
    extra = [c for c in small.columns if c not in keys and c != count_col]
    renamed = [f"__k_{i}" for i in range(len(keys))]

    def right_side(df: DataFrame) -> DataFrame:
        return df.select(*[q(k).alias(r) for k, r in zip(keys, renamed)], *[q(c) for c in extra])

    on = _same([q(k) for k in keys], [F.col(r) for r in renamed], nulls_match)
    threshold = broadcast_threshold(small) if broadcast_estimate is None else broadcast_estimate
    if estimated_bytes(small) <= threshold:
        return big.join(F.broadcast(right_side(small)), on, "left").drop(*renamed)
    small = written(small)
    if threshold >= 0 and _fits(small, broadcast_bytes):
        return big.join(F.broadcast(right_side(small)), on, "left").drop(*renamed)

    if count_col is None:
        hot = written(hot_keys(big if counts_from is None else counts_from, keys, rows_per_task))
    else:
        hot = hot_from_counts(small, keys, count_col, rows_per_task)
    if hot.isEmpty():
        return big.join(right_side(small), on, "left").drop(*renamed)
    marks = [f"__h_{i}" for i in range(len(keys))]
    hot = F.broadcast(hot.select(*[q(k).alias(m) for k, m in zip(keys, marks)], F.col(_COPIES)))

    def with_copies(df: DataFrame, names: Sequence[str]) -> DataFrame:
        cond = _same([q(n) for n in names], [F.col(m) for m in marks], True)
        return df.join(hot, cond, "left").drop(*marks)

    copies = F.coalesce(F.col(_COPIES), F.lit(1))
    if spread_by is None:
        spread_by = [f.name for f in big.schema.fields if not _holds_map(f.dataType)]
    row_hash = F.xxhash64(*[q(c) for c in spread_by])
    left = with_copies(big, keys).withColumn(
        _SALT, F.pmod(row_hash, copies.cast("bigint")).cast("int")
    ).drop(_COPIES)
    right = with_copies(right_side(small), renamed).withColumn(
        "__place", F.explode(F.sequence(F.lit(0), copies - 1))
    ).drop(_COPIES)
    return left.join(right, on & (F.col(_SALT) == F.col("__place")), "left").drop(
        *renamed, _SALT, "__place"
    )
