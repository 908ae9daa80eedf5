"""One row per key.

All of these rank with ``row_number() = 1``. Spark turns that into a group
limit that runs before the shuffle as well as after it, so a task sends at most
one row per key onwards and a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martkit.functions.text import is_text
from martkit.operators.project import q

_RANK = "__rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """F06."""
    return df.distinct()


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """the first row of each key in the given order.

    Without an order the lowest row wins, comparing the other columns from left
    to right, so that the choice does not depend on how the data is partitioned.
    """
    if order is None:
        order = [
            q(f.name).asc_nulls_last()
            for f in df.schema.fields
            if f.name not in keys and not isinstance(f.dataType, T.MapType)
        ] or [q(keys[0])]
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def last_wins(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest row of each key; rows without a key are all kept.

    ``order`` runs from newest to oldest. Rows without a key never enter the
    window, where they would form one huge group.
    """
    is_string = isinstance(df.schema[key].dataType, T.StringType)
    keyed = is_text(q(key)) if is_string else q(key).isNotNull()
    return dedup_by_key(df.where(keyed), [key], order).unionByName(df.where(~keyed))
