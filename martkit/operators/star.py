"""Dimension and fact builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.dedup import dedup_by_key, distinct_rows
from martkit.operators.project import q, select_all
from martkit.operators.spread import left_lookup


def build_dim(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of the dimension's columns."""
    return distinct_rows(select_all(df, cols))


def build_dim_by_key(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key."""
    if order is None:
        return dedup_by_key(select_all(df, cols), keys)
    return select_all(dedup_by_key(df, keys, order), cols)


def build_fact(
    df: DataFrame,
    cols: Sequence[str],
    natural_key: Sequence[str] | None = None,
    load_col: str | None = None,
) -> DataFrame:
    """The contract columns of every row, no dedup.

    With ``natural_key`` and ``load_col`` only the rows of the newest load of
    each natural key stay, for feeds that are re-read in full. The newest load
    is aggregated map-side and looked up, so a hot key is not gathered.
    """
    if natural_key is None or load_col is None:
        return select_all(df, cols)
    newest = df.groupBy(*[q(k) for k in natural_key]).agg(
        F.max(q(load_col)).alias("__newest"), F.count(F.lit(1)).alias("__n")
    )
    kept = left_lookup(df, newest, natural_key, nulls_match=True, count_col="__n")
    return select_all(kept.where(q(load_col).eqNullSafe(F.col("__newest"))), cols)


def attach_dims(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of several dimensions on the fact, each by its key (one row per key)."""
    source = fact
    for key, dim in dims.items():
        fact = left_lookup(fact, dim, [key], counts_from=source)
    return fact
