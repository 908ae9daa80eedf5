"""Grouped aggregates; each is combined map-side before its one shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martkit.functions.nested import set_join
from martkit.operators.project import q


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Column, skip_nulls: Mapping[str, bool]
) -> DataFrame:
    """per column the first value, or the first non-null one, in ``order``."""
    return df.groupBy(*[q(k) for k in keys]).agg(
        *[
            F.min_by(q(c), F.when(q(c).isNotNull(), order) if skip else order).alias(c)
            for c, skip in skip_nulls.items()
        ]
    )


def set_text(df: DataFrame, keys: Sequence[str], col: Column, alias: str, sep: str = ", ") -> DataFrame:
    """sorted distinct values of a group as one text.

    The set is merged map-side, so a hot key sends its distinct values, not its
    rows; what reaches one task is no larger than the text it has to return.
    """
    return df.groupBy(*[q(k) for k in keys]).agg(set_join(F.collect_set(col), sep).alias(alias))


def pivot_attributes(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    labels: Sequence[str],
    order: Column,
) -> DataFrame:
    """one column per label holding the first non-null value in ``order``.

    The labels come from the attribute dimension, so no job looks for them, and
    one aggregation does the whole pivot.
    """
    present = q(value).isNotNull()
    return df.groupBy(*[q(k) for k in keys]).agg(
        *[
            F.min_by(q(value), F.when((q(name) == F.lit(label)) & present, order)).alias(label)
            for label in labels
        ]
    )


def max_value(df: DataFrame, col: str, alias: str) -> DataFrame:
    """F04."""
    return df.agg(F.max(q(col)).alias(alias))


def profile(df: DataFrame, cols: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """row count, nulls per column and exact distinct counts, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(q(c).isNull()).alias(f"{c}_nulls") for c in cols],
        *[F.count_distinct(q(c)).alias(f"{c}_distinct") for c in distinct],
    )


def observed(df: DataFrame, name: str, cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """the same counts taken while the frame is written, without another job."""
    seen = Observation(name)
    return (
        df.observe(
            seen,
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(q(c).isNull()).alias(f"{c}_nulls") for c in cols],
        ),
        seen,
    )
