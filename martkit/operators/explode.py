"""Nested data to rows and columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.numbers import to_long
from martkit.operators.project import q


def flatten_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """``{"price_value": "purchase.price.value"}``; null if any level is missing."""
    return df.select([F.col(path).alias(name) for name, path in paths.items()])


def explode_children(
    df: DataFrame,
    array_col: str,
    keep: Callable[[Column], Column],
    child: Callable[[Column], Column],
    parent_cols: Mapping[str, Callable[[Column], Column]],
    child_cols: Mapping[str, Callable[[Column], Column]],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Array elements that pass ``keep``, one row per child of each.

    An element without children keeps one row with null child columns. The
    positions ``pos`` and ``child_pos`` give the order inside the record.
    """
    kept = F.filter(q(array_col), lambda e: F.coalesce(keep(e), F.lit(False)))
    elements = df.select(*[q(c) for c in carry], F.posexplode(kept).alias("pos", "__element"))
    element = F.col("__element")
    return elements.select(
        *[q(c) for c in carry],
        "pos",
        *[f(element).alias(c) for c, f in parent_cols.items()],
        F.posexplode_outer(child(element)).alias("child_pos", "__child"),
    ).select(
        *carry,
        "pos",
        *parent_cols,
        "child_pos",
        *[f(F.col("__child")).alias(c) for c, f in child_cols.items()],
    )


def explode_map(
    df: DataFrame, map_col: str, key_alias: str, value_alias: str, carry: Sequence[str]
) -> DataFrame:
    """One row per map entry."""
    return df.select(*[q(c) for c in carry], F.explode(q(map_col)).alias(key_alias, value_alias))


def flatten_report(
    df: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[str],
    dim_col: str = "dimension_values",
    metric_col: str = "metric_values",
) -> DataFrame:
    """Positional report arrays to named columns; metrics as whole numbers."""
    return df.select(
        *[F.get(q(dim_col), F.lit(i))["value"].alias(c) for i, c in enumerate(dims)],
        *[to_long(F.get(q(metric_col), F.lit(i))["value"]).alias(c) for i, c in enumerate(metrics)],
    )
