"""Stacking frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from martkit.operators.project import select_all


def stack_strict(*dfs: DataFrame) -> DataFrame:
    """Same columns and types, or an error."""
    want = [(f.name, f.dataType) for f in dfs[0].schema.fields]
    for df in dfs[1:]:
        have = [(f.name, f.dataType) for f in df.schema.fields]
        if sorted(have, key=str) != sorted(want, key=str):
            raise ValueError(f"schemas differ: {want} against {have}")
    return reduce(DataFrame.unionByName, dfs)


def stack_relaxed(*dfs: DataFrame) -> DataFrame:
    """Same columns, types widened to their common type."""
    return reduce(DataFrame.unionByName, dfs)


def stack_diagonal(*dfs: DataFrame) -> DataFrame:
    """Union of the columns, null where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def stack_distinct(*dfs: DataFrame) -> DataFrame:
    """I05."""
    return reduce(DataFrame.unionByName, dfs).distinct()


def stack_contract(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Stack the frames that have every contract column, skip the others."""
    whole = [select_all(df, cols) for df in dfs if set(cols) <= set(df.columns)]
    if not whole:
        raise ValueError(f"no input has all of {list(cols)}")
    return stack_relaxed(*whole)
