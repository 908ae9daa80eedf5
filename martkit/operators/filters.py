"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame

from martkit.functions.dates import open_end
from martkit.functions.numbers import to_double
from martkit.functions.text import is_text
from martkit.operators.project import q


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D01."""
    return df.where(reduce(and_, [q(c).isNotNull() for c in cols]))


def exclude_ids(df: DataFrame, col: str, ids: Sequence | DataFrame) -> DataFrame:
    """Rows whose id is listed go, and so do rows without an id.

    A long list is given as a frame with a column of the same name.
    """
    if isinstance(ids, DataFrame):
        return df.where(q(col).isNotNull()).join(ids.select(q(col)), col, "left_anti")
    return df.where(~q(col).isin(*ids))


def any_positive(df: DataFrame, doubles: Sequence[str], longs: Sequence[str] = ()) -> DataFrame:
    """At least one metric above zero; whole-number metrics are cut first, so 0.5 is not."""
    tests = [to_double(q(c), 0.0) > 0 for c in doubles]
    tests += [to_double(q(c), 0.0) >= 1 for c in longs]
    return df.where(reduce(or_, tests))


def require_text(df: DataFrame, col: str) -> DataFrame:
    """The key is neither null nor empty."""
    return df.where(is_text(q(col)))


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that carry every required field, and the rest."""
    complete = reduce(and_, [q(c).isNotNull() for c in required])
    return df.where(complete), df.where(~complete)


def current_rows(history: DataFrame, end_col: str = "dt_fim_vigencia") -> DataFrame:
    """Versions that are still valid."""
    return history.where(q(end_col) == open_end())
