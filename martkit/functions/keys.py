"""Surrogate and composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import is_text


def pipe_key(*cols: Column) -> Column:
    """``a|b``; null when any part is null."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit("|"), c.cast("string")]
    return F.concat(*parts[1:])


def md5_key(*cols: Column) -> Column:
    """MD5 of the joined text, null parts counting as empty."""
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def fallback_key(role: Column, **candidates: Column) -> Column:
    """``<name>:<value>|role:<role>`` of the first candidate that has a value.

    Null when no candidate has one.
    """
    tail = F.concat(F.lit("|role:"), F.coalesce(role.cast("string"), F.lit("")))
    return F.coalesce(
        *[
            F.when(is_text(c.cast("string")), F.concat(F.lit(f"{name}:"), c.cast("string"), tail))
            for name, c in candidates.items()
        ]
    )
