"""Lenient and strict number parsing. Columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import strip

# A whole or decimal number with nothing around it. Spark's own casts also take
# padded text, "NaN", "Infinity", hexadecimal and the Java suffixes "1.0d"/"1.0f".
_LONG = r"^[+-]?[0-9]+\z"
_DOUBLE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def to_long(c: Column, default: int | None = None) -> Column:
    """Whole number or null (``default``); "1.5" is not a whole number."""
    text = c.cast("string")
    out = F.when(text.rlike(_LONG), text.try_cast("bigint"))
    return out if default is None else F.coalesce(out, F.lit(default).cast("bigint"))


def to_double(c: Column, default: float | None = None) -> Column:
    """Number or null (``default``)."""
    text = c.cast("string")
    out = F.when(text.rlike(_DOUBLE), text.try_cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def truncated(c: Column) -> Column:
    """Number text cut to its whole part ("3.9" -> 3), null if it is no number."""
    return to_double(strip(c.cast("string"))).try_cast("bigint")


def comma_to_dot(c: Column) -> Column:
    """Decimal comma to point; text with two separators is no number either way."""
    return F.replace(c, F.lit(","), F.lit("."))


def decimal_comma(c: Column, default: float | None = 0.0) -> Column:
    """C11: "1,5" -> 1.5; anything that is no number -> ``default``."""
    return to_double(comma_to_dot(c), default)


def scrub_int(c: Column) -> Column:
    """Digits and minus signs only, so "1.234" is 1234 (thousands separator)."""
    return to_long(F.regexp_replace(c, r"[^0-9\-]", ""), 0)


def scrub_float(c: Column) -> Column:
    """First comma to dot, then digits, dots and minus signs only."""
    dotted = F.regexp_replace(c, r"^([^,]*),", "$1.")
    return to_double(F.regexp_replace(dotted, r"[^0-9.\-]", ""), 0.0)


def brl_to_decimal(c: Column) -> Column:
    """C14: "R$ 1.234,56" -> 1234.56 as decimal(18,2).

    Strict: malformed text stops the job whatever the ANSI setting, because
    money must not turn into null unseen.
    """
    bare = F.regexp_replace(c, r"[R$\s\xA0.]", "")
    value = comma_to_dot(bare).try_cast("decimal(18,2)")
    bad = F.raise_error(F.concat(F.lit("not an amount of money: "), c)).cast("decimal(18,2)")
    return F.when(c.isNotNull(), F.coalesce(value, bad))
