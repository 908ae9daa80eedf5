"""Text cleansing: every function maps a Column to a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for "no value" in the feeds, the label of a
# list without a name, the prefix of custom field columns.
NULL_TOKENS = ("", "null", "NULL", "None", "NaN")
BLANK_TOKENS = ("", "none", "nan")
UNKNOWN_LIST = "unknown_list"
CUSTOM_PREFIX = "cf__"

_LONGEST_BLANK = max(map(len, BLANK_TOKENS))

# White space that plain trim() leaves in place, the no-break space included.
SPACES = " \t\n\x0b\f\r\u00a0"


def strip(c: Column) -> Column:
    """C17: drop surrounding white space of every kind."""
    return F.btrim(c, F.lit(SPACES))


def clip(c: Column, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(c, 1, n)


def null_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null for every spelling of "no value" (exact match)."""
    return F.when(~c.isin(*tokens), c)


def blank_to_zero(c: Column) -> Column:
    """Trimmed text, or "0" for null, blank, none and nan in any case."""
    t = strip(c)
    blank = (F.octet_length(t) <= _LONGEST_BLANK) & F.lower(t).isin(*BLANK_TOKENS)
    return F.when(t.isNull() | blank, F.lit("0")).otherwise(t)


def is_text(c: Column) -> Column:
    """True for a non-null, non-empty value (never null itself)."""
    return F.coalesce(c != "", F.lit(False))


def slugify(c: Column) -> Column:
    """Lower-case identifier of letters, digits and single underscores."""
    kept = F.regexp_replace(F.lower(c), r"[^a-z0-9_\s\xA0]", "")
    return F.btrim(F.regexp_replace(strip(kept), r"[\s\xA0_]+", "_"), F.lit("_"))


def custom_field_name(title: Column, field_id: Column) -> Column:
    """``cf__<slug>``, or ``cf__field_<id>`` when the field has no title."""
    return F.when(
        is_text(strip(title)), F.concat(F.lit(CUSTOM_PREFIX), slugify(title))
    ).otherwise(F.concat(F.lit(CUSTOM_PREFIX + "field_"), field_id.cast("string")))


def _present(c: Column) -> Column:
    """Stripped text, null when there is none."""
    t = strip(c.cast("string"))
    return F.when(is_text(t) & (t != "nan"), t)


def format_label(name: Column, status: Column | None = None) -> Column:
    """``name [status]``; a blank name becomes ``unknown_list``."""
    label = F.coalesce(_present(name), F.lit(UNKNOWN_LIST))
    if status is None:
        return label
    return F.concat(
        label, F.coalesce(F.concat(F.lit(" ["), _present(status), F.lit("]")), F.lit(""))
    )
