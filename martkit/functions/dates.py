"""Date and time parsing without any dependence on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import clip, strip

# Portuguese month abbreviations in calendar order, the date
# formats of the feeds, the open end of a validity interval.
PT_MONTHS = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")
ISO_DATE = "yyyy-M-d"
BR_DATE = "d/M/yyyy"
OPEN_END = "9999-12-31 23:59:59"

_SECONDS = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z"
_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
_PRINTED = r"^(\d+)-(\d\d)-(\d\d) (\d\d:\d\d:\d\d).*$"


def parse_date(c: Column, fmt: str = ISO_DATE) -> Column:
    """Date or null; one-digit days and months are accepted.

    ISO text is cast, which costs half as much as a pattern.
    """
    if fmt == ISO_DATE:
        text = strip(c.cast("string"))
        return F.when(text.rlike(_DAY), text.try_cast("date"))
    return F.try_to_date(strip(c), fmt)


def parse_iso_ts(c: Column) -> Column:
    """Wall-clock time from ISO text; a zone or fraction is cut off, not applied."""
    text = F.translate(clip(c.cast("string"), 19), "T", " ")
    return F.when(text.rlike(_SECONDS), text.try_cast("timestamp_ntz"))


def pt_month_to_date_text(c: Column) -> Column:
    """C22: "jan/2026" -> "01/01/2026"; null when the month is unknown."""
    months = F.create_map(
        *[F.lit(x) for i, m in enumerate(PT_MONTHS, 1) for x in (m, f"{i:02d}")]
    )
    part = F.split(strip(c), "/")
    month = F.try_element_at(months, F.lower(F.get(part, F.lit(0))))
    return F.concat(F.lit("01/"), month, F.lit("/"), F.get(part, F.lit(1)))


def epoch_ms_to_ts(c: Column) -> Column:
    """Milliseconds since 1970 -> UTC wall-clock time."""
    seconds = c.cast("bigint").cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)")
    )


def ts_to_epoch_ms(c: Column) -> Column:
    """UTC wall-clock time -> whole milliseconds since 1970."""
    t = c.cast("timestamp_ntz")
    days = F.date_diff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1000 + (F.extract(F.lit("SECOND"), t) * 1000).cast("bigint")


def fixed_offset(c: Column, hours: int = -3) -> Column:
    """Shift by a fixed number of hours (no daylight saving rule)."""
    return c.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def br_text(c: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss``."""
    return F.regexp_replace(c.cast("timestamp_ntz").cast("string"), _PRINTED, "$3/$2/$1 $4")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")
