"""Projection, renaming and typing of whole frames. One select per operator."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions import dates, numbers, text


def q(name: str) -> Column:
    """Column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([q(c) for c in cols if c in df.columns])


def select_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns; the analyzer rejects a missing one."""
    return df.select([q(c) for c in cols])


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename old to new where the old name exists and the new one does not."""
    have = set(df.columns)
    return df.withColumnsRenamed(
        {old: new for old, new in aliases.items() if old in have and new not in have}
    )


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep only the listed columns, each under its new name."""
    return df.select([q(old).alias(new) for old, new in names.items()])


def drop_present(
    df: DataFrame,
    cols: Iterable[str] = (),
    prefixes: tuple[str, ...] = (),
    suffixes: tuple[str, ...] = (),
) -> DataFrame:
    """Drop by name, prefix or suffix; absent names are no error."""
    gone = set(cols)
    return df.select(
        [
            q(c)
            for c in df.columns
            if c not in gone and not c.startswith(prefixes) and not c.endswith(suffixes)
        ]
    )


def align_to_contract(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Contract order and types; a missing column gets its default or null.

    Columns that are there keep their values and nulls; text that does not fit
    the contract type becomes null.
    """
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(
        [
            (
                (q(f.name) if df.schema[f.name].dataType == f.dataType else q(f.name).try_cast(f.dataType))
                if f.name in have
                else F.lit(defaults.get(f.name)).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def fill_absent(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default for fields that a record does not carry.

    A fixed read schema turns an absent field into null, so nulls are filled;
    a column that no record carries is added.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {
        c: F.coalesce(q(c), F.lit(v).cast(types[c])) if c in types else F.lit(v)
        for c, v in defaults.items()
    }
    return df.withColumns(filled)


def all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select([q(c).cast("string").alias(c) for c in df.columns])


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def _map(df: DataFrame, how: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    return df.select([how[c](q(c)).alias(c) if c in how else q(c) for c in df.columns])


def lenient_cast(
    df: DataFrame,
    ints: Sequence[str] = (),
    floats: Sequence[str] = (),
    dates_iso: Sequence[str] = (),
    timestamps: Sequence[str] = (),
    zero_nulls: bool = False,
    comma: bool = False,
) -> DataFrame:
    """Type column groups; what does not parse is null, or zero on request.

    ``comma`` reads the floats with a decimal comma. Names that the frame does
    not have are ignored. Columns that are typed already are not parsed again:
    numbers are converted (decimals are cut), dates and timestamps pass through.
    """
    number = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    moment = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DatetimeType)}

    def typed(c: str, kind: str, parse: Callable[[Column], Column], zero: Column) -> Callable[[Column], Column]:
        read = (lambda x: x.try_cast(kind)) if c in number else parse
        return (lambda x: F.coalesce(read(x), zero)) if zero_nulls else read

    as_float = (lambda x: numbers.decimal_comma(x, None)) if comma else numbers.to_double
    zero_long, zero_double = F.lit(0).cast("bigint"), F.lit(0.0)
    how: dict[str, Callable[[Column], Column]] = {}
    how.update({c: typed(c, "bigint", numbers.to_long, zero_long) for c in ints})
    how.update({c: typed(c, "double", as_float, zero_double) for c in floats})
    how.update({c: dates.parse_date for c in dates_iso if c not in moment})
    how.update({c: dates.parse_iso_ts for c in timestamps if c not in moment})
    return _map(df, how)


def blank_to_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """On every column, text and dates included, unless ``columns`` restricts it."""
    return _map(df, {c: text.blank_to_zero for c in (columns or df.columns)})


def null_tokens(df: DataFrame, tokens: Sequence[str] = text.NULL_TOKENS) -> DataFrame:
    """Spellings of "no value" become null in every text column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _map(df, {c: (lambda x: text.null_tokens(x, tokens)) for c in cols})


def fill_text(df: DataFrame) -> DataFrame:
    """Empty text for null in the text columns."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _map(df, {c: (lambda x: F.coalesce(x, F.lit(""))) for c in cols})


def order_rows(df: DataFrame, order: Sequence[tuple[str, str]], whole: bool = False) -> DataFrame:
    """Sort by several columns, each ``asc`` or ``desc``, nulls always last.

    Files only need order inside them, so rows are sorted within partitions
    unless ``whole`` asks for one order over everything.
    """
    by = [q(c).asc_nulls_last() if way == "asc" else q(c).desc_nulls_last() for c, way in order]
    return df.orderBy(*by) if whole else df.sortWithinPartitions(*by)
