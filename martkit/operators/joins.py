"""Lookups, membership and enrichment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.text import strip
from martkit.operators.project import q
from martkit.operators.spread import left_lookup


def lookup_default(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, object],
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Left lookup; a key without a match gets the default."""
    out = left_lookup(df, dim, keys, counts_from=counts_from)
    types = {f.name: f.dataType for f in dim.schema.fields}
    return out.withColumns(
        {c: F.coalesce(q(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    )


def _comparable(left: DataFrame, key: str, right: DataFrame, other: str) -> Callable[[Column], Column]:
    """Ids of one type are compared as they are, others as text."""
    same = left.schema[key].dataType == right.schema[other].dataType
    return (lambda c: c) if same else (lambda c: c.cast("string"))


def lookup_label(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, dim_label: str, alias: str
) -> DataFrame:
    """Name for an id; ids of different types are compared as text."""
    plain = _comparable(df, key, dim, dim_key)
    right = dim.select(plain(q(dim_key)).alias("__id"), q(dim_label).alias(alias))
    return left_lookup(df.withColumn("__id", plain(q(key))), right, ["__id"]).drop("__id")


def left_on(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on several columns; ``dim`` has one row per key."""
    return left_lookup(df, dim, on)


def consolidate(base: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Add several one-row-per-key frames to a base that has one row per key.

    All inputs are partitioned by the same key, so each is shuffled once at most.
    """
    return reduce(lambda left, part: left.join(part, list(keys), "left"), parts, base)


def keep_members(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the other frame."""
    return df.join(other.select(q(key)), key, "left_semi")


def member_flag(
    df: DataFrame,
    other: DataFrame,
    key: str,
    alias: str,
    as_text: bool = False,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """1 where the key is in the other frame, else 0; keys of different types compare as text."""
    plain = _comparable(df, key, other, key)
    known = other.select(plain(q(key)).alias("__id"))
    members = known.where(F.col("__id").isNotNull()).distinct().withColumn("__is_member", F.lit(1))
    counts = df if counts_from is None else counts_from
    out = left_lookup(
        df.drop(alias).withColumn("__id", plain(q(key))), members, ["__id"],
        counts_from=counts.select(plain(q(key)).alias("__id")),
    )
    flag = F.coalesce(F.col("__is_member"), F.lit(0)).cast("string" if as_text else "bigint")
    return out.withColumn(alias, flag).drop("__id", "__is_member")


def new_rows(df: DataFrame, control: DataFrame, key: str) -> DataFrame:
    """Rows with a key that the control set does not hold."""
    return df.where(q(key).isNotNull()).join(control.select(q(key)), key, "left_anti")


def append_control(control: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """The control set with the new keys, each once."""
    fresh = df.select(q(key)).where(q(key).isNotNull())
    return control.select(q(key)).unionByName(fresh).distinct()


def normalized_label(c: Column) -> Column:
    """Field names compare without case, surrounding space or underscores."""
    return F.lower(strip(F.translate(c, "_", " ")))


LABELS = 200  # field names that may stand in an expression


def map_to_columns(
    df: DataFrame,
    key: str,
    map_col: str,
    labels: DataFrame,
    aliases: Mapping[str, str],
    one_per_key: bool = False,
) -> DataFrame:
    """Open-keyed map to one column per alias, one row per key.

    ``labels`` (key, name) gives the readable name of an opaque map key; a map
    key without one names itself. Among several entries of one alias the last
    in the map wins. Aliases that a row does not carry are empty text; rows that
    carry none are left out. The labels that matter, those of an alias's name or
    key, are fetched at once; up to ``LABELS`` of them go into an expression on
    the map, which is neither exploded nor, with ``one_per_key``, shuffled. More
    of them are joined to the exploded entries.
    """
    wanted = {alias.lower().replace("_", " ").strip(): col for alias, col in aliases.items()}
    columns = {col: [n for n, c in wanted.items() if c == col] for col in dict.fromkeys(wanted.values())}
    named = labels.select(q("key").alias("key"), q("name").alias("name")).where("key IS NOT NULL AND name IS NOT NULL")
    few = named.where(normalized_label(F.col("name")).isin(*wanted) | normalized_label(F.col("key")).isin(*wanted))
    known = few.limit(LABELS + 1).collect()
    if len(known) > LABELS:
        hits = _joined_hits(df, key, map_col, named, columns)
    else:
        hits = _expression_hits(df, key, map_col, dict(known), columns)
        if one_per_key:
            return hits.select(q(key), *[F.coalesce(F.col(c)["value"], F.lit("")).alias(c) for c in columns])
    return hits.groupBy(q(key)).agg(*[F.coalesce(F.max(c)["value"], F.lit("")).alias(c) for c in columns])


def _expression_hits(
    df: DataFrame, key: str, map_col: str, labels: Mapping[str, str], columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Each column's last entry in the row's map, as place and value; rows with one at least."""
    every = [n for names in columns.values() for n in names]

    def entry(e: Column, i: Column) -> Column:
        name = e["key"]
        for field, label in labels.items():
            name = F.when(e["key"] == field, F.lit(label)).otherwise(name)
        value = F.coalesce(e["value"].cast("string"), F.lit(""))
        return F.struct(i.alias("pos"), value.alias("value"), normalized_label(name).alias("name"))

    def last(names: Sequence[str]) -> Column:
        hit = F.try_element_at(F.filter("__hits", lambda x: x["name"].isin(*names)), F.lit(-1))
        return F.when(hit.isNotNull(), F.struct(hit["pos"].alias("pos"), hit["value"].alias("value")))

    entries = F.transform(F.map_entries(q(map_col)), entry)
    rows = df.select(q(key), F.filter(entries, lambda x: x["name"].isin(*every)).alias("__hits")).where(F.size("__hits") > 0)
    return rows.select(q(key), *[last(names).alias(c) for c, names in columns.items()])


def _joined_hits(
    df: DataFrame, key: str, map_col: str, labels: DataFrame, columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """As :func:`_expression_hits`, a row for each entry, with the labels joined."""
    entries = df.select(q(key), F.posexplode(q(map_col)).alias("pos", "__field", "__value"))
    named = left_lookup(entries, labels.select(F.col("key").alias("__field"), F.col("name").alias("__name")), ["__field"])
    name = normalized_label(F.coalesce("__name", "__field"))
    value = F.struct("pos", F.coalesce(F.col("__value").cast("string"), F.lit("")).alias("value"))
    kept = named.withColumn("__name", name).where(F.col("__name").isin(*[n for names in columns.values() for n in names]))
    return kept.select(q(key), *[F.when(F.col("__name").isin(*names), value).alias(c) for c, names in columns.items()])


def enrich_attributes(
    df: DataFrame,
    owners: DataFrame,
    key: str,
    owner_key: str,
    map_col: str,
    labels: DataFrame,
    aliases: Mapping[str, str],
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Attach the aliased attributes of each row's owner, empty text if none."""
    wide = map_to_columns(owners, owner_key, map_col, labels, aliases)
    plain = _comparable(df, key, owners, owner_key)
    wide = wide.withColumn("__id", plain(q(owner_key))).drop(owner_key)
    counts = df if counts_from is None else counts_from
    out = left_lookup(
        df.withColumn("__id", plain(q(key))), wide, ["__id"],
        counts_from=counts.select(plain(q(key)).alias("__id")),
    )
    cols = list(dict.fromkeys(aliases.values()))
    return out.withColumns({c: F.coalesce(q(c), F.lit("")) for c in cols}).drop("__id")
