"""Ads B mart: sheet exports to five facts and six dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.dates import parse_date
from martkit.functions.numbers import comma_to_dot, scrub_float, scrub_int
from martkit.operators.combine import stack_relaxed
from martkit.operators.ids import add_dim_ids, label_counts, number_labels, strip_label
from martkit.operators.project import (
    align_to_contract,
    blank_to_zero,
    lenient_cast,
    q,
    select_all,
    select_present,
)
from martkit.operators.spread import left_lookup
from martkit.operators.star import build_dim, build_fact
from martkit.plans import contracts as c
from martkit.workspace import written

AUDIENCE = "publicos_do_grupo"


def bronze(sheet: DataFrame, floats: Sequence[str] = tuple(c.ADS_B_FLOATS)) -> DataFrame:
    """Sheet cells as the bronze file holds them: no blanks, decimal points, ISO dates."""
    df = blank_to_zero(sheet)
    have = set(df.columns)
    changes = {f: comma_to_dot(q(f)) for f in floats if f in have}
    return lenient_cast(
        df.withColumns(changes), floats=list(floats), dates_iso=["data"], zero_nulls=True
    )


def silver(feed: DataFrame) -> DataFrame:
    """Typed rows; numbers that cannot be read are zero, dates that cannot are null."""
    return lenient_cast(
        feed, c.ADS_B_INTS, c.ADS_B_FLOATS, ["data"], zero_nulls=True, comma=True
    )


def silver_audience(feed: DataFrame) -> DataFrame:
    """Typed audience rows with the dense id of their audience, 0 for none."""
    have = set(feed.columns)
    typed = {x: scrub_int(q(x)) for x in c.ADS_B_INTS if x in have}
    typed |= {x: scrub_float(q(x)) for x in c.ADS_B_AUDIENCE_FLOATS if x in have}
    typed |= {"data": parse_date(q("data"))}
    df = feed.withColumns(typed)
    if AUDIENCE not in have:
        return df
    return add_dim_ids(strip_label(df, AUDIENCE), AUDIENCE, "id_publico")


AD_LABELS = ("dispositivo", "rede")


def ad_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All ad rows in contract order; files from before a column existed get it as null."""
    text = set(c.ADS_B_AD_COLUMNS) - {"data", *c.ADS_B_INTS, *c.ADS_B_FLOATS}
    types = {x: "string" for x in text} | {"data": "date"}
    types |= {x: "bigint" for x in c.ADS_B_INTS} | {x: "double" for x in c.ADS_B_FLOATS}
    schema = T.StructType.fromDDL(", ".join(f"{x} {types[x]}" for x in c.ADS_B_AD_COLUMNS))
    return stack_relaxed(*[align_to_contract(f, schema) for f in frames])


def label_ids(rows: DataFrame, label: str) -> DataFrame:
    """A label's text ids in sort order, null last, with the number of its rows: the dimension of the label."""
    numbered = number_labels(label_counts(rows, label, include_null=True), label, f"id_{label}")
    return numbered.withColumn(f"id_{label}", q(f"id_{label}").cast("string"))


def with_label_ids(rows: DataFrame, ids: Mapping[str, DataFrame]) -> DataFrame:
    """The ad rows with the text ids of device and network."""
    df = rows
    for label, numbered in ids.items():
        df = left_lookup(df.drop(f"id_{label}"), numbered, [label], nulls_match=True, count_col="__n")
    return select_present(df, c.ADS_B_AD_COLUMNS)


def combine_ads(frames: Sequence[DataFrame]) -> DataFrame:
    """All ad rows in contract order with text ids for device and network."""
    rows = ad_rows(frames)
    return with_label_ids(rows, {x: label_ids(rows, x) for x in AD_LABELS})


_TABLES_OF = {
    "campaigns": ("dim_campanha", "fato_campanha"), "groups": ("dim_grupoAnuncio", "fato_grupoAnuncio"),
    "keywords": ("fato_keywords",),
}


def build_ads_b(inputs: dict[str, DataFrame], only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """``campaigns, groups, ads, keywords, audiences`` (text) to the tables of the mart, or to those of ``only``.

    A feed is typed and written once, when its first table is asked for; facts
    and dimensions read what is written. With one table asked for, a feed of
    campaigns, groups or keywords is read by that table alone and not written.
    """

    @cache
    def typed(name: str) -> DataFrame:
        rows = silver(inputs[name])
        return rows if only is not None and sum(t in only for t in _TABLES_OF[name]) < 2 else written(rows)

    @cache
    def ads() -> DataFrame:
        return written(ad_rows([silver(inputs["ads"])]))

    @cache
    def ids(label: str) -> DataFrame:
        return written(label_ids(ads().select(label), label))

    @cache
    def audiences() -> DataFrame:
        return written(silver_audience(inputs["audiences"]))

    tables = {
        "dim_anuncio": lambda: build_dim(ads(), c.DIM_ANUNCIO),
        "dim_campanha": lambda: build_dim(typed("campaigns"), c.DIM_CAMPANHA),
        "dim_dispositivo": lambda: select_all(ids("dispositivo"), c.DIM_DISPOSITIVO),
        "dim_grupoAnuncio": lambda: build_dim(typed("groups"), c.DIM_GRUPO),
        "dim_rede": lambda: select_all(ids("rede"), c.DIM_REDE),
        "dim_publico_alvo": lambda: build_dim(audiences(), c.DIM_PUBLICO),
        "fato_campanha": lambda: build_fact(typed("campaigns"), c.FATO_CAMPANHA),
        "fato_grupoAnuncio": lambda: build_fact(typed("groups"), c.FATO_GRUPO),
        "fato_keywords": lambda: build_fact(typed("keywords"), c.FATO_KEYWORDS),
        "fato_anuncio": lambda: build_fact(
            with_label_ids(ads(), {x: ids(x) for x in AD_LABELS}), c.FATO_ANUNCIO
        ),
        "fato_publico_alvo": lambda: build_fact(audiences(), c.FATO_PUBLICO),
    }
    return {name: make() for name, make in tables.items() if only is None or name in only}


def max_date(df: DataFrame) -> DataFrame:
    """Newest business date of a feed, for its control row."""
    return df.agg(F.max("data").alias("max_date"))
