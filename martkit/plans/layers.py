"""Landed files to gold tables, mart by mart.

``read_<mart>`` gives a mart's inputs from the folders below a bronze root, with
the read schemas of the contracts; ``save`` writes its tables below a gold root.
When to run what is left to the caller's own scheduler.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.text import NULL_TOKENS
from martkit.operators.combine import stack_strict
from martkit.plans import ads_a, ads_b, contacts, crm, sales_a, sales_b, small
from martkit.plans import contracts as c
from martkit.sources.readers import (
    read_csv_rejects,
    read_csv_text,
    read_envelope_rejects,
    read_json_envelope,
    read_json_records,
    read_json_rejects,
    split_json_envelope,
    split_json_records,
    version_time,
)
from martkit.sources.writers import LOAD_COL, write_table, write_version

Inputs = dict[str, DataFrame]
Rejects = list[DataFrame]

ADS_A_FEEDS = {
    "campaigns": c.ADS_A_CAMPAIGN, "adsets": c.ADS_A_ADSET, "ads": c.ADS_A_AD,
    "targeting": c.ADS_A_TARGETING, "creatives": c.ADS_A_CREATIVE, "media": c.ADS_A_MEDIA,
}
FIELD_VALUE = "contact string, field string, value string"
CONTACT_FEEDS = {
    "contacts": "id string, firstName string, lastName string, email string, cdate string",
    "fields": "id string, title string",
    "tags": "id string, tag string",
    "contact_tags": "contact string, tag string",
    "lists": "id string, name string",
    "contact_lists": "contact string, list string, status string",
}
WEB_RECORD = "dimension_values array<struct<value:string>>, metric_values array<struct<value:string>>"
CRM_FEEDS = {
    "moves": c.MOVE_EVENT, "persons": c.PERSON + ", fields map<string,string>",
    "person_fields": "key string, name string", "deals": "id bigint, status string", "stages": c.STAGE,
}
SOCIAL_FEEDS = {"pages": c.SOCIAL_PAGE, "accounts": c.SOCIAL_ACCOUNT, "channels": c.SOCIAL_CHANNEL}
# record and field of the feeds whose records are a field of their files
SALES_A_FEEDS = {"sales": (c.SALES_A_RECORD, "dados"), "users": (c.USERS_A_RECORD, "dados")}
FIELD_VALUES = {"field_values": (FIELD_VALUE, "fieldValues")}
WEB_FEEDS = {name: (WEB_RECORD, "rows") for name in c.WEB_REPORTS}
CSV_FEEDS = {
    "ads_b": ("campaigns", "groups", "ads", "keywords", "audiences"), "sales_b": ("sales", "projection"), "calls": ("calls",),
}


def save(tables: Mapping[str, DataFrame], root: str, only: Sequence[str] | None = None) -> None:
    """Write tables of a mart, each to a folder of its name."""
    for name, df in tables.items():
        if only is None or name in only:
            write_table(df, f"{root}/{name}")


def _json_folders(
    spark: SparkSession, root: str, schemas: Mapping[str, str], with_file: bool = False, left_out: Rejects | None = None
) -> Inputs:
    """The records of JSON feeds; with ``left_out`` each feed is scanned once for them and for its rejects."""
    if left_out is None:
        return {name: read_json_records(spark, f"{root}/{name}", schema, with_file) for name, schema in schemas.items()}
    inputs = {}
    for name, schema in schemas.items():
        good, bad = split_json_records(spark, f"{root}/{name}", schema)
        inputs[name] = good if with_file else good.drop("source_file")
        left_out.append(bad)
    return inputs


def _envelopes(
    spark: SparkSession, root: str, feeds: Mapping[str, tuple[str, str]], with_file: bool = False, left_out: Rejects | None = None
) -> Inputs:
    """As :func:`_json_folders`, for feeds whose records are a field of their files."""
    if left_out is None:
        return {n: read_json_envelope(spark, f"{root}/{n}", record, field, with_file) for n, (record, field) in feeds.items()}
    inputs = {}
    for name, (record, field) in feeds.items():
        good, bad = split_json_envelope(spark, f"{root}/{name}", record, field)
        inputs[name] = good if with_file else good.drop("source_file")
        left_out.append(bad)
    return inputs


def read_ads_a(spark: SparkSession, root: str, left_out: Rejects | None = None) -> Inputs:
    insights = {n: ADS_A_FEEDS[n] for n in ("campaigns", "adsets", "ads")}
    lookups = {n: s for n, s in ADS_A_FEEDS.items() if n not in insights}
    return _json_folders(spark, root, insights, True, left_out) | _json_folders(spark, root, lookups, left_out=left_out)


def read_ads_b(spark: SparkSession, root: str) -> Inputs:
    feeds = {
        name: read_csv_text(spark, f"{root}/{name}/*.csv")
        for name in ("campaigns", "groups", "ads", "keywords")
    }
    audiences = read_csv_text(spark, f"{root}/audiences/*.csv", null_tokens=NULL_TOKENS)
    return feeds | {"audiences": audiences}


def read_crm(spark: SparkSession, root: str, left_out: Rejects | None = None) -> Inputs:
    """Events, persons and their field names, deals; stage dumps with the time in their file name."""
    flat = _json_folders(spark, root, {n: s for n, s in CRM_FEEDS.items() if n != "stages"}, left_out=left_out)
    stages = _json_folders(spark, root, {"stages": c.STAGE}, True, left_out)["stages"]
    dated = stages.withColumn("snapshot_time", version_time(F.col("source_file"))).drop("source_file")
    return flat | {"stages": dated}


def read_sales_a(spark: SparkSession, root: str, left_out: Rejects | None = None) -> Inputs:
    return _envelopes(spark, root, SALES_A_FEEDS, True, left_out)


def read_sales_b(spark: SparkSession, root: str) -> Inputs:
    return {
        "sales": read_csv_text(spark, f"{root}/sales/*.csv"),
        "projection": read_csv_text(spark, f"{root}/projection/*.csv"),
    }


def read_contacts(spark: SparkSession, root: str, left_out: Rejects | None = None) -> Inputs:
    """Seven feeds; field values carry their position in the file as ``pos``."""
    plain = _json_folders(spark, root, CONTACT_FEEDS, left_out=left_out)
    return plain | _envelopes(spark, root, FIELD_VALUES, left_out=left_out)


def read_social(spark: SparkSession, root: str, left_out: Rejects | None = None) -> dict[str, list[DataFrame]]:
    return {name: [df] for name, df in _json_folders(spark, root, SOCIAL_FEEDS, left_out=left_out).items()}


def read_calls(spark: SparkSession, root: str) -> DataFrame:
    return read_csv_text(spark, f"{root}/calls/*.csv")


def read_fx(spark: SparkSession, root: str, left_out: Rejects | None = None) -> DataFrame:
    return _json_folders(spark, root, {"fx": c.FX}, left_out=left_out)["fx"]


def read_web(spark: SparkSession, root: str, left_out: Rejects | None = None) -> Inputs:
    return _envelopes(spark, root, WEB_FEEDS, left_out=left_out)


def run_crm(spark: SparkSession, bronze: str, silver: str, gold: str, left_out: Rejects | None = None) -> None:
    """The CRM mart; the fact is built from the written silver events, not from the raw ones."""
    inputs = read_crm(spark, bronze, left_out)
    moves = crm.silver_moves(
        inputs["moves"], inputs["persons"], inputs["person_fields"], inputs["deals"]
    )
    save({"deal_move": moves}, silver)
    written = spark.read.schema(c.text_schema(c.MOVE_COLUMNS)).parquet(f"{silver}/deal_move")
    tables = {
        "ft_move": crm.ft_move(written, inputs["deals"]),
        "dim_person": crm.dim_person(inputs["persons"]),
        **crm.stage_dims(inputs["stages"]),
    }
    save(tables, gold)


def _json_rejects(spark: SparkSession, root: str, schemas: Mapping[str, str]) -> list[DataFrame]:
    return [read_json_rejects(spark, f"{root}/{name}", schema) for name, schema in schemas.items()]


def _envelope_rejects(spark: SparkSession, root: str, feeds: Mapping[str, tuple[str, str]]) -> list[DataFrame]:
    return [read_envelope_rejects(spark, f"{root}/{n}", record, field) for n, (record, field) in feeds.items()]


def _csv_rejects(spark: SparkSession, root: str, names: Sequence[str]) -> list[DataFrame]:
    return [read_csv_rejects(spark, f"{root}/{name}/*.csv") for name in names]


def rejects(spark: SparkSession, name: str, root: str) -> DataFrame:
    """File, text and reason of every record that the readers of a mart leave out, by a scan of its own.

    A run of the mart, :func:`run_mart`, writes those of JSON feeds from the scan that reads the records.
    """
    records = {"ads_a": ADS_A_FEEDS, "crm": CRM_FEEDS, "contacts": CONTACT_FEEDS, "social": SOCIAL_FEEDS, "fx": {"fx": c.FX}}
    envelopes = {"sales_a": SALES_A_FEEDS, "contacts": FIELD_VALUES, "web": WEB_FEEDS}
    return stack_strict(
        *_json_rejects(spark, root, records.get(name, {})), *_envelope_rejects(spark, root, envelopes.get(name, {})),
        *_csv_rejects(spark, root, CSV_FEEDS.get(name, ())),
    )


def run_contacts(
    spark: SparkSession, bronze: str, gold: str, version: str | None = None, left_out: Rejects | None = None
) -> None:
    """The contacts mart; leads are those of all versions that ever ran, each kept beside the others."""
    tables = contacts.build_contacts(read_contacts(spark, bronze, left_out))
    write_table(tables["contacts"], f"{gold}/contacts")
    stamp = version or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    wide = spark.read.parquet(f"{gold}/contacts")
    write_version(contacts.lead_columns(wide), f"{gold}/lead_versions", stamp)
    versions = spark.read.parquet(f"{gold}/lead_versions")
    write_table(contacts.leads_over(versions, LOAD_COL), f"{gold}/leads")


def run_mart(
    spark: SparkSession, name: str, bronze: str, gold: str, silver: str | None = None, version: str | None = None
) -> None:
    """Read the landed files of a mart and write its tables, and the records left out to ``rejects``.

    JSON feeds are scanned once: their typed records are written to the shared
    folder, and both the mart and its rejects are built from there.

    ``silver`` is where the CRM mart keeps its events (beside the gold root by
    default); ``version`` names this run's leads in the contacts mart.
    """
    left_out: Rejects = []
    build = {
        "ads_a": lambda: ads_a.build_ads_a(read_ads_a(spark, bronze, left_out)),
        "ads_b": lambda: ads_b.build_ads_b(read_ads_b(spark, bronze)),
        "sales_a": lambda: sales_a.build_sales_a(read_sales_a(spark, bronze, left_out)),
        "sales_b": lambda: sales_b.build_sales_b(read_sales_b(spark, bronze)),
        "social": lambda: small.build_social(read_social(spark, bronze, left_out)),
        "calls": lambda: {"calls": small.build_calls(read_calls(spark, bronze))},
        "fx": lambda: {
            "fx": small.build_fx(
                read_fx(spark, bronze, left_out), F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
            )
        },
        "web": lambda: small.build_web(read_web(spark, bronze, left_out)),
    }
    if name == "crm":
        run_crm(spark, bronze, silver or f"{gold.rstrip('/')}_silver", gold, left_out)
    elif name == "contacts":
        run_contacts(spark, bronze, gold, version, left_out)
    else:
        save(build[name](), gold)
    write_table(stack_strict(*left_out, *_csv_rejects(spark, bronze, CSV_FEEDS.get(name, ()))), f"{gold}/rejects")
