"""Contacts mart: contacts with custom fields, tags and lists; lead table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.text import clip, custom_field_name, format_label, strip
from martkit.operators.aggregate import pivot_attributes, set_text
from martkit.operators.combine import stack_strict
from martkit.operators.dedup import dedup_by_key
from martkit.operators.filters import require_text
from martkit.operators.joins import consolidate, lookup_label
from martkit.operators.project import drop_present, q, rename_aliases, select_renamed
from martkit.plans import contracts as c


def named_values(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Field values under their column name; a field without a title keeps its id."""
    df = lookup_label(values, fields, "field", "id", "title", "__title")
    return df.withColumn("field_col", custom_field_name(F.col("__title"), F.col("field")))


def field_columns(values: DataFrame, fields: DataFrame) -> list[str]:
    """Column names of the custom fields in use: one per field definition, known by a scan."""
    used = named_values(values.select("field").distinct(), fields).select("field_col").distinct()
    return [r[0] for r in used.orderBy("field_col").collect()]


def wide_contacts(
    contacts: DataFrame,
    fields: DataFrame,
    values: DataFrame,
    tags: DataFrame,
    contact_tags: DataFrame,
    lists: DataFrame,
    contact_lists: DataFrame,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per contact: own columns, custom fields, tags and lists as text.

    ``values`` carries ``pos``, the order of the rows in the feed; the first
    value of a field wins. ``columns`` saves the scan for the field names.
    """
    if columns is None:
        columns = field_columns(values, fields)
    named = named_values(values, fields).withColumn("id", F.col("contact").cast("string"))
    custom = pivot_attributes(named, ["id"], "field_col", "value", columns, F.col("pos"))
    tagged = lookup_label(contact_tags, tags, "tag", "id", "tag", "tag_name")
    tag_text = set_text(
        tagged.withColumn("id", F.col("contact").cast("string")), ["id"], F.col("tag_name"), "tags"
    )
    listed = lookup_label(contact_lists, lists, "list", "id", "name", "list_name")
    list_text = set_text(
        listed.withColumn("id", F.col("contact").cast("string")),
        ["id"],
        format_label(F.col("list_name"), F.col("status")),
        "lists",
    )
    base = drop_present(contacts, ["links"]).withColumn("id", F.col("id").cast("string"))
    return consolidate(base, [custom, tag_text, list_text], ["id"])


def leads(*versions: DataFrame) -> DataFrame:
    """Lead columns of every version, day of creation, one row per e-mail address.

    The oldest version comes first and its row wins; within a version the lowest
    ``pos`` wins if the frames carry one, else the lowest values.
    """
    frames = [
        rename_aliases(v, c.CONTACT_LEAD_ALIASES).withColumn("__version", F.lit(i))
        for i, v in enumerate(versions)
    ]
    return leads_over(stack_strict(*frames), "__version")


def leads_over(versions: DataFrame, by: str) -> DataFrame:
    """As :func:`leads`, from one frame that holds all versions, told apart and ordered by a column."""
    df = versions.withColumn("cdate_Active", clip(strip(F.col("cdate_Active")), 10))
    kept = require_text(df, "email_lead_Active")
    names = [*(["pos"] if "pos" in kept.columns else []), *c.CONTACT_LEAD.values()]
    order = [q(by), *[q(x).asc_nulls_last() for x in names]]
    return dedup_by_key(kept, ["email_lead_Active"], order).drop(by, "pos")


def lead_columns(wide: DataFrame) -> DataFrame:
    """The seven lead columns; a custom field that no contact has is null."""
    absent = {x: F.lit(None).cast("string") for x in c.CONTACT_LEAD if x not in wide.columns}
    return select_renamed(wide.withColumns(absent), c.CONTACT_LEAD)


def build_contacts(inputs: dict[str, DataFrame], *older: DataFrame) -> dict[str, DataFrame]:
    """The seven contact feeds to the wide table and the lead table.

    ``older`` are the lead columns of earlier versions, the oldest first.
    """
    wide = wide_contacts(
        inputs["contacts"], inputs["fields"], inputs["field_values"], inputs["tags"],
        inputs["contact_tags"], inputs["lists"], inputs["contact_lists"],
    )
    return {"contacts": wide, "leads": leads(*older, lead_columns(wide))}
