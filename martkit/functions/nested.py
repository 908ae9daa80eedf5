"""Values out of arrays, structs and maps, without exploding rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.numbers import to_double, truncated
from martkit.functions.text import is_text, strip

# Prefix of an audience known by id only, separator of the list.
ID_ONLY_PREFIX = "CA:"
AUDIENCE_SEPARATOR = " | "


def first_of(array: Column, field: str | None = None) -> Column:
    """First element (or one of its fields); null when there is none."""
    head = F.get(array, F.lit(0))
    return head if field is None else head[field]


def action_value(actions: Column, action_type: str, as_double: bool = False) -> Column:
    """Value of the first action of a type; 0 when absent or unreadable."""
    at = F.array_position(actions["action_type"], F.lit(action_type)).cast("int")
    text = F.get(actions["value"], at - 1)
    if as_double:
        return to_double(strip(text.cast("string")), 0.0)
    return F.coalesce(truncated(text), F.lit(0).cast("bigint"))


def _sorted_set(array: Column) -> Column:
    return F.array_sort(F.array_distinct(array))


def audience_text(targeting: Column) -> Column:
    """Sorted audience names, then ``CA:<id>`` of the nameless ones, in one text."""
    nested = F.flatten(
        F.filter(
            F.transform(targeting["flexible_spec"], lambda s: s["custom_audiences"]),
            lambda a: a.isNotNull(),
        )
    )
    both = F.filter(
        F.array(targeting["custom_audiences"], nested), lambda a: a.isNotNull()
    )
    people = F.flatten(both)
    names = F.transform(F.filter(people, lambda p: is_text(p["name"])), lambda p: p["name"])
    ids = F.transform(
        F.filter(people, lambda p: ~is_text(p["name"]) & is_text(p["id"])), lambda p: p["id"]
    )
    labelled = F.transform(_sorted_set(ids), lambda i: F.concat(F.lit(ID_ONLY_PREFIX), i))
    return F.array_join(F.concat(_sorted_set(names), labelled), AUDIENCE_SEPARATOR)


def video_ref(creative: Column) -> Column:
    """Video id of the story, else the first one in the asset feed."""
    story = creative["object_story_spec"]["video_data"]["video_id"].cast("string")
    feed = first_of(
        F.filter(
            F.transform(
                creative["asset_feed_spec"]["videos"], lambda v: v["video_id"].cast("string")
            ),
            is_text,
        )
    )
    return F.coalesce(F.when(is_text(story), story), feed)


def post_ref(creative: Column) -> Column:
    """Post id that stands in when a creative has no video."""
    return F.coalesce(
        *[
            F.when(is_text(creative[f]), creative[f])
            for f in ("effective_object_story_id", "object_story_id")
        ]
    )


def set_join(array: Column, sep: str = ", ") -> Column:
    """sorted distinct non-blank elements as one text."""
    kept = F.filter(F.transform(array, strip), lambda x: is_text(x) & (x != "nan"))
    return F.array_join(_sorted_set(kept), sep)
