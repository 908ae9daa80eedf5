"""Video and post links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Site prefix and watch link of the video host.
SITE = "https://www.facebook.com"
WATCH = SITE + "/watch/?v="

# First matching pattern decides; text that matches none stays as it is.
_VIDEO_PATH = (r"(?s)^.*?/videos/([0-9]+).*\z", WATCH + "$1")
_RULES = (
    (r"(?s)^(https?://.*)\z", "$1"),
    _VIDEO_PATH,
    (r"^([0-9]+)\z", WATCH + "$1"),
    (r"^([0-9]+)_([0-9]+)\z", SITE + "/$1/posts/$2"),
    (r"(?s)^(/.*)\z", SITE + "$1"),
)


def _rewrite(url: Column, rules) -> Column:
    text = F.coalesce(url, F.lit(""))
    return reduce(
        lambda rest, rule: F.when(
            text.rlike(rule[0]), F.regexp_replace(text, rule[0], rule[1])
        ).otherwise(rest),
        reversed(rules),
        text,
    )


def normalize_video_url(url: Column) -> Column:
    """Absolute link for a path, a video id or a ``page_post`` id."""
    return _rewrite(url, _RULES)


def click_url(url: Column) -> Column:
    """As above, but a ``/videos/<id>`` path wins even in an absolute link."""
    return _rewrite(url, (_VIDEO_PATH, *_RULES))
