"""Ads A mart: insights per campaign, ad set and ad, with their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.nested import action_value, audience_text, first_of, post_ref, video_ref
from martkit.functions.text import is_text
from martkit.functions.urls import WATCH, click_url, normalize_video_url
from martkit.operators.dedup import dedup_by_key
from martkit.operators.filters import any_positive
from martkit.operators.incremental import DATE_IN_NAME
from martkit.operators.joins import lookup_default
from martkit.operators.project import lenient_cast, rename_aliases
from martkit.operators.star import build_dim, build_dim_by_key
from martkit.plans import contracts as c

VIDEO_COLUMNS = ["video_url", "video_url_click", "video_thumbnail_url"]


def insights(raw: DataFrame, only_with_data: bool = True) -> DataFrame:
    """Flattened and typed insight rows; rows without any activity are left out.

    Dates that a record lacks come from the day in its file name (column
    ``source_file``, where the reader kept it).
    """
    actions = F.col("actions")
    metrics = {n: action_value(actions, t) for n, t in c.ACTIONS.items()}
    metrics |= {n: action_value(actions, t, as_double=True) for n, t in c.ACTION_VALUES.items()}
    df = raw.withColumns(metrics).drop("actions")
    if "source_file" in df.columns:
        day = F.regexp_extract("source_file", DATE_IN_NAME, 1)
        df = df.withColumns({d: F.coalesce(d, day) for d in ("date_start", "date_stop")})
    if only_with_data:
        df = any_positive(
            df,
            ["spend", *c.ACTION_VALUES],
            ["impressions", "clicks", *c.ACTIONS],
        )
    return lenient_cast(df, c.INSIGHT_LONGS, c.INSIGHT_DOUBLES, zero_nulls=True)


def adset_insights(raw: DataFrame, targeting: DataFrame) -> DataFrame:
    """Insights with the custom audiences that each ad set targets."""
    audiences = targeting.select(
        F.col("id").alias("adset_id"),
        audience_text(F.col("targeting")).alias("publicos_personalizados_incluidos"),
    )
    return lookup_default(
        insights(raw),
        dedup_by_key(audiences, ["adset_id"]),
        ["adset_id"],
        {"publicos_personalizados_incluidos": ""},
        counts_from=raw,
    )


def video_links(creatives: DataFrame, media: DataFrame) -> DataFrame:
    """``ad_id`` and its three links: from the video, else from the post."""
    creative = F.col("creative")
    refs = creatives.select(
        "ad_id", video_ref(creative).alias("video"), post_ref(creative).alias("post")
    ).withColumn("ref", F.coalesce("video", "post"))
    meta = media.select(
        F.col("id").alias("ref"),
        F.when(is_text(F.col("permalink_url")), F.col("permalink_url")).alias("link"),
        F.when(is_text(F.col("picture")), F.col("picture")).alias("picture"),
        first_of(F.col("thumbnails")["data"], "uri").alias("thumb"),
        "full_picture",
    )
    found = lookup_default(refs, dedup_by_key(meta, ["ref"]), ["ref"], {})
    is_video = F.col("video").isNotNull()
    video_url = normalize_video_url(F.coalesce("link", F.concat(F.lit(WATCH), F.col("video"))))
    post_url = F.coalesce(F.col("link"), normalize_video_url(F.col("post")))
    thumbnail = F.when(is_video, F.coalesce("picture", "thumb")).otherwise(F.col("full_picture"))
    url = F.coalesce(F.when(is_video, video_url).otherwise(post_url), F.lit(""))
    return found.select("ad_id", url.alias("video_url"), thumbnail.alias("__thumb")).select(
        "ad_id",
        "video_url",
        click_url(F.col("video_url")).alias("video_url_click"),
        F.coalesce("__thumb", F.lit("")).alias("video_thumbnail_url"),
    )


def ad_insights(raw: DataFrame, creatives: DataFrame, media: DataFrame) -> DataFrame:
    """Insights with the links of each ad's video or post."""
    links = dedup_by_key(video_links(creatives, media), ["ad_id"])
    return lookup_default(
        insights(raw), links, ["ad_id"], dict.fromkeys(VIDEO_COLUMNS, ""), counts_from=raw
    )


def dim_camp(rows: DataFrame, order: list | None = None) -> DataFrame:
    """One row per campaign; with ``order`` (newest first) its newest row decides."""
    rows = rename_aliases(rows, c.ADS_A_DIM_ALIASES)
    return build_dim_by_key(rows, c.ADS_A_DIM_CAMP, ["campaign_id"], order)


def build_ads_a(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``campaigns, adsets, targeting, ads, creatives, media`` to the tables of the mart."""
    campaigns = insights(inputs["campaigns"])
    adsets = adset_insights(inputs["adsets"], inputs["targeting"])
    ads = ad_insights(inputs["ads"], inputs["creatives"], inputs["media"])
    newest = [F.col("date_stop").desc_nulls_last(), F.col("campaign_name"), F.col("spend").desc()]
    return {
        "campaigns": campaigns,
        "adsets": adsets,
        "ads": ads,
        "dim_camp": dim_camp(campaigns, newest),
        "dim_adset": build_dim(adsets, c.ADS_A_DIM_ADSET),
        "dim_ad": build_dim(ads, c.ADS_A_DIM_AD),
    }
