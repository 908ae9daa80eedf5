"""Column functions: typing, dates, keys, links and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.catalog.registry import query, table
from martkit.functions import dates, keys, nested, numbers, text, urls
from martkit.operators.filters import any_positive
from martkit.operators.joins import lookup_label
from martkit.operators.project import all_to_string, blank_to_zero, fill_text, lenient_cast


def money(c: str) -> Column:
    """Amount as text with two decimals."""
    return F.col(c).cast("decimal(18,2)").cast("string")


def pick(by: Column, *cases: Column) -> Column:
    """One of several renderings, chosen by the remainder of a key."""
    out = cases[0]
    for i, case in enumerate(cases[1:], 1):
        out = F.when(by % len(cases) == i, case).otherwise(out)
    return out


@query(
    "md5_customer_key",
    """
    SELECT c_custkey,
           md5(c_name || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END) AS id_cliente,
           md5(CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END) AS id_afiliado
    FROM customer
    """,
)
def md5_customer_key(spark, sf):
    segment = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        keys.md5_key(F.col("c_name"), segment).alias("id_cliente"),
        keys.md5_key(segment).alias("id_afiliado"),
    )


@query(
    "pipe_key",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE WHEN l_linenumber = 3 THEN NULL
                ELSE CAST(l_partkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) END AS k
    FROM lineitem
    """,
)
def pipe_key(spark, sf):
    line = F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", keys.pipe_key(F.col("l_partkey"), line).alias("k")
    )


@query(
    "lenient_cast",
    """
    WITH t AS (
      SELECT o_orderkey,
             CASE o_orderkey % 6
               WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
               WHEN 1 THEN ' ' || CAST(o_orderkey AS VARCHAR)
               WHEN 2 THEN 'NaN' WHEN 3 THEN '' WHEN 4 THEN CAST(o_orderkey AS VARCHAR)
               ELSE NULL END AS x
      FROM orders)
    SELECT o_orderkey, x AS as_text,
           CASE WHEN regexp_full_match(x, '[+-]?[0-9]+') THEN TRY_CAST(x AS BIGINT) END AS as_long,
           CASE WHEN regexp_full_match(x, '[0-9.]+') THEN TRY_CAST(x AS DOUBLE) END AS as_double,
           COALESCE(CASE WHEN regexp_full_match(x, '[+-]?[0-9]+')
                         THEN TRY_CAST(x AS BIGINT) END, 0) AS long_or_zero,
           COALESCE(CASE WHEN regexp_full_match(x, '[0-9.]+')
                         THEN TRY_CAST(x AS DOUBLE) END, 0.0) AS double_or_zero
    FROM t
    """,
)
def lenient_cast_query(spark, sf):
    key = F.col("o_orderkey")
    x = pick(
        key, money("o_totalprice"), F.concat(F.lit(" "), key.cast("string")), F.lit("NaN"),
        F.lit(""), key.cast("string"), F.lit(None).cast("string"),
    )
    texts = table(spark, sf, "orders").select(
        key, *[x.alias(n) for n in ("as_text", "as_long", "as_double", "long_or_zero", "double_or_zero")]
    )
    nulls = lenient_cast(texts, ints=["as_long"], floats=["as_double"])
    return lenient_cast(nulls, ints=["long_or_zero"], floats=["double_or_zero"], zero_nulls=True)


@query(
    "all_to_string",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
           CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag
    FROM lineitem
    """,
)
def all_to_string_query(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"]
    return all_to_string(table(spark, sf, "lineitem").select(cols))


@query(
    "decimal_comma",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 = 0 THEN 0.0
                WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey AS DOUBLE)
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS price
    FROM orders
    """,
)
def decimal_comma(spark, sf):
    comma = F.replace(money("o_totalprice"), F.lit("."), F.lit(","))
    # two separators are no number; whole numbers have none
    x = pick(
        F.col("o_orderkey"), F.concat(F.lit("1."), comma), F.col("o_orderkey").cast("string"),
        comma, money("o_totalprice"),
    )
    return table(spark, sf, "orders").select("o_orderkey", numbers.decimal_comma(x).alias("price"))


@query(
    "scrub_numbers",
    """
    SELECT o_orderkey, o_orderkey AS n, 0::BIGINT AS from_priority,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           o_orderkey * 10 AS with_point
    FROM orders
    """,
)
def scrub_numbers(spark, sf):
    key = F.col("o_orderkey")
    grouped = F.concat(
        F.lit("~ "), F.floor(key / 1000).cast("string"), F.lit("."),
        F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(" un"),
    )
    comma = F.replace(money("o_totalprice"), F.lit("."), F.lit(","))
    return table(spark, sf, "orders").select(
        key,
        numbers.scrub_int(grouped).alias("n"),
        numbers.scrub_int(F.col("o_orderpriority")).alias("from_priority"),
        numbers.scrub_float(F.concat(F.lit("R$ "), comma)).alias("amount"),
        numbers.scrub_int(F.concat(key.cast("string"), F.lit(".0"))).alias("with_point"),
    )


@query(
    "brl_to_decimal",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 9 = 0 THEN NULL
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS valor
    FROM orders
    """,
)
def brl_to_decimal(spark, sf):
    shown = F.translate(F.format_number(F.col("o_totalprice"), 2), ",.", ".,")
    spaced = F.concat(F.lit("R$ "), shown)
    plain = F.concat(F.lit("R$ "), shown)
    x = F.when(F.col("o_orderkey") % 9 != 0, pick(F.col("o_orderkey"), spaced, plain))
    return table(spark, sf, "orders").select("o_orderkey", numbers.brl_to_decimal(x).alias("valor"))


@query(
    "blank_to_zero",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
           CASE WHEN c_custkey % 6 < 5 THEN '0' ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 6 < 5 THEN '' ELSE c_mktsegment END AS filled
    FROM customer
    """,
)
def blank_to_zero_query(spark, sf):
    seg = F.col("c_mktsegment")
    x = pick(
        F.col("c_custkey"), F.lit("  "), F.lit(" None "), F.lit("NAN"),
        F.lit(None).cast("string"), F.lit(" "), F.concat(F.lit(" "), seg, F.lit("\t")),
    )
    kept = F.when(F.col("c_custkey") % 6 == 5, seg)
    df = table(spark, sf, "customer").select("c_custkey", x.alias("segment"), kept.alias("filled"))
    return blank_to_zero(fill_text(df).withColumn("c_custkey", F.col("c_custkey").cast("string")),
                         ["segment"])


@query(
    "parse_dates",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso_date, CAST(o_orderdate AS DATE) AS br_date,
           o_orderdate + to_seconds(o_orderkey % 86400) AS moment,
           CAST(NULL AS DATE) AS impossible, CAST(o_orderdate AS DATE) AS day
    FROM orders
    """,
)
def parse_dates(spark, sf):
    d = F.col("o_orderdate")
    at = d + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    stamp = F.replace(at.cast("string"), F.lit(" "), F.lit("T"))
    full = F.when(F.length(stamp) == 10, F.concat(stamp, F.lit("T00:00:00"))).otherwise(stamp)
    parts = [F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")]
    moment = dates.parse_iso_ts(F.concat(full, F.lit(".123+00:00")))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.parse_date(F.concat(F.lit(" "), F.concat_ws("-", *parts))).alias("iso_date"),
        dates.parse_date(F.concat_ws("/", *parts[::-1]), dates.BR_DATE).alias("br_date"),
        moment.alias("moment"),
        dates.parse_date(F.concat(F.lit("31/02/"), parts[0]), dates.BR_DATE).alias("impossible"),
        F.to_date(moment).alias("day"),
    )


@query(
    "pt_month",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE strftime(o_orderdate, '01/%m/%Y') END AS data
    FROM orders
    """,
)
def pt_month(spark, sf):
    names = F.array(*[F.lit(m) for m in dates.PT_MONTHS])
    name = F.get(names, F.month("o_orderdate") - 1)
    shown = F.when(F.col("o_orderkey") % 3 == 1, F.upper(name)).otherwise(name)
    month = F.when(F.col("o_orderkey") % 10 == 0, F.lit("xyz")).otherwise(shown)
    x = F.concat(F.lit(" "), month, F.lit("/"), F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.pt_month_to_date_text(x).alias("data")
    )


@query(
    "epoch_and_offset",
    """
    SELECT event_id, epoch_ms(date_trunc('milliseconds', ts)) AS ms, date_trunc('milliseconds', ts) AS utc,
           date_trunc('milliseconds', ts) - INTERVAL 3 HOUR AS local_time,
           strftime(ts - INTERVAL 3 HOUR, '%d/%m/%Y %H:%M:%S') AS local_text
    FROM events
    """,
)
def epoch_and_offset(spark, sf):
    ms = dates.ts_to_epoch_ms(F.col("ts"))
    utc = dates.epoch_ms_to_ts(F.col("ms"))
    local = dates.fixed_offset(utc)
    return (
        table(spark, sf, "events")
        .select("event_id", ms.alias("ms"))
        .select(
            "event_id", "ms", utc.alias("utc"), local.alias("local_time"),
            dates.br_text(local).alias("local_text"),
        )
    )


@query(
    "slugify_labels",
    """
    SELECT p_partkey,
           lower(replace(p_name, ' ', '_')) || '_rea_' || lower(p_type) || '_x' AS slug,
           CASE WHEN p_partkey % 3 = 0 THEN 'cf__field_' || CAST(p_partkey AS VARCHAR)
                ELSE 'cf__' || lower(replace(p_name, ' ', '_')) END AS field_name
    FROM part
    """,
)
def slugify_labels(spark, sf):
    label = F.concat(
        F.lit(" _"), F.col("p_name"), F.lit("  -  Área ("), F.col("p_type"), F.lit(")__X ")
    )
    title = F.when(F.col("p_partkey") % 3 != 0, F.initcap("p_name")).otherwise(F.lit("  "))
    return table(spark, sf, "part").select(
        "p_partkey",
        text.slugify(label).alias("slug"),
        text.custom_field_name(title, F.col("p_partkey")).alias("field_name"),
    )


@query(
    "normalize_url",
    """
    WITH t AS (SELECT page_id, url, CAST(page_id AS VARCHAR) AS id FROM pages)
    SELECT page_id, url AS absolute,
           'https://www.facebook.com/watch/?v=' || id AS from_path,
           'https://www.facebook.com/watch/?v=' || id AS from_id,
           'https://www.facebook.com/9/posts/' || id AS from_post,
           'https://www.facebook.com/p/' || id AS from_relative,
           'x' || id AS from_other, '' AS from_null,
           url || '/videos/' || id || '?r=1' AS video_kept,
           'https://www.facebook.com/watch/?v=' || id AS video_click,
           url AS absolute_click
    FROM t
    """,
)
def normalize_url(spark, sf):
    i = F.col("page_id").cast("string")

    def joined(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    video = joined(F.col("url"), "/videos/", i, "?r=1")
    norm = urls.normalize_video_url
    return table(spark, sf, "pages").select(
        "page_id",
        norm(F.col("url")).alias("absolute"),
        norm(joined("/some/videos/", i, "/")).alias("from_path"),
        norm(i).alias("from_id"),
        norm(joined("9_", i)).alias("from_post"),
        norm(joined("/p/", i)).alias("from_relative"),
        norm(joined("x", i)).alias("from_other"),
        norm(F.lit(None).cast("string")).alias("from_null"),
        norm(video).alias("video_kept"),
        urls.click_url(video).alias("video_click"),
        urls.click_url(F.col("url")).alias("absolute_click"),
    )


CREATIVE = (
    "effective_object_story_id string, object_story_id string, "
    "asset_feed_spec struct<videos:array<struct<video_id:string>>>, "
    "object_story_spec struct<video_data:struct<video_id:string>>"
)


@query(
    "first_media_ref",
    """
    SELECT page_id,
           CASE page_id % 5 WHEN 0 THEN 's' || page_id WHEN 1 THEN 'f' || page_id END AS video,
           CASE WHEN page_id % 5 <= 2 THEN 'e' || page_id
                WHEN page_id % 5 = 3 THEN 'o' || page_id END AS post
    FROM pages
    """,
)
def first_media_ref(spark, sf):
    i = F.col("page_id").cast("string")
    kind = F.col("page_id") % 5
    story = F.when(kind == 0, F.concat(F.lit("s"), i))
    feed = F.when(
        kind <= 1,
        F.array(
            F.struct(F.lit(None).cast("string").alias("video_id")),
            F.struct(F.concat(F.lit("f"), i).alias("video_id")),
        ),
    )
    creative = F.when(
        kind <= 3,
        F.struct(
            F.when(kind <= 2, F.concat(F.lit("e"), i)).otherwise(F.lit("")).alias("effective_object_story_id"),
            F.concat(F.lit("o"), i).alias("object_story_id"),
            F.struct(feed.alias("videos")).alias("asset_feed_spec"),
            F.struct(F.struct(story.alias("video_id")).alias("video_data")).alias("object_story_spec"),
        ),
    )
    df = table(spark, sf, "pages").select("page_id", creative.alias("creative"))
    # through JSON text, as the feed delivers it
    read = F.from_json(F.to_json("creative"), CREATIVE)
    return df.select("page_id", read.alias("creative")).select(
        "page_id",
        nested.video_ref(F.col("creative")).alias("video"),
        nested.post_ref(F.col("creative")).alias("post"),
    )


@query(
    "format_label",
    """
    SELECT c_custkey,
           CASE WHEN c_nationkey % 4 = 0 OR n_name IS NULL THEN 'unknown_list' ELSE n_name END
           || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' [' || CAST(c_custkey % 3 AS VARCHAR) || ']' END
           AS label
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def format_label(spark, sf):
    nation = table(spark, sf, "nation").select(
        "n_nationkey",
        F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).otherwise(F.lit(" ")).alias("name"),
    )
    df = lookup_label(table(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey", "name", "n")
    status = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 3)
    return df.select("c_custkey", text.format_label(F.col("n"), status).alias("label"))


@query(
    "any_positive",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_tax
    FROM lineitem WHERE l_discount > 0.05 OR l_tax > 0 OR l_quantity >= 41
    """,
)
def any_positive_query(spark, sf):
    df = table(spark, sf, "lineitem").withColumns(
        {
            "d": F.round(F.col("l_discount") - 0.05, 4).cast("string"),
            "t": F.col("l_tax").cast("string"),
        }
    )
    whole = df.withColumn("q", F.when(F.col("l_quantity") >= 41, F.lit("1.9")).otherwise(F.lit("0.9")))
    return any_positive(whole, ["d", "t"], ["q"]).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax"
    )
