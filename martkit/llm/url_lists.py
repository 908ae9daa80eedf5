"""URL filters by a temporal list join (operator 2): native Spark expressions only.

Dated list entries become validity intervals of a key: a host, a domain above
it, or a host with the start of a path. A capture is joined to the keys that its
URL has, as of the time it was fetched; the most specific active entry decides.
Equal URLs of one time are judged once, so a hot host or page costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.operators.spread import left_lookup
from martkit.workspace import written

ALLOW = "allow"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty where the URL has none."""
    authority = F.regexp_extract(F.lower(url), "^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), "(:[0-9]*)?\\.?(:[0-9]*)?$", "")


def path_of(url: Column) -> Column:
    """Path without query and fragment; empty where the URL has none."""
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column) -> Column:
    """Keys that an entry may have to match: the host, the domains above it of two labels or more, and the host
    with each start of the path in whole segments."""
    labels = F.split(host, "\\.")
    count = F.size(labels)
    above = F.transform(
        F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )
    parts = F.array_remove(F.split(path, "/"), "")
    paths = F.transform(parts, lambda x, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(above, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """``key``, ``list``, ``since``, ``until``: when each key is on each list, until being open or the day of removal.

    Entries have ``key``, ``list``, ``action`` (add or remove) and ``day``; on one
    day a removal wins. Repeated additions don't shorten an interval. Entries
    with a null in any of these are left out, and so are other actions.
    """
    dated = entries.where("key is not null and list is not null and day is not null and action in ('add', 'remove')")
    last = dated.groupBy("key", "list", "day").agg(F.max("action").alias("action"))
    order = W.partitionBy("key", "list").orderBy("day")
    changes = last.withColumn("before", F.lag("action").over(order)).where(
        F.coalesce(F.col("before"), F.lit("remove")) != F.col("action")
    )
    spans = changes.withColumn("until", F.lead("day").over(order)).where("action = 'add'")
    return spans.select("key", "list", F.col("day").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Distinct URL and time of the captures with ``host``, ``entry``, ``list`` and ``blocked``.

    The longest key decides; of equal ones the list ``allow``, then the first by
    name. ``entry`` and ``list`` are null where no entry is active. A URL without
    a host and a null time match none.
    """
    url, time = F.col(url_col).alias("url"), F.col(time_col).alias("fetched")
    seen = captures.select(url, time).distinct().withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    keyed = seen.withColumn("key", F.explode_outer(keys_of(F.col("host"), F.coalesce(path_of(F.col("url")), F.lit("")))))
    span = F.struct("list", "since", "until")
    listing = intervals(entries).groupBy("key").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    found = left_lookup(keyed, listing, ["key"])
    active = F.filter("spans", lambda s: (s["since"] <= F.col("fetched")) & (
        s["until"].isNull() | (F.col("fetched") < s["until"])))
    first = F.array_min(F.transform(active, lambda s: F.struct(
        (-F.length("key")).alias("size"), (s["list"] != ALLOW).alias("block"), s["list"].alias("list"), F.col("key"))))
    best = found.groupBy("url", "fetched", "host").agg(F.min(first).alias("best"))
    return best.select("url", "fetched", "host", F.col("best.key").alias("entry"), F.col("best.list").alias("list"),
                       F.coalesce(F.col("best.block"), F.lit(False)).alias("blocked"))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Each capture's id, URL, time and verdict, one row for each row; other columns are not read.

    Repeated captures are judged alike, a null URL is not blocked.
    """
    verdicts = written(judge(captures, entries, url_col, time_col))
    own = captures.select(F.col(id_col), F.col(url_col).alias("url"), F.col(time_col).alias("fetched"))
    return left_lookup(own, verdicts, ["url", "fetched"], nulls_match=True)


def hashed(col: Column, modulus: int) -> Column:
    """A number below the modulus from the md5 of a text."""
    return F.conv(F.substring(F.md5(col.cast("binary")), 1, 8), 16, 10).cast("long") % modulus


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the day of each is derived from its id, as the table has none."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), hashed(F.col("page_id").cast("string"), 365).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries derived from the pages' own hosts and first path segments.

    A third of the keys are added on a day, most removed later and some added
    again; a few are on the list ``allow``.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    segment = F.array_remove(F.split(path, "/"), "")
    keys = pages.where("url is not null").select(F.explode(F.array(
        host, F.concat(host, F.lit("/"), F.coalesce(F.try_element_at(segment, F.lit(1)), F.lit("")))
    )).alias("key")).where("key != '' and key not like '%/'").distinct()
    listed = keys.where(hashed(F.concat(F.lit("listed:"), "key"), 3) == 0)
    names = F.array(*[F.lit(x) for x in ("adult", "malware", "spam", ALLOW)])
    named = listed.withColumn("list", F.element_at(names, (hashed(F.concat(F.lit("list:"), "key"), 4) + 1).cast("int")))
    start = hashed(F.concat(F.lit("day:"), "key"), 200)
    events = F.array(
        F.struct(F.lit("add").alias("action"), start.alias("n")),
        F.struct(F.lit("remove").alias("action"), (start + 40 + hashed(F.concat(F.lit("end:"), "key"), 120)).alias("n")),
        F.struct(F.lit("add").alias("action"), (start + 200).alias("n")),
    )
    turns = named.withColumn("e", F.explode(F.slice(events, 1, (hashed(F.concat(F.lit("turns:"), "key"), 3) + 1).cast("int"))))
    return turns.select("key", "list", F.col("e.action").alias("action"),
                        F.date_add(F.lit("2024-01-01").cast("date"), F.col("e.n").cast("int")).alias("day"))


def page_verdicts(pages: DataFrame) -> DataFrame:
    """Every page's verdict as of its day."""
    return filter_captures(dated_captures(pages), written(dated_entries(pages)), "page_id")


_MD5 = "('0x' || substr(md5({0}), 1, 8))::BIGINT"

PAGE_VERDICTS_SQL = f"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + ({_MD5.format("page_id::VARCHAR")} % 365)::INT AS fetched,
    regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''),
      '(:[0-9]*)?\\.?(:[0-9]*)?$', '') AS host,
    [x for x in string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') if x != ''] AS seg
  FROM pages),
keys AS (
  SELECT DISTINCT key FROM (SELECT host AS key FROM cap UNION ALL SELECT host || '/' || seg[1] FROM cap WHERE len(seg) > 0)
  WHERE key != ''),
listed AS (
  SELECT key, ['adult', 'malware', 'spam', 'allow'][{_MD5.format("'list:' || key")} % 4 + 1] AS list,
    {_MD5.format("'day:' || key")} % 200 AS d, {_MD5.format("'end:' || key")} % 120 AS e,
    {_MD5.format("'turns:' || key")} % 3 + 1 AS turns
  FROM keys WHERE {_MD5.format("'listed:' || key")} % 3 = 0),
turn AS (
  SELECT key, list, 'add' AS action, d AS n FROM listed
  UNION ALL SELECT key, list, 'remove', d + 40 + e FROM listed WHERE turns > 1
  UNION ALL SELECT key, list, 'add', d + 200 FROM listed WHERE turns > 2),
span AS (
  SELECT key, list, action, DATE '2024-01-01' + n::INT AS since,
    lead(DATE '2024-01-01' + n::INT) OVER (PARTITION BY key, list ORDER BY n) AS until FROM turn),
capkey AS (
  SELECT page_id, unnest(list_concat([array_to_string(string_split(host, '.')[i:], '.')
      for i in range(1, greatest(len(string_split(host, '.')), 2))],
    [host || '/' || array_to_string(seg[1:i], '/') for i in range(1, len(seg) + 1)])) AS key, fetched
  FROM cap WHERE host != ''),
hit AS (
  SELECT page_id, arg_min({{'k': c.key, 'l': s.list}}, (-length(c.key), s.list != 'allow', s.list, c.key)) AS best
  FROM (SELECT DISTINCT * FROM capkey) c JOIN span s
    ON c.key = s.key AND s.action = 'add' AND s.since <= c.fetched AND (s.until IS NULL OR c.fetched < s.until)
  GROUP BY page_id)
SELECT page_id, url, fetched, host, best.k AS entry, best.l AS list, coalesce(best.l != 'allow', false) AS blocked
FROM cap LEFT JOIN hit USING (page_id)
"""
