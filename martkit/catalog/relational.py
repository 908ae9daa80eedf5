"""Filters, dedup, joins, aggregates, stacking, ids and history."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martkit.catalog.registry import query, table
from martkit.functions.dates import open_end
from martkit.functions.keys import fallback_key
from martkit.functions.text import format_label
from martkit.operators import aggregate, combine, dedup, filters, history, ids, incremental, joins
from martkit.operators import project, spread, star
from martkit.workspace import written


def active_customers(spark, sf):
    return table(spark, sf, "customer").where("c_acctbal > 5000").select(
        F.col("c_custkey").alias("deal_id")
    )


@query(
    "latest_movement_flag",
    """
    SELECT event_id, user_id AS deal_id, CAST(ts AS DATE) AS date,
           CAST(ts = max(ts) OVER (PARTITION BY user_id) AS BIGINT) AS flg_ultimo_movimento,
           CAST(user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AS BIGINT)
             AS flag_deal_ativo
    FROM events
    """,
)
def latest_movement_flag(spark, sf):
    moves = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("deal_id"), F.col("ts").alias("timestamp")
    )
    flagged = history.flag_latest(moves, "deal_id", "timestamp", "flg_ultimo_movimento")
    out = joins.member_flag(
        flagged, active_customers(spark, sf), "deal_id", "flag_deal_ativo", counts_from=moves
    )
    return out.withColumn("date", F.to_date("timestamp")).drop("timestamp")


@query(
    "latest_flag_ties_nulls",
    """
    WITH t AS (
      SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey % 10 END AS k,
             CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS ts
      FROM orders)
    SELECT o_orderkey, k, CAST(ts = max(ts) OVER (PARTITION BY k) AS BIGINT) AS flg
    FROM t
    """,
)
def latest_flag_ties_nulls(spark, sf):
    k = F.col("o_custkey") % 10
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k != 0, k).alias("k"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate")).alias("ts"),
    )
    return history.flag_latest(df, "k", "ts", "flg").drop("ts")


@query("dim_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def dim_distinct(spark, sf):
    return star.build_dim(table(spark, sf, "part"), ["p_brand", "p_type"])


@query(
    "dim_by_key",
    """
    SELECT p_brand, p_name, p_partkey FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1
    """,
)
def dim_by_key(spark, sf):
    return star.build_dim_by_key(
        table(spark, sf, "part"), ["p_brand", "p_name", "p_partkey"], ["p_brand"], [F.col("p_partkey")]
    )


@query(
    "dim_by_key_any",
    """
    SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_returnflag, l_linestatus) = 1
    """,
)
def dim_by_key_any(spark, sf):
    return star.build_dim_by_key(
        table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"], ["l_suppkey"]
    )


@query(
    "dedup_first_nonempty",
    """
    SELECT doc_id, lang, source, n_chars FROM documents WHERE text <> ''
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """,
)
def dedup_first_nonempty(spark, sf):
    # the whole text is digested at the scan, so texts are neither shuffled nor sorted
    docs = filters.require_text(table(spark, sf, "documents"), "text")
    keyed = docs.withColumn("digest", F.sha2("text", 256)).drop("text")
    return dedup.dedup_by_key(keyed, ["digest"], [F.col("doc_id")]).drop("digest")


@query(
    "last_wins",
    """
    WITH t AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)
    SELECT o_orderkey, k, o_totalprice FROM t WHERE k IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    UNION ALL SELECT o_orderkey, k, o_totalprice FROM t WHERE k IS NULL
    """,
)
def last_wins(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("k"),
    )
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return dedup.last_wins(df, "k", order).drop("o_orderdate")


@query(
    "last_wins_fallback_key",
    """
    WITH h AS (SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM pages),
    t AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'id:' || page_id || '|role:' || (page_id % 3)
                 WHEN page_id % 5 <> 0 THEN 'email:' || lower(host) || '|role:' || (page_id % 3) END AS k
          FROM h)
    SELECT page_id, k FROM t WHERE k IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY page_id DESC) = 1
    UNION ALL SELECT page_id, k FROM t WHERE k IS NULL
    """,
)
def last_wins_fallback_key(spark, sf):
    host = F.upper(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1))
    key = fallback_key(
        F.col("page_id") % 3,
        id=F.when(F.col("page_id") % 2 == 0, F.col("page_id")),
        email=F.lower(F.when(F.col("page_id") % 5 != 0, host)),
    )
    df = table(spark, sf, "pages").select("page_id", key.alias("k"))
    return dedup.last_wins(df, "k", [F.col("page_id").desc()])


FACT = ["l_shipdate", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]


@query(
    "fact_contract",
    "SELECT l_shipdate, l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem",
)
def fact_contract(spark, sf):
    # the orders feed lacks contract columns and is left out as a whole
    feeds = [table(spark, sf, "lineitem"), table(spark, sf, "orders")]
    return star.build_fact(combine.stack_contract(feeds, FACT), FACT)


@query(
    "latest_load_per_key",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus <> 'F' THEN '20250102_000000' ELSE '20250101_000000' END AS load_ts
    FROM orders
    """,
)
def latest_load_per_key(spark, sf):
    first = table(spark, sf, "orders").withColumn("load_ts", F.lit("20250101_000000"))
    again = (
        table(spark, sf, "orders")
        .where("o_orderstatus <> 'F'")
        .withColumns({"o_totalprice": F.col("o_totalprice") + 1, "load_ts": F.lit("20250102_000000")})
    )
    return star.build_fact(
        combine.stack_strict(first, again), ["o_orderkey", "o_totalprice", "load_ts"],
        natural_key=["o_orderkey"], load_col="load_ts",
    )


@query(
    "dense_ids_sorted",
    """
    WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN ''
                                      ELSE c_mktsegment END AS segment FROM customer),
    m AS (SELECT segment, row_number() OVER (ORDER BY segment) AS id
          FROM (SELECT DISTINCT segment FROM t WHERE segment <> ''))
    SELECT c_custkey, t.segment, COALESCE(id, 0) AS id_publico
    FROM t LEFT JOIN m ON t.segment = m.segment
    """,
)
def dense_ids_sorted(spark, sf):
    key, seg = F.col("c_custkey"), F.col("c_mktsegment")
    raw = F.when(key % 18 == 0, F.lit(None)).when(key % 9 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), seg)
    )
    df = table(spark, sf, "customer").select(key, raw.alias("segment"))
    return ids.add_dim_ids(ids.strip_label(df, "segment"), "segment", "id_publico")


@query(
    "dense_ids_many",
    """
    SELECT c_name, row_number() OVER (ORDER BY c_name) AS id
    FROM (SELECT DISTINCT c_name FROM customer)
    """,
)
def dense_ids_many(spark, sf):
    out = ids.dense_ids(table(spark, sf, "customer"), "c_name", "id")
    return out.withColumn("id", F.col("id").cast("bigint"))


@query(
    "dense_ids_text",
    """
    WITH t AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS rede
               FROM events)
    SELECT event_id, rede, CAST(dense_rank() OVER (ORDER BY rede NULLS LAST) AS VARCHAR) AS id_rede
    FROM t
    """,
)
def dense_ids_text(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("rede")
    )
    return ids.add_dim_ids(df, "rede", "id_rede", missing=None, include_null=True, as_text=True)


@query(
    "rename_align",
    """
    SELECT l_partkey AS campaign_id, l_returnflag AS campaign_name, CAST(l_linenumber AS BIGINT) AS clicks,
           0.0::DOUBLE AS spend, '' AS utm_source, CAST(NULL AS DATE) AS data, 'lineitem' AS origem,
           COALESCE(CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END, '-') AS status
    FROM lineitem
    """,
)
def rename_align(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("name"),
        F.col("l_linenumber").cast("string").alias("clicks"),
        F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).alias("status"),
        F.col("l_tax").alias("tmp_tax"), F.col("l_discount").alias("x_dim_new"),
        F.col("l_suppkey").alias("owner_id"),
    )
    df = project.rename_aliases(df, {"id": "campaign_id", "name": "campaign_name", "gone": "x"})
    df = project.drop_present(df, ["owner_id", "absent"], prefixes=("tmp_",), suffixes=("_dim_new",))
    df = project.fill_absent(df, {"status": "-"})
    schema = T.StructType.fromDDL(
        "campaign_id bigint, campaign_name string, clicks bigint, spend double, "
        "utm_source string, data date, status string"
    )
    df = project.align_to_contract(df, schema, {"spend": 0.0, "utm_source": ""})
    return project.add_constants(df, {"origem": "lineitem"})


@query(
    "select_present",
    "SELECT n_name AS nome, n_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def select_present(spark, sf):
    nation = project.select_present(table(spark, sf, "nation"), ["n_name", "absent", "n_regionkey"])
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    kept = joins.keep_members(nation, regions, "n_regionkey")
    return project.select_renamed(kept, {"n_name": "nome", "n_regionkey": "n_regionkey"})


@query(
    "require_and_exclude",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderkey % 13 <> 0 AND o_custkey NOT IN (1, 2, 3) AND o_custkey % 17 <> 0
    """,
)
def require_and_exclude(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return filters.exclude_ids(filters.require_not_null(df, ["o_orderstatus"]), "o_custkey", [1, 2, 3])


@query(
    "split_valid_counts",
    """
    SELECT event_type, CASE WHEN user_id % 4 = 0 OR event_id % 7 = 0 THEN 'rejected' ELSE 'valid' END AS side,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def split_valid_counts(spark, sf):
    df = table(spark, sf, "events").select(
        "event_type",
        F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )
    valid, rejected = filters.split_valid(df, ["user_id", "value"])
    both = valid.withColumn("side", F.lit("valid")).unionByName(
        rejected.withColumn("side", F.lit("rejected"))
    )
    return both.groupBy("event_type", "side").agg(F.count(F.lit(1)).alias("n"))


@query(
    "member_flag",
    """
    SELECT c_custkey, CAST(c_custkey IN (SELECT user_id FROM events) AS BIGINT) AS active,
           CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN '1' ELSE '0' END AS active_text
    FROM customer
    """,
)
def member_flag(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    df = table(spark, sf, "customer").select("c_custkey")
    df = joins.member_flag(df, users, "c_custkey", "active")
    return joins.member_flag(df, users, "c_custkey", "active_text", as_text=True)


@query(
    "new_rows_anti",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey % 19 <> 0 AND c_custkey NOT IN (SELECT user_id FROM events)
    """,
)
def new_rows_anti(spark, sf):
    persons = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 19 != 0, F.col("c_custkey")).alias("c_custkey"), "c_name"
    )
    control = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return joins.new_rows(persons, control, "c_custkey")


@query(
    "append_control",
    "SELECT user_id AS id FROM events UNION SELECT c_custkey FROM customer WHERE c_custkey % 19 <> 0",
)
def append_control(spark, sf):
    control = table(spark, sf, "events").select(F.col("user_id").alias("id"))
    fresh = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 19 != 0, F.col("c_custkey")).alias("id")
    )
    return joins.append_control(control, fresh, "id")


@query(
    "lookup_default",
    """
    SELECT o_orderkey, COALESCE(c_mktsegment, 'none') AS segment, COALESCE(c_nationkey, -1) AS nation
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
)
def lookup_default(spark, sf):
    dim = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup_default(orders, dim, ["o_custkey"], {"segment": "none", "nation": -1}).drop(
        "o_custkey"
    )


@query(
    "left_composite",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, n FROM lineitem
    LEFT JOIN (SELECT p_partkey % 100 AS a, p_size AS b, count(*) AS n FROM part GROUP BY ALL)
      ON l_partkey % 100 = a AND CAST(l_quantity AS INTEGER) = b
    """,
)
def left_composite(spark, sf):
    dim = table(spark, sf, "part").groupBy(
        (F.col("p_partkey") % 100).alias("a"), F.col("p_size").alias("b")
    ).agg(F.count(F.lit(1)).alias("n"))
    fact = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        (F.col("l_partkey") % 100).alias("a"), F.col("l_quantity").cast("int").alias("b"),
    )
    return joins.left_on(fact, dim, ["a", "b"]).drop("a", "b")


@query(
    "consolidate_contact",
    """
    WITH p AS (
      SELECT user_id,
             min_by(value, event_id) FILTER (event_type = 'click') AS click,
             min_by(value, event_id) FILTER (event_type = 'purchase') AS purchase
      FROM events GROUP BY user_id),
    s AS (SELECT o_custkey, string_agg(DISTINCT trim(o_orderpriority), ', ' ORDER BY trim(o_orderpriority)) AS priorities
          FROM orders GROUP BY o_custkey),
    l AS (SELECT o_custkey, string_agg(DISTINCT lbl, ', ' ORDER BY lbl) AS labels
          FROM (SELECT o_custkey, n_name || ' [' || o_orderstatus || ']' AS lbl
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
          GROUP BY o_custkey)
    SELECT c_custkey AS id, c_name, click, purchase, priorities, labels
    FROM customer LEFT JOIN p ON c_custkey = user_id LEFT JOIN s ON c_custkey = s.o_custkey
    LEFT JOIN l ON c_custkey = l.o_custkey
    """,
)
def consolidate_contact(spark, sf):
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "id")
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "id")
    events = table(spark, sf, "events").withColumnRenamed("user_id", "id")
    pivoted = aggregate.pivot_attributes(
        events, ["id"], "event_type", "value", ["click", "purchase"], F.col("event_id")
    )
    priorities = aggregate.set_text(orders, ["id"], F.col("o_orderpriority"), "priorities")
    with_nation = orders.join(customers.select("id", "c_nationkey"), "id")
    named = joins.lookup_label(
        with_nation, table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name", "nation"
    )
    labels = aggregate.set_text(
        named, ["id"], format_label(F.col("nation"), F.col("o_orderstatus")), "labels"
    )
    return joins.consolidate(customers.select("id", "c_name"), [pivoted, priorities, labels], ["id"])


@query(
    "pivot_attributes",
    """
    SELECT user_id,
           min_by(value, event_id) FILTER (event_type = 'click' AND event_id % 4 <> 0) AS click,
           min_by(value, event_id) FILTER (event_type = 'error' AND event_id % 4 <> 0) AS error,
           min_by(value, event_id) FILTER (event_type = 'purchase' AND event_id % 4 <> 0) AS purchase,
           CAST(NULL AS DOUBLE) AS never
    FROM events GROUP BY user_id
    """,
)
def pivot_attributes(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
    )
    labels = ["click", "error", "purchase", "never"]
    return aggregate.pivot_attributes(
        df, ["user_id"], "event_type", "value", labels, F.col("event_id")
    )


@query(
    "set_text",
    """
    SELECT o_custkey, string_agg(DISTINCT p, ', ' ORDER BY p) AS priorities
    FROM (SELECT o_custkey, trim(o_orderpriority) AS p FROM orders) GROUP BY o_custkey
    """,
)
def set_text(spark, sf):
    padded = F.concat(F.lit(" "), F.col("o_orderpriority"))
    return aggregate.set_text(table(spark, sf, "orders"), ["o_custkey"], padded, "priorities")


@query(
    "first_nonnull_per_group",
    """
    SELECT user_id, min_by(event_type, event_id) AS first_type,
           arg_min_null(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END, event_id) AS first_value,
           min_by(value, event_id) FILTER (event_id % 3 <> 0) AS first_known
    FROM events GROUP BY user_id
    """,
)
def first_nonnull_per_group(spark, sf):
    known = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    df = table(spark, sf, "events").select(
        "user_id", "event_id", F.col("event_type").alias("first_type"),
        known.alias("first_value"), known.alias("first_known"),
    )
    return aggregate.first_per_group(
        df, ["user_id"], F.col("event_id"),
        {"first_type": False, "first_value": False, "first_known": True},
    )


@query(
    "profile",
    """
    SELECT count(*) AS n_rows, count(*) - count(k) AS k_nulls, 0::BIGINT AS o_orderdate_nulls,
           count(DISTINCT k) AS k_distinct, count(DISTINCT o_orderpriority) AS o_orderpriority_distinct
    FROM (SELECT *, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)
    """,
)
def profile(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "k", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    )
    return aggregate.profile(df, ["k", "o_orderdate"], ["k", "o_orderpriority"])


@query("max_value", "SELECT CAST(max(o_orderdate) AS DATE) AS max_date FROM orders")
def max_value(spark, sf):
    out = aggregate.max_value(table(spark, sf, "orders"), "o_orderdate", "max_date")
    return out.select(F.to_date("max_date").alias("max_date"))


@query(
    "union_diagonal",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS suppkey
    FROM customer UNION ALL
    SELECT NULL, s_name, NULL, s_suppkey FROM supplier
    """,
)
def union_diagonal(spark, sf):
    a = project.select_renamed(
        table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    )
    b = project.select_renamed(table(spark, sf, "supplier"), {"s_suppkey": "suppkey", "s_name": "name"})
    return combine.stack_diagonal(a, b)


@query(
    "union_relaxed",
    """
    SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation UNION ALL
    SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
    """,
)
def union_relaxed(spark, sf):
    sides = [("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_name"),
             ("supplier", "s_suppkey", "s_name")]
    frames = [
        project.select_renamed(table(spark, sf, t), {k: "id", n: "name"}) for t, k, n in sides
    ]
    return combine.stack_relaxed(*frames)


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(spark, sf):
    return combine.stack_distinct(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation")),
    )


@query(
    "order_mixed",
    """
    SELECT user_id, ts, event_id FROM events
    ORDER BY user_id, ts DESC, event_id LIMIT 100
    """,
)
def order_mixed(spark, sf):
    df = table(spark, sf, "events").select("user_id", "ts", "event_id")
    order = [("user_id", "asc"), ("ts", "desc"), ("event_id", "asc")]
    return project.order_rows(df, order, whole=True).limit(100)


# --- incremental load -------------------------------------------------------


@query(
    "high_watermark",
    "SELECT CAST(max(o_orderdate) AS DATE) AS watermark FROM orders WHERE o_orderkey % 2 = 0",
)
def high_watermark(spark, sf):
    day = F.to_date("o_orderdate").cast("string")
    name = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(F.lit("orders_"), day, F.lit(".json"))
    ).otherwise(F.concat(F.lit("orders-"), F.replace(day, F.lit("-"), F.lit("")), F.lit(".json")))
    names = table(spark, sf, "orders").select(name.alias("name"))
    return incremental.high_watermark(names, "name")


@query(
    "missing_days",
    """
    WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders),
    d AS (SELECT CAST(unnest(generate_series(a + 1, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT day FROM d WHERE day NOT IN
      (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '5-LOW')
    """,
)
def missing_days(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    bounds = orders.agg(F.min("day").alias("watermark"), F.max("day").alias("upto"))
    spine = incremental.missing_days(bounds, F.col("upto"))
    loaded = orders.where("o_orderpriority = '5-LOW'")
    return joins.new_rows(spine, loaded, "day")


@query(
    "load_windows",
    """
    WITH b AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders),
    w AS (SELECT unnest(generate_series(a, z, INTERVAL 30 DAY)) AS s, z FROM b)
    SELECT row_number() OVER (ORDER BY s) AS window_no, s AS window_start,
           least(s + INTERVAL 30 DAY, z) AS window_end, epoch_ms(s) AS start_ms,
           epoch_ms(least(s + INTERVAL 30 DAY, z)) AS end_ms
    FROM w WHERE s < z
    """,
)
def load_windows(spark, sf):
    bounds = table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z")
    )
    return incremental.load_windows(bounds, "a", "z")


@query(
    "upsert_control",
    """
    WITH u AS (SELECT lower(event_type) AS k, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1),
    c AS (SELECT ' ' || upper(event_type) || ' ' AS feed, lower(event_type) AS k, min(CAST(ts AS DATE)) AS d
          FROM events WHERE event_type <> 'error' GROUP BY ALL
          UNION ALL SELECT r_name, lower(r_name), DATE '2020-01-01' FROM region)
    SELECT coalesce(c.feed, u.k) AS feed, coalesce(u.d, c.d) AS max_date FROM c FULL JOIN u ON c.k = u.k
    """,
)
def upsert_control(spark, sf):
    events = table(spark, sf, "events").withColumn("max_date", F.to_date("ts"))
    updates = events.select(F.col("event_type").alias("feed"), "max_date")
    known = (
        events.where("event_type <> 'error'")
        .groupBy(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("feed"))
        .agg(F.min("max_date").alias("max_date"))
    )
    other = table(spark, sf, "region").select(
        F.col("r_name").alias("feed"), F.lit("2020-01-01").cast("date").alias("max_date")
    )
    return incremental.upsert_control(known.unionByName(other), updates, "feed", "max_date")


# --- history ----------------------------------------------------------------

DAILY = """
    snaps AS (SELECT CAST(ts AS DATE) AS d, event_type, user_id,
                     CAST(floor(max(value) / 5) AS BIGINT) AS bucket
              FROM events GROUP BY ALL)
"""


def daily_snapshots(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("d"), "event_type", "user_id")
        .agg(F.floor(F.max("value") / 5).cast("bigint").alias("bucket"))
    )


@query(
    "scd2_from_snapshots",
    f"""
    WITH {DAILY},
    times AS (SELECT d, row_number() OVER (ORDER BY d) AS i, lead(d) OVER (ORDER BY d) AS nxt
              FROM (SELECT DISTINCT d FROM snaps)),
    x AS (SELECT s.*, i, nxt, lag(i) OVER w AS pi, lag(bucket) OVER w AS pb
          FROM snaps s JOIN times USING (d)
          WINDOW w AS (PARTITION BY event_type, user_id ORDER BY i)),
    v AS (SELECT *, sum(CASE WHEN pi = i - 1 AND pb IS NOT DISTINCT FROM bucket THEN 0 ELSE 1 END)
                    OVER (PARTITION BY event_type, user_id ORDER BY i) AS ver FROM x)
    SELECT event_type, user_id, bucket, CAST(min(d) AS TIMESTAMP) AS dt_inicio_vigencia,
           coalesce(CAST(arg_max_null(nxt, i) AS TIMESTAMP), TIMESTAMP '9999-12-31 23:59:59') AS dt_fim_vigencia
    FROM v GROUP BY event_type, user_id, bucket, ver
    """,
)
def scd2_from_snapshots(spark, sf):
    snaps = daily_snapshots(spark, sf).withColumn("d", F.col("d").cast("timestamp_ntz"))
    return history.scd2_from_snapshots(snaps, ["event_type", "user_id"], ["bucket"], "d")


@query(
    "snapshot_diff",
    f"""
    WITH {DAILY},
    o AS (SELECT * FROM snaps WHERE d = (SELECT min(d) FROM snaps)),
    n AS (SELECT * FROM snaps WHERE d = (SELECT max(d) FROM snaps))
    SELECT coalesce(o.event_type, n.event_type) AS event_type, coalesce(o.user_id, n.user_id) AS user_id,
           o.bucket AS bucket_old, n.bucket AS bucket_new,
           CASE WHEN o.d IS NULL THEN 'added' WHEN n.d IS NULL THEN 'removed'
                WHEN o.bucket IS DISTINCT FROM n.bucket THEN 'changed' ELSE 'same' END AS status
    FROM o FULL JOIN n ON o.event_type = n.event_type AND o.user_id = n.user_id
    """,
)
def snapshot_diff(spark, sf):
    snaps = daily_snapshots(spark, sf)
    old = snaps.where(F.col("d") == snaps.agg(F.min("d")).scalar())
    new = snaps.where(F.col("d") == snaps.agg(F.max("d")).scalar())
    return history.snapshot_diff(old, new, ["event_type", "user_id"], ["bucket"])


@query(
    "remap_to_current",
    """
    WITH cur AS (SELECT p_brand, p_type, max(p_partkey) AS id FROM part GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey AS part_before, coalesce(cur.id, l_partkey) AS l_partkey,
           l_suppkey
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN cur ON part.p_brand = cur.p_brand AND part.p_type = cur.p_type
    """,
)
def remap_to_current(spark, sf):
    part = table(spark, sf, "part")
    newest = part.groupBy("p_brand", "p_type").agg(F.max("p_partkey").alias("now"))
    closed = F.lit("2000-01-01").cast("timestamp_ntz")
    past = part.join(newest, ["p_brand", "p_type"]).select(
        F.col("p_partkey").alias("id"), "p_brand", "p_type",
        F.when(F.col("p_partkey") == F.col("now"), open_end()).otherwise(closed).alias("dt_fim_vigencia"),
    )
    fact = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_before"), "l_partkey", "l_suppkey"
    )
    return history.remap_to_current(fact, past, ["l_partkey"], "id", ["p_brand", "p_type"])


@query(
    "current_rows",
    """
    SELECT p_brand, p_type, max(p_partkey) AS id FROM part GROUP BY ALL
    """,
)
def current_rows(spark, sf):
    part = table(spark, sf, "part")
    newest = part.groupBy("p_brand", "p_type").agg(F.max("p_partkey").alias("now"))
    versions = part.join(newest, ["p_brand", "p_type"]).withColumn(
        "dt_fim_vigencia",
        F.when(F.col("p_partkey") == F.col("now"), open_end()).otherwise(
            F.lit("2000-01-01").cast("timestamp_ntz")
        ),
    )
    return filters.current_rows(versions).select("p_brand", "p_type", F.col("p_partkey").alias("id"))


# --- queries that an operator that does nothing would fail ---------------------


@query(
    "keep_members",
    "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)",
)
def keep_members(spark, sf):
    rich = table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return joins.keep_members(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), rich, "c_nationkey")


@query(
    "observed_counts",
    """
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (user_id % 5 = 0) AS BIGINT) AS user_id_nulls,
           CAST(0 AS BIGINT) AS event_type_nulls FROM events
    """,
)
def observed_counts(spark, sf):
    """What a write counted on its way."""
    events = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"), "event_type"
    )
    df, seen = aggregate.observed(events, "events", ["user_id", "event_type"])
    written(df)
    return spark.createDataFrame(
        [tuple(seen.get[n] for n in ("n_rows", "user_id_nulls", "event_type_nulls"))],
        "n_rows long, user_id_nulls long, event_type_nulls long",
    )


@query(
    "order_mixed_positions",
    """
    SELECT user_id, ts, event_id,
           row_number() OVER (ORDER BY user_id, ts DESC, event_id) - 1 AS position FROM events
    """,
)
def order_mixed_positions(spark, sf):
    """The whole order: each row's place, from the sizes of the range partitions before its own."""
    df = table(spark, sf, "events").select("user_id", "ts", "event_id")
    order = [("user_id", "asc"), ("ts", "desc"), ("event_id", "asc")]
    place = F.monotonically_increasing_id()
    fixed = written(project.order_rows(df, order, whole=True).withColumn("place", place))
    part = F.shiftright("place", 33)
    sizes = fixed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    row = F.col("place").bitwiseAND((1 << 33) - 1)
    return fixed.withColumn("part", part).join(starts, "part").select(
        "user_id", "ts", "event_id", (F.col("start") + row).alias("position")
    )


@query(
    "dense_ids_ranges",
    """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey || '/' || o_orderpriority) AS BIGINT) AS id
    FROM orders
    """,
)
def dense_ids_ranges(spark, sf):
    """Ids by range partitions, whatever the number of labels."""
    label = F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderpriority")
    df = table(spark, sf, "orders").select("o_orderkey", label.alias("label"))
    return ids.add_dim_ids(df, "label", "id", one_task_labels=0).drop("label")


@query(
    "left_lookup_hot_keys",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, n FROM lineitem
    LEFT JOIN (SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_returnflag <> 'A'
               GROUP BY l_returnflag) USING (l_returnflag)
    """,
)
def left_lookup_hot_keys(spark, sf):
    """The branch for lookups too large to broadcast, with keys that hold a third of all rows."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    counts = lines.where("l_returnflag <> 'A'").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    small = written(counts)
    return spread.left_lookup(
        lines, small, ["l_returnflag"], rows_per_task=1000, broadcast_bytes=0, broadcast_estimate=0
    )
