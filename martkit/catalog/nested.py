"""Arrays, structs, maps and positional reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.catalog.registry import query, table
from martkit.functions import nested
from martkit.operators import explode, joins


@query(
    "flatten_struct",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price_value,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS price_currency_code, o_custkey AS buyer_ucode
    FROM orders
    """,
)
def flatten_struct(spark, sf):
    price = F.struct(F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("currency_code"))
    purchase = F.when(F.col("o_orderkey") % 5 != 0, F.struct(price.alias("price")))
    df = table(spark, sf, "orders").select(
        "o_orderkey", purchase.alias("purchase"), F.struct(F.col("o_custkey").alias("ucode")).alias("buyer")
    )
    return explode.flatten_paths(
        df,
        {"o_orderkey": "o_orderkey", "price_value": "purchase.price.value",
         "price_currency_code": "purchase.price.currency_code", "buyer_ucode": "buyer.ucode"},
    )


@query(
    "explode_nested",
    """
    WITH t AS (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations
               WHERE role = 'user'),
    e AS (SELECT conv_id, turn, unnest(lines) AS document_value, generate_subscripts(lines, 1) - 1 AS child_pos
          FROM t WHERE turn % 4 <> 2)
    SELECT conv_id, turn, 0::INTEGER AS pos, CAST(child_pos AS INTEGER) AS child_pos, document_value FROM e
    UNION ALL SELECT conv_id, turn, 0, NULL, NULL FROM t WHERE turn % 4 = 2
    """,
)
def explode_nested(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("value")))
    documents = F.when(F.col("turn") % 4 != 2, lines)
    user = F.struct(
        F.col("role"), F.struct(F.col("conv_id").alias("ucode"), documents.alias("documents")).alias("user")
    )
    df = table(spark, sf, "conversations").select("turn", F.array(user).alias("users"))
    return explode.explode_children(
        df, "users",
        keep=lambda u: u["role"] == "user",
        child=lambda u: u["user"]["documents"],
        parent_cols={"conv_id": lambda u: u["user"]["ucode"]},
        child_cols={"document_value": lambda d: d["value"]},
        carry=["turn"],
    )


@query(
    "first_of_array",
    """
    SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN string_split(text, chr(10))[1] END AS email
    FROM documents
    """,
)
def first_of_array(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("value")))
    key = F.col("doc_id")
    emails = F.when(key % 12 == 0, F.filter(lines, lambda x: F.lit(False))).when(key % 6 != 0, lines)
    df = table(spark, sf, "documents").select("doc_id", emails.alias("email"))
    return df.select("doc_id", nested.first_of(F.col("email"), "value").alias("email"))


@query(
    "action_value",
    """
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN CAST(trunc(value) AS BIGINT) ELSE 0 END AS purchases,
           CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS purchase_value,
           CAST(json_extract(props, '$.k') AS BIGINT) AS leads, 0::BIGINT AS bad, 0::BIGINT AS absent
    FROM events
    """,
)
def action_value(spark, sf):
    def entry(kind, value):
        return F.struct(kind.alias("action_type"), value.cast("string").alias("value"))

    actions = F.array(
        entry(F.col("event_type"), F.col("value")),
        entry(F.lit("lead"), F.get_json_object("props", "$.k")),
        entry(F.lit("lead"), F.lit("999")),
        entry(F.lit("broken"), F.lit("x")),
        entry(F.col("event_type"), F.lit("-1")),
    )
    df = table(spark, sf, "events").select("event_id", actions.alias("actions"))
    a = F.col("actions")
    return df.select(
        "event_id",
        nested.action_value(a, "purchase").alias("purchases"),
        nested.action_value(a, "purchase", as_double=True).alias("purchase_value"),
        nested.action_value(a, "lead").alias("leads"),
        nested.action_value(a, "broken").alias("bad"),
        nested.action_value(a, "nothing").alias("absent"),
    )


@query(
    "audience_text",
    """
    WITH t AS (SELECT p_partkey, list_sort(list_distinct(list_concat(string_split(p_name, ' '), [p_type]))) AS names
               FROM part)
    SELECT p_partkey,
           CASE WHEN p_partkey % 7 = 0 THEN ''
                WHEN p_partkey % 7 = 1 THEN 'CA:' || p_size || ' | CA:z'
                ELSE array_to_string(names, ' | ') || ' | CA:' || p_size || ' | CA:z' END AS publicos
    FROM t JOIN part USING (p_partkey)
    """,
)
def audience_text(spark, sf):
    def person(name, i):
        return F.struct(i.cast("string").alias("id"), name.cast("string").alias("name"))

    none = F.lit(None)
    words = F.transform(F.split("p_name", " "), lambda w: person(w, F.lit("1")))
    key = F.col("p_partkey")
    nameless = F.array(person(none, F.lit("z")), person(F.lit(""), F.col("p_size")), person(none, none))
    typed = F.array(person(F.col("p_type"), F.lit("2")), person(none, F.lit("z")))
    specs = F.array(
        F.struct(nameless.alias("custom_audiences")),
        F.struct(F.when(key % 7 > 1, typed).alias("custom_audiences")),
    )
    targeting = F.when(
        key % 7 != 0,
        F.struct(F.when(key % 7 > 1, words).alias("custom_audiences"), specs.alias("flexible_spec")),
    )
    df = table(spark, sf, "part").select("p_partkey", targeting.alias("targeting"))
    return df.select("p_partkey", nested.audience_text(F.col("targeting")).alias("publicos"))


@query(
    "explode_map",
    """
    SELECT p_partkey, 'USD' AS moeda_destino, p_retailprice AS resultado FROM part
    UNION ALL SELECT p_partkey, 'EUR', p_retailprice * 2 FROM part
    UNION ALL SELECT p_partkey, 'CAD', CAST(p_size AS DOUBLE) FROM part
    """,
)
def explode_map(spark, sf):
    price = F.col("p_retailprice")
    rates = F.create_map(
        F.lit("USD"), price, F.lit("EUR"), price * 2, F.lit("CAD"), F.col("p_size").cast("double")
    )
    df = table(spark, sf, "part").select("p_partkey", rates.alias("rates"))
    return explode.explode_map(df, "rates", "moeda_destino", "resultado", carry=["p_partkey"])


ALIASES = {"utm_campaign": "utm_campaign", "UTM source": "utm_source", "utm_medium": "utm_medium"}


def labels(spark):
    row = "'k' AS key, ' UTM_Campaign ' AS name"
    return spark.range(1).selectExpr(*row.split(", ")).unionByName(
        spark.range(1).selectExpr("'zz' AS key", "'Unrelated' AS name")
    )


def props_map(c):
    parsed = F.from_json(c, "map<string,string>")
    extra = F.create_map(
        F.lit("utm_source"), F.col("event_type"), F.lit("zz"), F.lit("dropped"),
        F.lit("UTM medium"), F.lit(None).cast("string"),
    )
    return F.map_concat(parsed, extra)


@query(
    "map_to_columns",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS utm_campaign, event_type AS utm_source, '' AS utm_medium
    FROM events
    """,
)
def map_to_columns(spark, sf):
    df = table(spark, sf, "events").select("event_id", props_map(F.col("props")).alias("fields"))
    return joins.map_to_columns(df, "event_id", "fields", labels(spark), ALIASES, one_per_key=True)


@query(
    "enrich_attributes",
    """
    SELECT o_orderkey, coalesce(c_mktsegment, '') AS utm_campaign,
           CASE WHEN c_custkey IS NULL THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS utm_source
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
    """,
)
def enrich_attributes(spark, sf):
    fields = F.create_map(
        F.lit("k"), F.col("c_mktsegment"), F.lit("utm_source"), F.col("c_nationkey").cast("string"),
        F.lit("other"), F.col("c_name"),
    )
    owners = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), fields.alias("fields")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    aliases = {"utm campaign": "utm_campaign", "utm_source": "utm_source"}
    return joins.enrich_attributes(
        orders, owners, "o_custkey", "id", "fields", labels(spark), aliases
    ).drop("o_custkey")


@query(
    "flatten_report",
    """
    SELECT strftime(ts, '%Y%m%d') AS "Data", event_type AS "Evento", CAST(NULL AS VARCHAR) AS "Canal",
           count(*) AS "Total"
    FROM events GROUP BY ALL
    """,
)
def flatten_report(spark, sf):
    counted = (
        table(spark, sf, "events")
        .groupBy(F.date_format("ts", "yyyyMMdd").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = counted.select(
        F.array(F.struct(F.col("day").alias("value")), F.struct(F.col("event_type").alias("value"))).alias(
            "dimension_values"
        ),
        F.array(F.struct(F.col("n").cast("string").alias("value"))).alias("metric_values"),
    )
    return explode.flatten_report(rows, ["Data", "Evento", "Canal"], ["Total"])
