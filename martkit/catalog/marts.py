"""Whole marts, fed from the test tables under the feeds' column names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martkit.catalog.registry import ORACLE, query, table
from martkit.catalog.scalar import money
from martkit.functions.dates import ts_to_epoch_ms
from martkit.operators.project import select_all
from martkit.operators.star import attach_dims
from martkit.plans import ads_a, ads_b, contacts, crm, sales_a, sales_b, small
from martkit.plans import contracts as c
from martkit.plans.daily import merge_stage_snapshot, read_history, read_moves, run_moves
from martkit.plans.deliveries import read_ads_a, read_sales_a, run_ads_a, run_sales_a
from martkit.workspace import new_folder


def text(col):
    return F.col(col).cast("string")


# --- CRM ---------------------------------------------------------------------


def crm_inputs(spark, sf):
    events = table(spark, sf, "events")
    customer = table(spark, sf, "customer")
    stamp = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    moves = events.select(
        "event_type",
        text("user_id").alias("deal_id"),
        (F.col("user_id") % 5).cast("string").alias("pipeline_id"),
        (F.col("event_id") % 7).cast("string").alias("old_value"),
        (F.col("event_id") % 11).cast("string").alias("new_value"),
        text("event_id").alias("title"),
        F.when(F.col("event_id") % 9 != 0, money("value")).otherwise(F.lit("n/a")).alias("value"),
        F.lit("BRL").alias("currency"),
        F.when(F.col("event_id") % 4 != 0, text("user_id")).alias("person_id"),
        F.when(F.col("event_id") % 10 != 0, stamp).otherwise(F.lit("soon")).alias("timestamp"),
    )
    fields = F.create_map(
        F.lit("4f2a"), F.col("c_mktsegment"), F.lit("utm_source"), text("c_nationkey"),
        F.lit("9b"), F.col("c_name"),
    )
    persons = customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(
            F.col("c_custkey") % 3 != 0,
            F.array(F.struct(F.concat(F.col("c_name"), F.lit("@example.org")).alias("value"))),
        ).alias("email"),
        F.array(F.struct(text("c_custkey").alias("value")), F.struct(F.lit("x").alias("value"))).alias("phone"),
        fields.alias("fields"),
    )
    person_fields = table(spark, sf, "region").select(
        F.when(F.col("r_regionkey") == 0, F.lit("4f2a")).otherwise(text("r_regionkey")).alias("key"),
        F.when(F.col("r_regionkey") == 0, F.lit("UTM Campaign")).otherwise(F.col("r_name")).alias("name"),
    )
    status = F.when(F.col("c_acctbal") < 0, F.lit("deleted")).otherwise(F.lit("open"))
    # customers of one segment never had a deal
    deals = customer.where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("id"), status.alias("status")
    )
    # three snapshots: some names change, some stages are gone in the second, some lack a field
    stages = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("stage_id"),
        F.col("s_name").alias("stage_name"),
        (F.col("s_suppkey") % 9).cast("int").alias("stage_order_nr"),
        (F.col("s_suppkey") % 5).alias("pipeline_id"),
        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("n"),
        (F.col("s_acctbal") > 5000).alias("gap"),
    ).where("not (n = 2 and gap)")
    stages = stages.select(
        "stage_id", "stage_name", "stage_order_nr", "pipeline_id",
        F.when((F.col("n") < 3) | (F.col("stage_id") % 3 != 0), F.lit("Funnel"))
        .otherwise(F.lit("Funnel II")).alias("pipeline_name"),
        F.concat(F.lit("2025-01-0"), text("n"), F.lit(" 00:00:00")).cast("timestamp_ntz").alias("snapshot_time"),
    )
    lacking = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("stage_id"), F.lit(None).cast("string").alias("stage_name"),
        F.lit(1).alias("stage_order_nr"), F.lit(1).cast("bigint").alias("pipeline_id"),
        F.lit("Funnel").alias("pipeline_name"),
        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("snapshot_time"),
    )
    return {
        "moves": moves, "persons": persons, "person_fields": person_fields, "deals": deals,
        "stages": stages.unionByName(lacking),
    }


CRM_FACT = """
    f AS (
      SELECT event_id, user_id AS deal_id, user_id % 5 AS pipeline_id, event_id % 7 AS old_stage_id,
             event_id % 11 AS new_stage_id,
             CASE WHEN event_id % 9 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
             CASE WHEN event_id % 4 <> 0 THEN user_id END AS person_id,
             CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS timestamp
      FROM events)
"""


@query(
    "mart_crm",
    f"""
    WITH {CRM_FACT}
    SELECT CAST(event_id AS VARCHAR) AS title, deal_id, pipeline_id, old_stage_id, new_stage_id, value,
           person_id, timestamp, CAST(timestamp AS DATE) AS date,
           CAST(timestamp = max(timestamp) OVER (PARTITION BY deal_id) AS BIGINT) AS flg_ultimo_movimento,
           CAST(d.c_custkey IS NOT NULL AS BIGINT) AS flag_deal_ativo,
           coalesce(p.c_mktsegment, '') AS utm_campaign,
           coalesce(CAST(p.c_nationkey AS VARCHAR), '') AS utm_source, '' AS utm_medium, '' AS comment,
           p.c_name AS person_name,
           CASE WHEN p.c_custkey % 3 <> 0 THEN p.c_name || '@example.org' END AS person_email,
           CAST(p.c_custkey AS VARCHAR) AS person_phone,
           s.s_name AS stage_name
    FROM f LEFT JOIN customer p ON person_id = p.c_custkey
    LEFT JOIN customer d ON deal_id = d.c_custkey AND d.c_mktsegment <> 'BUILDING' AND d.c_acctbal >= 0
    LEFT JOIN supplier s ON new_stage_id = s_suppkey
    """,
)
def mart_crm(spark, sf):
    mart = crm.build_crm(crm_inputs(spark, sf))
    persons = mart["dim_person"].select(
        F.col("id").alias("person_id"), F.col("name").alias("person_name"),
        F.col("email").alias("person_email"), F.col("phone").alias("person_phone"),
    )
    stages = mart["dim_stage"].select(F.col("stage_id").alias("new_stage_id"), "stage_name")
    fact = select_all(
        mart["ft_move"],
        ["title", "deal_id", "pipeline_id", "old_stage_id", "new_stage_id", "value", "person_id",
         "timestamp", "date", "flg_ultimo_movimento", "flag_deal_ativo", "utm_campaign", "utm_source",
         "utm_medium", "comment"],
    )
    return attach_dims(fact, {"person_id": persons, "new_stage_id": stages})


@query(
    "mart_crm_daily",
    f"""
    WITH {CRM_FACT}
    SELECT CAST(event_id AS VARCHAR) AS title, deal_id, value, timestamp,
           CAST(timestamp = max(timestamp) OVER (PARTITION BY deal_id) AS BIGINT) AS flg_ultimo_movimento,
           coalesce(p.c_mktsegment, '') AS utm_campaign,
           CASE WHEN event_id % 100 < 60 THEN '20250101_000000' ELSE '20250102_000000' END AS load_ts
    FROM f LEFT JOIN customer p ON person_id = p.c_custkey
    """,
)
def mart_crm_daily(spark, sf):
    """Two deliveries, each taken in by a run of its own, and a third run without a new file."""
    base, inputs = new_folder(spark, "daily"), crm_inputs(spark, sf)
    second = F.col("title").cast("bigint") % 100 >= 60
    parts = [inputs["moves"].where(~second), inputs["moves"].where(second), None]
    for day, part in enumerate(parts, 1):
        if part is not None:
            part.write.mode("append").json(f"{base}/moves")
        run_moves(
            spark, f"{base}/moves", f"{base}/silver", f"{base}/gold", f"2025010{day}_000000",
            inputs["persons"], inputs["person_fields"], inputs["deals"],
        )
    fact = read_moves(spark, f"{base}/gold")
    return select_all(
        fact, ["title", "deal_id", "value", "timestamp", "flg_ultimo_movimento", "utm_campaign", "load_ts"]
    )


@query(
    "mart_crm_stage_history",
    """
    WITH s AS (SELECT s_suppkey AS id, s_name, s_suppkey % 5 AS pipeline_id, CAST(s_suppkey % 9 AS INTEGER) AS o,
                      s_acctbal > 5000 AS gap, s_suppkey % 3 = 0 AS renamed FROM supplier),
    v AS (
      SELECT *, 'Funnel' AS p, TIMESTAMP '2025-01-01' AS a,
             CASE WHEN gap THEN TIMESTAMP '2025-01-02' WHEN renamed THEN TIMESTAMP '2025-01-03'
                  ELSE TIMESTAMP '9999-12-31 23:59:59' END AS z FROM s
      UNION ALL
      SELECT *, CASE WHEN renamed THEN 'Funnel II' ELSE 'Funnel' END, TIMESTAMP '2025-01-03',
             TIMESTAMP '9999-12-31 23:59:59' FROM s WHERE gap OR renamed)
    SELECT id AS stage_id, s_name AS stage_name, o AS stage_order_nr, pipeline_id, p AS pipeline_name,
           a AS dt_inicio_vigencia, z AS dt_fim_vigencia, id || '|' || pipeline_id AS pk_allstages
    FROM v
    """,
)
def mart_crm_stage_history(spark, sf):
    return crm.stage_dims(crm_inputs(spark, sf)["stages"])["scd2_dim_stage"]


@query("mart_crm_stage_history_merged", ORACLE["mart_crm_stage_history"])
def mart_crm_stage_history_merged(spark, sf):
    """The same history, from snapshots merged one by one; the first is delivered twice."""
    gold, stages = new_folder(spark, "history"), crm_inputs(spark, sf)["stages"]
    for day in (1, 1, 2, 3):
        at = datetime(2025, 1, day)
        merge_stage_snapshot(spark, stages.where(F.col("snapshot_time") == F.lit(at).cast("timestamp_ntz")), at, gold)
    return read_history(spark, gold)


@query(
    "mart_crm_dims",
    """
    SELECT 'pipeline' AS dim, s_suppkey % 5 AS id,
           CASE WHEN (min(s_suppkey)) % 3 = 0 THEN 'Funnel II' ELSE 'Funnel' END AS name, CAST(NULL AS INTEGER) AS nr
    FROM supplier GROUP BY s_suppkey % 5
    UNION ALL SELECT 'stage', s_suppkey, s_name, CAST(s_suppkey % 9 AS INTEGER) FROM supplier
    UNION ALL SELECT 'rejected', CAST(n_nationkey AS BIGINT), NULL, 1 FROM nation
    """,
)
def mart_crm_dims(spark, sf):
    mart = crm.stage_dims(crm_inputs(spark, sf)["stages"])
    none = F.lit(None).cast("int").alias("nr")
    pipes = mart["dim_pipeline"].select(
        F.lit("pipeline").alias("dim"), F.col("pipeline_id").alias("id"), F.col("pipeline_name").alias("name"), none
    )
    stages = mart["dim_stage"].select(
        F.lit("stage").alias("dim"), F.col("stage_id").alias("id"), F.col("stage_name").alias("name"),
        F.col("stage_order_nr").alias("nr"),
    )
    rejected = mart["rejected_stages"].select(
        F.lit("rejected").alias("dim"), F.col("stage_id").alias("id"), F.col("stage_name").alias("name"),
        F.col("stage_order_nr").alias("nr"),
    )
    return pipes.unionByName(stages).unionByName(rejected)


@query(
    "mart_crm_remap",
    """
    WITH cur AS (SELECT p_brand, p_type, max(p_partkey) AS id FROM part GROUP BY ALL),
    m AS (SELECT p_partkey AS id, cur.id AS now FROM part JOIN cur USING (p_brand, p_type))
    SELECT l_orderkey, l_linenumber, l_suppkey AS pipeline_id, l_partkey,
           coalesce(n.now, l_partkey) AS new_stage_id, coalesce(o.now, l_partkey + 1) AS old_stage_id
    FROM lineitem LEFT JOIN m n ON l_partkey = n.id LEFT JOIN m o ON l_partkey + 1 = o.id
    """,
)
def mart_crm_remap(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("stage_id"), F.col("p_brand").alias("stage_name"),
        F.col("p_type").alias("pipeline_id"),
    )
    newest = part.groupBy("stage_name", "pipeline_id").agg(F.max("stage_id").alias("now"))
    end = F.when(F.col("stage_id") == F.col("now"), F.lit("9999-12-31 23:59:59")).otherwise(
        F.lit("2000-01-01 00:00:00")
    )
    past = part.join(newest, ["stage_name", "pipeline_id"]).withColumn(
        "dt_fim_vigencia", end.cast("timestamp_ntz")
    )
    fact = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("pipeline_id"), "l_partkey",
        F.col("l_partkey").alias("new_stage_id"), (F.col("l_partkey") + 1).alias("old_stage_id"),
    )
    return crm.remap_stages(fact, past)


# --- ads B ---------------------------------------------------------------------


def comma(col):
    return F.replace(money(col), F.lit("."), F.lit(","))


def ads_b_sheet(spark, sf):
    """One sheet row per order line, all cells text, with blanks and decimal commas."""
    return table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-M-d").alias("data"),
        text("l_suppkey").alias("id_campanha"),
        F.concat(F.lit("Camp "), text("l_suppkey")).alias("nome_campanha"),
        F.lit("SEARCH").alias("tipo_campanha"),
        F.col("l_linestatus").alias("status_campanha"),
        text("l_partkey").alias("id_grupo"),
        F.concat(F.lit("Grupo "), text("l_partkey")).alias("nome_grupo"),
        F.col("l_returnflag").alias("status_grupo"),
        text("l_orderkey").alias("id_anuncio"),
        F.concat(F.lit("Ad "), text("l_orderkey")).alias("nome_anuncio"),
        F.lit("VIDEO").alias("tipo_anuncio"),
        F.when(F.col("l_linenumber") != 2, F.col("l_returnflag")).alias("rede"),
        F.col("l_linestatus").alias("dispositivo"),
        F.col("l_quantity").cast("bigint").cast("string").alias("impressoes"),
        F.when(F.col("l_linenumber") == 4, F.lit("1.5")).otherwise(text("l_linenumber")).alias("cliques"),
        comma("l_discount").alias("ctr"),
        F.when(F.col("l_linenumber") == 5, F.lit(" ")).otherwise(comma("l_tax")).alias("cpc_medio"),
        comma("l_extendedprice").alias("custo"),
        F.when(F.col("l_linenumber") == 6, F.lit("1.234,56")).otherwise(F.lit("2")).alias("conversoes"),
    )


ADS_B_METRICS = """
    CAST(l_shipdate AS DATE) AS data, CAST(l_quantity AS BIGINT) AS impressoes,
    CASE WHEN l_linenumber = 4 THEN 0 ELSE l_linenumber END::BIGINT AS cliques,
    CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS ctr,
    CASE WHEN l_linenumber = 5 THEN 0.0 ELSE CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) END AS cpc_medio,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS custo,
    CASE WHEN l_linenumber = 6 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS conversoes
"""


@query(
    "mart_ads_b_campaign",
    f"""
    SELECT {ADS_B_METRICS}, CAST(l_suppkey AS VARCHAR) AS id_campanha, l_linestatus AS status_campanha,
           'Camp ' || l_suppkey AS nome_campanha, 'SEARCH' AS tipo_campanha
    FROM lineitem
    """,
)
def mart_ads_b_campaign(spark, sf):
    campaigns = ads_b.silver(ads_b.bronze(ads_b_sheet(spark, sf)))
    fact = ads_b.build_fact(campaigns, c.FATO_CAMPANHA)
    return attach_dims(fact, {"id_campanha": ads_b.build_dim(campaigns, c.DIM_CAMPANHA)})


def ads_b_mart(spark, sf, *only):
    sheet = ads_b_sheet(spark, sf)
    keywords = sheet.select(
        "data", F.col("nome_anuncio").alias("palavra_chave"), F.lit("EXACT").alias("tipo_correspondencia"),
        F.col("status_grupo").alias("status"), F.col("id_anuncio").alias("criterion_id"),
        F.col("id_grupo").alias("grupo_id"), F.col("id_campanha").alias("campanha_id"),
        "impressoes", "cliques", "custo", "conversoes",
    )
    audience = F.concat(F.lit(" "), F.col("nome_campanha"))
    audiences = sheet.select(
        "data", "id_campanha", "id_grupo",
        F.when(F.col("cliques") != "3", audience).otherwise(F.lit(" ")).alias("publicos_do_grupo"),
        F.lit("18-24").alias("faixa_idade"), F.lit("F").alias("genero"), F.lit("x").alias("faixa_renda"),
        F.lit("y").alias("status_parental"),
        F.concat(F.lit("1."), F.lpad("impressoes", 3, "0")).alias("impressoes"), "cliques", "conversoes",
    )
    ads = sheet.select([x for x in c.ADS_B_AD_COLUMNS if x in sheet.columns])
    return ads_b.build_ads_b(
        {"campaigns": sheet, "groups": sheet, "ads": ads, "keywords": keywords, "audiences": audiences},
        only,
    )


@query(
    "mart_ads_b",
    f"""
    WITH t AS (SELECT *, CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS rede FROM lineitem),
    x AS (SELECT *, dense_rank() OVER (ORDER BY rede NULLS LAST) AS r,
                 dense_rank() OVER (ORDER BY l_linestatus) AS d FROM t)
    SELECT {ADS_B_METRICS}, CAST(l_suppkey AS VARCHAR) AS id_campanha, CAST(l_partkey AS VARCHAR) AS id_grupo,
           CAST(l_orderkey AS VARCHAR) AS id_anuncio, CAST(r AS VARCHAR) AS id_rede,
           CAST(d AS VARCHAR) AS id_dispositivo, rede, l_linestatus AS dispositivo,
           'Ad ' || l_orderkey AS nome_anuncio, 'Grupo ' || l_partkey AS nome_grupo
    FROM x
    """,
)
def mart_ads_b(spark, sf):
    mart = ads_b_mart(spark, sf, "fato_anuncio", "dim_anuncio", "dim_rede", "dim_dispositivo", "dim_grupoAnuncio")
    ad = mart["dim_anuncio"].select("id_anuncio", "nome_anuncio")
    # the large dimensions first: where they shuffle the fact, its rows are still narrow
    whole = attach_dims(
        mart["fato_anuncio"],
        {"id_anuncio": ad, "id_grupo": mart["dim_grupoAnuncio"], "id_rede": mart["dim_rede"],
         "id_dispositivo": mart["dim_dispositivo"]},
    )
    return select_all(whole, [*c.FATO_ANUNCIO, "nome_anuncio", "rede", "dispositivo", "nome_grupo"])


@query(
    "mart_ads_b_audience",
    """
    WITH t AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN 'Camp ' || l_suppkey ELSE '' END AS p FROM lineitem),
    m AS (SELECT p, row_number() OVER (ORDER BY p) AS id FROM (SELECT DISTINCT p FROM t WHERE p <> ''))
    SELECT CAST(l_shipdate AS DATE) AS data, CAST(l_suppkey AS VARCHAR) AS id_campanha,
           CAST(l_partkey AS VARCHAR) AS id_grupo, coalesce(id, 0) AS id_publico, t.p AS publicos_do_grupo,
           '18-24' AS faixa_idade, 'F' AS genero, 'x' AS faixa_renda, 'y' AS status_parental,
           1000 + CAST(l_quantity AS BIGINT) AS impressoes,
           CASE WHEN l_linenumber = 4 THEN 15 ELSE l_linenumber END::BIGINT AS cliques,
           CASE WHEN l_linenumber = 6 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS conversoes
    FROM t LEFT JOIN m ON t.p = m.p
    """,
)
def mart_ads_b_audience(spark, sf):
    mart = ads_b_mart(spark, sf, "fato_publico_alvo", "dim_publico_alvo")
    return attach_dims(mart["fato_publico_alvo"], {"id_publico": mart["dim_publico_alvo"]})


@query(
    "mart_ads_b_groups_keywords",
    """
    SELECT 'group' AS kind, CAST(l_shipdate AS DATE) AS data, CAST(l_partkey AS VARCHAR) AS id,
           l_returnflag AS status, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS custo FROM lineitem
    UNION ALL
    SELECT 'keyword', CAST(l_shipdate AS DATE), CAST(l_orderkey AS VARCHAR), l_returnflag,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem
    """,
)
def mart_ads_b_groups_keywords(spark, sf):
    mart = ads_b_mart(spark, sf, "fato_grupoAnuncio", "fato_keywords")
    groups = mart["fato_grupoAnuncio"].select(
        F.lit("group").alias("kind"), "data", F.col("id_grupo").alias("id"),
        F.col("status_grupo").alias("status"), "custo",
    )
    words = mart["fato_keywords"].select(
        F.lit("keyword").alias("kind"), "data", F.col("criterion_id").alias("id"), "status", "custo"
    )
    return groups.unionByName(words)


# --- ads A ---------------------------------------------------------------------


def insight_rows(spark, sf, *ids):
    """One insight record per event, metrics as text, some fields absent."""
    events = table(spark, sf, "events")
    even = F.col("event_id") % 2 == 0

    def action(kind, value):
        return F.struct(F.lit(kind).alias("action_type"), value.cast("string").alias("value"))

    actions = F.when(
        even, F.array(action("lead", F.lit("3.0")), action("lead", F.lit("9")),
                      action("omni_purchase", F.col("value"))),
    )
    zero = F.col("event_id") % 5 == 1
    absent = F.lit(None).cast("string")
    metric = {
        "spend": F.when(even, money("value")),
        "impressions": F.when(zero, F.lit("0")).otherwise(text("user_id")),
        "clicks": F.lit("0"), "ctr": F.lit("0.5"), "cpc": absent, "reach": F.lit("x"),
        "frequency": F.lit("1"), "cost_per_unique_click": absent,
    }
    day = F.to_date("ts").cast("string")
    return events.select(
        *ids, F.when(even, day).alias("date_start"), day.alias("date_stop"),
        *[v.alias(k) for k, v in metric.items()], actions.alias("actions"),
        F.concat(F.lit("/bronze/ads_"), day, F.lit(".json")).alias("source_file"),
        "event_id",
    )


INSIGHT_SQL = """
    event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_start,
    CASE WHEN event_id % 2 = 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) ELSE 0.0 END AS spend,
    CASE WHEN event_id % 5 = 1 THEN 0 ELSE user_id END AS impressions, 0::BIGINT AS reach,
    0.5::DOUBLE AS ctr, 0.0::DOUBLE AS cpc,
    CASE WHEN event_id % 2 = 0 THEN 3 ELSE 0 END::BIGINT AS leads, 0::BIGINT AS purchases,
    CASE WHEN event_id % 2 = 0 THEN value ELSE 0.0 END AS purchase_value
"""
INSIGHT_COLS = ["event_id", "date_start", "spend", "impressions", "reach", "ctr", "cpc", "leads",
                "purchases", "purchase_value"]
INSIGHT_KEPT = "(event_id % 2 = 0 OR (event_id % 5 <> 1 AND user_id > 0))"


@query(
    "mart_ads_a",
    f"""
    SELECT {INSIGHT_SQL}, CAST(user_id AS VARCHAR) AS ad_id,
           CASE user_id % 5
             WHEN 0 THEN 'https://www.facebook.com/v/videos/' || user_id
             WHEN 1 THEN 'https://www.facebook.com/watch/?v=v' || user_id
             WHEN 2 THEN 'https://www.facebook.com/1/posts/' || user_id
             WHEN 3 THEN 'https://example.org/p/1_' || user_id ELSE '' END AS video_url,
           CASE user_id % 5
             WHEN 0 THEN 'https://www.facebook.com/watch/?v=' || user_id
             WHEN 1 THEN 'https://www.facebook.com/watch/?v=v' || user_id
             WHEN 2 THEN 'https://www.facebook.com/1/posts/' || user_id
             WHEN 3 THEN 'https://example.org/p/1_' || user_id ELSE '' END AS video_url_click,
           CASE user_id % 5 WHEN 0 THEN 'thumb' || user_id WHEN 3 THEN 'full' || user_id ELSE '' END
             AS video_thumbnail_url,
           'Ad ' || user_id AS dim_name
    FROM events WHERE {INSIGHT_KEPT}
    """,
)
def mart_ads_a(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct()
    i, kind = text("user_id"), F.col("user_id") % 5
    video = F.struct(
        F.struct(F.when(kind <= 1, F.concat(F.lit("v"), i)).alias("video_id")).alias("video_data")
    )
    creatives = users.select(
        i.alias("ad_id"),
        F.struct(
            F.when(F.col("user_id") % 5 <= 3, F.concat(F.lit("1_"), i)).alias("effective_object_story_id"),
            F.lit(None).cast("string").alias("object_story_id"),
            F.lit(None).cast("struct<videos:array<struct<video_id:string>>>").alias("asset_feed_spec"),
            video.alias("object_story_spec"),
        ).alias("creative"),
    )
    thumbs = F.struct(F.array(F.struct(F.concat(F.lit("thumb"), i).alias("uri"))).alias("data"))
    # media are known for the videos of one kind of user and the posts of another
    prefix = F.when(kind == 0, "v").when(kind == 3, "1_").otherwise("none")
    media = users.select(
        F.concat(prefix, i).alias("id"),
        F.when(kind == 0, F.concat(F.lit("https://www.facebook.com/v/videos/"), i))
        .otherwise(F.concat(F.lit("https://example.org/p/1_"), i)).alias("permalink_url"),
        F.lit("").alias("picture"),
        F.concat(F.lit("full"), i).alias("full_picture"),
        thumbs.alias("thumbnails"),
    )
    raw = insight_rows(spark, sf, i.alias("ad_id"), F.concat(F.lit("Ad "), i).alias("ad_name"))
    ads = ads_a.ad_insights(raw, creatives, media)
    dim = ads_a.build_dim(ads, c.ADS_A_DIM_AD).withColumnRenamed("ad_name", "dim_name")
    wanted = [*INSIGHT_COLS, "ad_id", *ads_a.VIDEO_COLUMNS]
    return attach_dims(select_all(ads, wanted), {"ad_id": dim})


@query(
    "mart_ads_a_adsets",
    f"""
    SELECT {INSIGHT_SQL}, CAST(user_id AS VARCHAR) AS adset_id,
           CASE WHEN c_custkey IS NULL THEN '' ELSE c_mktsegment || ' | CA:' || c_nationkey END
             AS publicos_personalizados_incluidos,
           'Set ' || user_id AS dim_name
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0
    WHERE {INSIGHT_KEPT}
    """,
)
def mart_ads_a_adsets(spark, sf):
    def person(name, i):
        return F.struct(i.cast("string").alias("id"), name.cast("string").alias("name"))

    none = F.lit(None)
    direct = F.array(person(F.col("c_mktsegment"), F.lit("7")), person(none, F.col("c_nationkey")))
    spec = F.array(F.struct(F.array(person(F.col("c_mktsegment"), none)).alias("custom_audiences")))
    targeting = table(spark, sf, "customer").where("c_acctbal > 0").select(
        text("c_custkey").alias("id"),
        F.struct(direct.alias("custom_audiences"), spec.alias("flexible_spec")).alias("targeting"),
    )
    i = text("user_id")
    raw = insight_rows(spark, sf, i.alias("adset_id"), F.concat(F.lit("Set "), i).alias("adset_name"))
    sets = ads_a.adset_insights(raw, targeting)
    dim = ads_a.build_dim(sets, c.ADS_A_DIM_ADSET).withColumnRenamed("adset_name", "dim_name")
    wanted = [*INSIGHT_COLS, "adset_id", "publicos_personalizados_incluidos"]
    return attach_dims(select_all(sets, wanted), {"adset_id": dim})


@query(
    "mart_ads_a_dim_camp",
    """
    SELECT CAST(user_id AS VARCHAR) AS campaign_id, 'Camp ' || event_type AS campaign_name,
           CASE WHEN event_id % 2 = 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) ELSE 0.0 END AS spend
    FROM events WHERE event_id % 2 = 0 OR (event_id % 5 <> 1 AND user_id > 0)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_type, 3 DESC,
                               CASE WHEN event_id % 2 = 0 THEN value ELSE 0 END DESC) = 1
    """,
)
def mart_ads_a_dim_camp(spark, sf):
    raw = insight_rows(
        spark, sf, text("user_id").alias("id"), F.concat(F.lit("Camp "), F.col("event_type")).alias("name")
    )
    newest = [F.col("date_stop").desc(), F.col("campaign_name"), F.col("spend").desc()]
    return ads_a.dim_camp(ads_a.insights(raw), newest)


@query(
    "mart_ads_a_daily",
    f"""
    SELECT {INSIGHT_SQL}, CAST(user_id AS VARCHAR) AS campaign_id FROM events WHERE {INSIGHT_KEPT}
    """,
)
def mart_ads_a_daily(spark, sf):
    """Files of dated folders: odd days, then even days and late files of odd ones, then nothing new."""
    base = new_folder(spark, "ads-daily")
    raw = insight_rows(spark, sf, text("user_id").alias("campaign_id"), text("event_id").alias("campaign_name"))
    late = F.col("event_id") % 50 == 7
    odd = F.dayofmonth("date_stop") % 2 == 1
    for part in (odd & ~late, ~odd | late, None):
        if part is not None:
            kept = raw.where(part).drop("source_file", "event_id").withColumn("date", F.col("date_stop"))
            kept.repartition("date").write.mode("append").partitionBy("date").json(f"{base}/bronze/campaigns")
        run_ads_a(spark, f"{base}/bronze", f"{base}/gold", {}, lines=True)
    fact = read_ads_a(spark, f"{base}/gold", ["campaigns"])["campaigns"]
    return select_all(fact.withColumn("event_id", F.col("campaign_name").cast("bigint")), [*INSIGHT_COLS, "campaign_id"])


# --- sales A -------------------------------------------------------------------


def sales_a_records(spark, sf):
    orders = table(spark, sf, "orders")
    ms = ts_to_epoch_ms(F.col("o_orderdate"))

    def empty(kind):
        return F.lit(None).cast(kind)

    purchase = F.struct(
        F.when(F.col("o_orderkey") % 10 != 0, text("o_orderkey")).alias("transaction"),
        (ms + F.lit(3600000)).alias("approved_date"),
        F.struct(F.col("o_totalprice").alias("value"), F.lit("BRL").alias("currency_code")).alias("price"),
        F.struct(F.col("o_orderpriority").alias("method"), F.col("o_orderstatus").alias("type"),
                 F.lit(3).alias("installments_number")).alias("payment"),
        empty("struct<total:double,currency_code:string,base:double,fixed:double,percentage:double>").alias("hotmart_fee"),
    )
    record = orders.select(
        F.when(F.col("o_orderkey") % 7 != 0, purchase).alias("purchase"),
        F.struct(text("o_custkey").alias("ucode"), F.lit("n").alias("name"), F.lit("e").alias("email")).alias("buyer"),
        F.struct(F.col("o_orderkey").alias("id"), F.lit("p").alias("name")).alias("product"),
        F.col("o_orderkey").alias("pos"),
    )
    # the next window delivers the open orders again, under another product name
    again = record.where("purchase.payment.type = 'O'").withColumns(
        {"pos": F.col("pos") + 1_000_000_000,
         "product": F.struct(F.col("product.id").alias("id"), F.lit("p2").alias("name"))}
    )
    return record.unionByName(again)


@query(
    "mart_sales_a",
    """
    WITH b AS (SELECT *, o_orderkey % 7 <> 0 AS bought FROM orders),
    r AS (SELECT *, 'p' AS product_name FROM b WHERE NOT (bought AND o_orderstatus = 'O' AND o_orderkey % 10 <> 0)
          UNION ALL SELECT *, 'p2' FROM b WHERE bought AND o_orderstatus = 'O'),
    d AS (SELECT o_custkey, min(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END) AS doc FROM orders GROUP BY 1)
    SELECT o_orderkey AS product_id, product_name, CAST(o_custkey AS VARCHAR) AS buyer_ucode,
           CASE WHEN bought THEN o_totalprice END AS price_value,
           CASE WHEN bought THEN o_orderpriority END AS payment_method,
           CASE WHEN bought THEN 3 END AS payment_installments_number, CAST(NULL AS DOUBLE) AS hotmart_fee_total,
           CASE WHEN bought THEN o_orderdate + INTERVAL 1 HOUR END AS approved_datetime_utc,
           CASE WHEN bought THEN o_orderdate - INTERVAL 2 HOUR END AS approved_datetime_brt,
           CASE WHEN bought THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%d/%m/%Y %H:%M:%S') END AS approved_datetime_br,
           CAST(doc AS VARCHAR) AS document_value
    FROM r LEFT JOIN d USING (o_custkey)
    """,
)
def mart_sales_a(spark, sf):
    mart = sales_a.build_sales_a({"sales": sales_a_records(spark, sf), "users": sales_a_users(spark, sf)})
    return sales_with_documents(mart)


def sales_with_documents(mart):
    sales = mart["sales"].select(
        "product_id", "product_name", "buyer_ucode", "price_value", "payment_method",
        "payment_installments_number", "hotmart_fee_total", "approved_datetime_utc",
        "approved_datetime_brt", "approved_datetime_br",
    )
    return attach_dims(sales, {"buyer_ucode": mart["users"].drop("buyer_name")})


def sales_a_users(spark, sf):
    orders = table(spark, sf, "orders")
    documents = F.when(F.col("o_orderkey") % 3 != 0, F.array(F.struct(text("o_orderkey").alias("value"))))

    def entry(role, docs):
        user = F.struct(text("o_custkey").alias("ucode"), F.lit("n").alias("name"), docs.alias("documents"))
        return F.struct(F.lit(role).alias("role"), user.alias("user"))

    other = F.array(F.struct(F.lit("0").alias("value")))
    return orders.select(
        F.array(entry("PRODUCER", other), entry("BUYER", documents)).alias("users"),
        F.col("o_orderkey").alias("pos"),
    )


PULL_RECORDS = 20_000  # about, of one file: a task parses a file whole
PULL_DATES = 12  # of one delivery


def land_pulls(records, path, date, together):
    """Files for each date, each with its records in the order of ``pos`` as an envelope.

    A date with many records gets several files; those of one value of
    ``together`` are in one. Every file has a folder of its own, as an envelope
    is a file's only value.
    """
    item = F.struct(*[c for c in records.columns if c != "pos"])
    files = max(1, -(-records.count() // (PULL_DATES * PULL_RECORDS)))
    part = F.pmod(F.xxhash64(together), F.lit(files)).cast("int")
    pulls = records.groupBy(date.alias("date"), part.alias("part")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", item.alias("r")))), lambda x: x["r"]).alias("dados")
    )
    pulls.write.mode("append").partitionBy("date", "part").json(path)


@query("mart_sales_a_daily", ORACLE["mart_sales_a"])
def mart_sales_a_daily(spark, sf):
    """Pulls taken in by three runs: half of the first ones, the others with the second ones, then nothing new."""
    base = new_folder(spark, "sales-daily")
    records = sales_a_records(spark, sf)
    again = F.col("pos") > 1_000_000_000
    day = F.date_add(F.lit("2024-01-01"), F.pmod("pos", F.lit(PULL_DATES)).cast("int") + F.when(again, 100).otherwise(0))
    early = ~again & (F.col("pos") % 2 == 0)
    # all entries of a buyer come in one file; another hash than that of the day deals them to files
    buyer = F.element_at("users", 2)["user"]["ucode"]
    buyer_day = F.date_add(F.lit("2024-01-01"), F.pmod(F.xxhash64(buyer), F.lit(PULL_DATES)).cast("int"))
    for run, part in enumerate((early, ~early, None)):
        if part is not None:
            land_pulls(records.where(part), f"{base}/bronze/sales", day, F.col("pos"))
        if run == 0:
            land_pulls(sales_a_users(spark, sf), f"{base}/bronze/users", buyer_day, F.struct(buyer, F.lit(1)))
        run_sales_a(spark, f"{base}/bronze", f"{base}/gold")
    return sales_with_documents(read_sales_a(spark, f"{base}/gold"))


# --- sales B -------------------------------------------------------------------


def sales_b_export(spark, sf, columns):
    orders = table(spark, sf, "orders")
    given = {
        "Nome do comprador": F.when(F.col("o_custkey") % 11 != 0, F.concat(F.lit("N"), text("o_custkey"))),
        "Email do comprador": F.concat(text("o_custkey"), F.lit("@example.org")),
        "Nome Afiliado": F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")),
        "ID Venda": F.when(
            F.col("o_orderkey") % 1000 == 7, F.lit("445793")
        ).otherwise(text("o_orderkey")),
        "ID Oferta": F.col("o_orderstatus"), "Nome da oferta": F.concat(F.lit("Oferta "), F.col("o_orderstatus")),
        "ID Produto": F.col("o_orderpriority"), "Nome do produto": F.col("o_orderpriority"),
        "Categoria": F.lit("cat"), "Tipo do produto": F.lit("tipo"),
        "Número de telefone": F.lit("0"), "Endereço físico": F.lit("Rua X"), "CPF/CNPJ": F.lit("-"),
        "Valor Pago": money("o_totalprice"),
    }
    names = list(dict.fromkeys([*given, *columns]))
    return orders.select(
        [given.get(n, F.lit("-")).alias(n) for n in names if n not in ("ID_Cliente", "ID_Afiliado")]
    )


@query(
    "mart_sales_b",
    """
    SELECT o_orderkey AS "ID Venda", o_orderstatus AS "ID Oferta", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "Valor Pago",
           '-' AS "Cod. de Barras", '-' AS "Assinaturas em atraso (dias)",
           md5('N' || o_custkey || o_custkey || '@example.org') AS "ID_Cliente",
           'N' || o_custkey AS "Nome do comprador", 'Rua X' AS "Endereço físico",
           md5(CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus ELSE '' END) AS "ID_Afiliado",
           CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS "Nome Afiliado",
           'Oferta ' || o_orderstatus AS "Nome da oferta", o_orderpriority AS "Nome do produto"
    FROM orders WHERE o_custkey % 11 <> 0 AND o_orderkey % 1000 <> 7
    """,
)
def mart_sales_b(spark, sf):
    projection = table(spark, sf, "region").select(F.lit("jan/2025").alias("Mês"), F.lit("1").alias("Valor Total"))
    mart = sales_b.build_sales_b({"sales": sales_b_export(spark, sf, c.F_VENDAS), "projection": projection})
    fact = select_all(
        mart["f_vendas"],
        ["ID Venda", "ID Oferta", "ID Produto", "Valor Pago", "Cod. de Barras",
         "Assinaturas em atraso (dias)", "ID_Cliente", "ID_Afiliado"],
    )
    clients = select_all(mart["dim_cliente"], ["ID_Cliente", "Nome do comprador", "Endereço físico"])
    products = select_all(mart["dim_produto"], ["ID Produto", "Nome do produto"])
    dims = {"ID_Cliente": clients, "ID_Afiliado": mart["dim_afiliado"], "ID Oferta": mart["dim_oferta"],
            "ID Produto": products}
    return attach_dims(fact, dims).drop("ID Produto")


@query(
    "mart_sales_b_projection",
    """
    SELECT strftime(o_orderdate, '01/%m/%Y') AS "Data", CAST(o_totalprice AS DECIMAL(18,2)) AS "Valor",
           CAST(NULL AS BIGINT) AS "ID Venda" FROM orders
    UNION ALL SELECT NULL, NULL, o_orderkey FROM orders WHERE o_custkey % 11 <> 0 AND o_orderkey % 1000 <> 7
    """,
)
def mart_sales_b_projection(spark, sf):
    names = F.array(*[F.lit(m) for m in ("JAN", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set",
                                         "out", "nov", "dez")])
    orders = table(spark, sf, "orders")
    month = F.concat_ws("/", F.get(names, F.month("o_orderdate") - 1), F.year("o_orderdate").cast("string"))
    shown = F.concat(F.lit("R$ "), F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
    projected = sales_b.projected(orders.select(month.alias("Mês"), shown.alias("Valor Total")))
    fact = sales_b.f_projecao(sales_b_export(spark, sf, c.F_PROJECAO)).select("ID Venda")
    return projected.unionByName(fact, allowMissingColumns=True)


# --- contacts ------------------------------------------------------------------


def contact_inputs(spark, sf):
    customer, events, orders = (table(spark, sf, t) for t in ("customer", "events", "orders"))
    base = customer.select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("N"), text("c_custkey")).alias("firstName"),
        F.when(F.col("c_custkey") % 8 != 0, F.concat(F.lit("m"), text("c_nationkey"), F.lit("."),
                                                      (F.col("c_custkey") % 40).cast("string")))
        .otherwise(F.lit("")).alias("email"),
        F.lit(" 2025-03-04T10:11:12-03:00").alias("cdate"), F.lit("{}").alias("links"),
    )
    fields = table(spark, sf, "region").select(
        text("r_regionkey").alias("id"),
        F.when(F.col("r_regionkey") == 0, F.lit("UTM Campaign"))
        .when(F.col("r_regionkey") == 1, F.lit("UTM  Source!"))
        .when(F.col("r_regionkey") == 2, F.lit(" ")).otherwise(F.col("r_name")).alias("title"),
    )
    values = events.select(
        F.col("user_id").alias("contact"), (F.col("event_id") % 7).alias("field"),
        F.when(F.col("event_id") % 6 != 0, F.col("event_type")).alias("value"), F.col("event_id").alias("pos"),
    )
    tags = table(spark, sf, "nation").select(
        text("n_nationkey").alias("id"), F.col("n_name").alias("tag")
    )
    # tag ids from 25 on have no tag
    contact_tags = orders.select(F.col("o_custkey").alias("contact"), (F.col("o_orderkey") % 30).alias("tag"))
    lists = table(spark, sf, "region").select(
        text("r_regionkey").alias("id"),
        F.when(F.col("r_regionkey") == 4, F.lit(" ")).otherwise(F.col("r_name")).alias("name"),
    )
    contact_lists = orders.select(
        F.col("o_custkey").alias("contact"), (F.col("o_orderkey") % 5).alias("list"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"),
    )
    return {
        "contacts": base, "fields": fields, "field_values": values, "tags": tags,
        "contact_tags": contact_tags, "lists": lists, "contact_lists": contact_lists,
    }


CONTACT_FIELDS = """
    v AS (SELECT user_id, event_id % 7 AS field, event_id AS pos,
                 CASE WHEN event_id % 6 <> 0 THEN event_type END AS value FROM events),
    cf AS (SELECT user_id,
                  min_by(value, pos) FILTER (field = 0 AND value IS NOT NULL) AS cf__utm_campaign,
                  min_by(value, pos) FILTER (field = 1 AND value IS NOT NULL) AS cf__utm_source,
                  min_by(value, pos) FILTER (field = 2 AND value IS NOT NULL) AS cf__field_2,
                  min_by(value, pos) FILTER (field = 3 AND value IS NOT NULL) AS cf__europe_or_so,
                  min_by(value, pos) FILTER (field = 6 AND value IS NOT NULL) AS cf__field_6
           FROM v GROUP BY user_id)
"""


@query(
    "mart_contacts",
    f"""
    WITH {CONTACT_FIELDS},
    t AS (SELECT o_custkey, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS tags
          FROM orders JOIN nation ON o_orderkey % 30 = n_nationkey GROUP BY 1),
    l AS (SELECT o_custkey, string_agg(DISTINCT x, ', ' ORDER BY x) AS lists
          FROM (SELECT o_custkey, CASE WHEN r_regionkey = 4 THEN 'unknown_list' ELSE r_name END ||
                       CASE WHEN o_orderstatus <> 'F' THEN ' [' || o_orderstatus || ']' ELSE '' END AS x
                FROM orders JOIN region ON o_orderkey % 5 = r_regionkey) GROUP BY 1)
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'N' || c_custkey AS "firstName",
           CASE WHEN c_custkey % 8 <> 0 THEN 'm' || c_nationkey || '.' || (c_custkey % 40) ELSE '' END AS email,
           cf__utm_campaign, cf__utm_source, cf__field_2, cf__field_6,
           CASE WHEN tags IS NULL AND c_custkey IN (SELECT o_custkey FROM orders) THEN '' ELSE tags END AS tags, lists
    FROM customer LEFT JOIN cf ON c_custkey = cf.user_id LEFT JOIN t ON c_custkey = t.o_custkey
    LEFT JOIN l ON c_custkey = l.o_custkey
    """,
)
def mart_contacts(spark, sf):
    wide = contacts.build_contacts(contact_inputs(spark, sf))["contacts"]
    return wide.select(
        "id", "firstName", "email", "cf__utm_campaign", "cf__utm_source", "cf__field_2", "cf__field_6",
        "tags", "lists",
    )


@query(
    "mart_contacts_leads",
    f"""
    WITH {CONTACT_FIELDS},
    x AS (SELECT 'N' || c_custkey AS nome_lead_Active, 'm' || c_nationkey || '.' || (c_custkey % 40) AS email_lead_Active,
                 cf__utm_campaign AS utm_campaign_Active, cf__utm_source AS utm_source_Active,
                 CAST(NULL AS VARCHAR) AS utm_medium_Active, CAST(NULL AS VARCHAR) AS utm_content_Active,
                 '2025-03-04' AS cdate_Active
          FROM customer LEFT JOIN cf ON c_custkey = user_id WHERE c_custkey % 8 <> 0)
    SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY email_lead_Active ORDER BY nome_lead_Active) = 1
    """,
)
def mart_contacts_leads(spark, sf):
    return contacts.build_contacts(contact_inputs(spark, sf))["leads"]


# --- social, calls, FX, web ------------------------------------------------------


@query(
    "mart_social",
    """
    SELECT event_type AS pagina, strftime(ts, '%Y-%m-%d') AS data,
           CASE WHEN event_id % 5 <> 0 THEN event_id END AS seguidores,
           CASE WHEN event_id % 5 = 0 THEN 'expired' END AS erro,
           CASE WHEN event_id % 5 = 0 THEN true END AS needs_token_refresh,
           CASE WHEN event_id % 5 = 0 THEN props END AS detalhes
    FROM events
    """,
)
def mart_social(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("pagina"), F.date_format("ts", "yyyy-MM-dd").alias("data"),
        F.col("event_id").alias("seguidores"), "props",
    )
    good = events.where("seguidores % 5 <> 0").drop("props")
    failed = events.where("seguidores % 5 = 0").select(
        "pagina", "data", F.lit(None).cast("bigint").alias("seguidores"), F.lit("expired").alias("erro"),
        F.lit(True).alias("needs_token_refresh"), F.col("props").alias("detalhes"),
    )
    return small.build_social({"page": [good, failed]})["page"]


@query(
    "mart_social_failures",
    "SELECT event_type AS pagina, count(*) AS n FROM events WHERE event_id % 5 = 0 GROUP BY ALL",
)
def mart_social_failures(spark, sf):
    return small.failed_pulls(mart_social(spark, sf)).groupBy("pagina").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mart_calls",
    """
    SELECT CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS "DATA",
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS "AGENDAMENTOS",
           CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey END AS "CALLS REALIZADAS", o_orderstatus AS "OBS"
    FROM orders
    """,
)
def mart_calls(spark, sf):
    key = F.col("o_orderkey")
    feed = table(spark, sf, "orders").select(
        F.when(key % 20 == 0, F.lit("31/02/2025")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("DATA"),
        F.when(key % 3 == 0, F.lit("1.5")).otherwise(text("o_custkey")).alias("AGENDAMENTOS"),
        F.when(key % 4 == 0, F.lit(" ")).otherwise(text("o_orderkey")).alias("CALLS REALIZADAS"),
        F.col("o_orderstatus").alias("OBS"),
    )
    return small.build_calls(feed)


@query(
    "mart_fx",
    """
    WITH d AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, max(o_totalprice) AS usd,
                      min(o_totalprice) AS eur, max(o_orderkey) AS k
               FROM orders GROUP BY 1)
    SELECT '2025-01-01 00:00:00' AS data_extracao, day AS data_referencia, 'BRL' AS moeda_origem,
           unnest(['USD', 'EUR']) AS moeda_destino, 1 AS quantidade, unnest([usd, eur]) AS resultado
    FROM d WHERE k % 4 <> 0
    """,
)
def mart_fx(spark, sf):
    days = (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").cast("string").alias("date"))
        .agg(F.max("o_totalprice").alias("usd"), F.min("o_totalprice").alias("eur"), F.max("o_orderkey").alias("k"))
        .select(
            "date", F.lit("BRL").alias("base"),
            F.when(F.col("k") % 8 != 4, F.col("k") % 4 != 0).alias("success"),
            F.create_map(F.lit("USD"), F.col("usd"), F.lit("EUR"), F.col("eur")).alias("rates"),
        )
    )
    return small.build_fx(days, F.lit("2025-01-01 00:00:00"))


@query(
    "mart_web",
    """
    WITH g AS (SELECT strftime(ts, '%Y%m%d') AS d, event_type, user_id % 3 AS o, count(*) AS n FROM events GROUP BY ALL)
    SELECT 'origem' AS rel, d AS "Data", event_type AS "Campanha", CAST(o AS VARCHAR) AS "Origem",
           CAST(NULL AS VARCHAR) AS "Canal", n AS total FROM g
    UNION ALL SELECT 'paginas', d, event_type, NULL, NULL, n FROM g
    """,
)
def mart_web(spark, sf):
    counted = table(spark, sf, "events").groupBy(
        F.date_format("ts", "yyyyMMdd").alias("d"), "event_type", (F.col("user_id") % 3).cast("string").alias("o")
    ).agg(F.count(F.lit(1)).cast("string").alias("n"))

    def cells(*names):
        return F.array(*[F.struct(F.col(n).alias("value")) for n in names])

    def report(*dims):
        return counted.select(cells(*dims).alias("dimension_values"), cells("n").alias("metric_values"))

    mart = small.build_web({"origem": report("d", "event_type", "o"), "paginas": report("d", "event_type")})
    a = mart["origem"].select(
        F.lit("origem").alias("rel"), "Data", "Campanha", "Origem", "Canal", F.col("Sessões").alias("total")
    )
    b = mart["paginas"].select(
        F.lit("paginas").alias("rel"), "Data", F.col("Título da Página").alias("Campanha"),
        F.lit(None).cast("string").alias("Origem"), F.lit(None).cast("string").alias("Canal"),
        F.col("Visualizações").alias("total"),
    )
    return a.unionByName(b)


@query(
    "mart_sales_a_overlapping_pulls",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS buyer_ucode,
           CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE 'new' END AS buyer_name,
           CASE WHEN c_custkey % 3 = 0 THEN 'd1' ELSE 'd2' END AS document_value
    FROM customer
    """,
)
def mart_sales_a_overlapping_pulls(spark, sf):
    """Two pulls show the same users; the newer one, which lacks a third of them, counts."""
    customer = table(spark, sf, "customer")

    def pull(name, document, rows):
        documents = F.array(F.struct(F.lit(document).alias("value")))
        user = F.struct(text("c_custkey").alias("ucode"), F.lit(name).alias("name"), documents.alias("documents"))
        return rows.select(
            F.array(F.struct(F.lit("BUYER").alias("role"), user.alias("user"))).alias("users"),
            F.col("c_custkey").alias("pos"), F.lit(f"users_2025-0{1 + (name == 'new')}.json").alias("source_file"),
        )

    pulls = pull("old", "d1", customer).unionByName(pull("new", "d2", customer.where("c_custkey % 3 <> 0")))
    return sales_a.buyers(pulls)


@query(
    "mart_contacts_lead_versions",
    """
    SELECT 'N' || c_custkey AS nome_lead_Active, 'm' || c_custkey AS email_lead_Active,
           CASE WHEN c_custkey % 4 = 0 THEN '2024-01-01' ELSE '2025-03-04' END AS cdate_Active
    FROM customer
    """,
)
def mart_contacts_lead_versions(spark, sf):
    """Two versions; the older one, which holds a quarter of the contacts, counts where it has one."""
    def version(rows, day):
        given = {"nome_lead_Active": F.concat(F.lit("N"), text("c_custkey")),
                 "email_lead_Active": F.concat(F.lit("m"), text("c_custkey")), "cdate_Active": F.lit(day)}
        return rows.select([given.get(n, F.lit(None).cast("string")).alias(n) for n in c.CONTACT_LEAD.values()])

    customer = table(spark, sf, "customer")
    both = contacts.leads(version(customer.where("c_custkey % 4 = 0"), "2024-01-01 x"), version(customer, "2025-03-04T10"))
    return both.select("nome_lead_Active", "email_lead_Active", "cdate_Active")
