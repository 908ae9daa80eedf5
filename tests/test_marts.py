"""Each mart from landed files to gold tables, on invented data with the edge rows of its feed."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martkit.catalog import ORACLE, QUERIES, marts
from martkit.operators.incremental import high_watermark, missing_days
from martkit.plans import ads_a, ads_b, contacts, contracts, crm, daily, layers, sales_a, sales_b, small
from martkit.sources.pointed import PointedTable
from martkit.sources.readers import list_files
from tests.helpers import frame, rows
from tests.oracle import connect, differences
from tests.test_files import put

END = dt.datetime(9999, 12, 31, 23, 59, 59)


def land(root, folder, name, value):
    put(str(root / folder), name, value if isinstance(value, str) else json.dumps(value))


def gold(spark, root, name):
    return spark.read.parquet(str(root / "gold" / name))


def test_ads_a(spark, tmp_path):
    def rec(**kw):
        return {"campaign_id": "c1", "campaign_name": "C", "spend": "1.50", "impressions": "10"} | kw

    zero = {"spend": "0", "impressions": "0", "clicks": "0"}
    land(tmp_path, "campaigns", "campaigns_2025-01-01.json", [
        rec(actions=[{"action_type": "lead", "value": "3.0"}, {"action_type": "lead", "value": "9"}]),
        rec(campaign_id="c2", actions=[{"action_type": "purchase", "value": "x"},
                                       {"action_type": "omni_purchase", "value": "7.25"}]),
        rec(campaign_id="idle", **zero),
    ])
    land(tmp_path, "campaigns", "campaigns_2025-01-02.json",
         [rec(campaign_name="C new", spend="2", date_start="2025-01-02", date_stop="2025-01-02")])
    land(tmp_path, "campaigns", "campaigns_2025-01-03.json", [])
    land(tmp_path, "adsets", "adsets_2025-01-01.json",
         [rec(adset_id="s1", adset_name="S"), rec(adset_id="s2", adset_name="S2")])
    land(tmp_path, "targeting", "t.json", [
        {"id": "s1", "targeting": {"custom_audiences": [{"id": "1", "name": "Z"}],
                                   "flexible_spec": [{"custom_audiences": [{"id": "9"}, {"name": "A"}]}]}},
    ])
    land(tmp_path, "ads", "ads_2025-01-01.json", [rec(ad_id=f"a{i}", ad_name=f"A{i}") for i in range(4)])
    land(tmp_path, "creatives", "c.json", [
        {"ad_id": "a0", "creative": {"object_story_spec": {"video_data": {"video_id": "5"}}}},
        {"ad_id": "a1", "creative": {"asset_feed_spec": {"videos": [{}, {"video_id": "6"}]}}},
        {"ad_id": "a2", "creative": {"effective_object_story_id": "1_2"}},
    ])
    land(tmp_path, "media", "m.json", [
        {"id": "5", "permalink_url": "/p/videos/5/", "thumbnails": {"data": [{"uri": "t5"}]}},
        {"id": "1_2", "permalink_url": "", "full_picture": "f"},
    ])
    mart = ads_a.build_ads_a(layers.read_ads_a(spark, str(tmp_path)))
    layers.save(mart, str(tmp_path / "gold"))

    got = gold(spark, tmp_path, "campaigns").select(
        "campaign_id", "date_start", "spend", "impressions", "clicks", "leads", "purchases", "purchase_value")
    assert rows(got) == sorted([
        ("c1", "2025-01-01", 1.5, 10, 0, 3, 0, 0.0), ("c2", "2025-01-01", 1.5, 10, 0, 0, 0, 7.25),
        ("c1", "2025-01-02", 2.0, 10, 0, 0, 0, 0.0),
    ], key=repr)
    assert rows(gold(spark, tmp_path, "dim_camp")) == [("c1", "C new", 2.0), ("c2", "C", 1.5)]
    sets = gold(spark, tmp_path, "adsets").select("adset_id", "publicos_personalizados_incluidos")
    assert rows(sets) == [("s1", "A | Z | CA:9"), ("s2", "")]
    watch = "https://www.facebook.com/watch/?v="
    links = gold(spark, tmp_path, "ads").select("ad_id", *ads_a.VIDEO_COLUMNS)
    post = "https://www.facebook.com/1/posts/2"
    assert rows(links) == [
        ("a0", watch + "5", watch + "5", "t5"), ("a1", watch + "6", watch + "6", ""),
        ("a2", post, post, "f"), ("a3", "", "", ""),
    ]
    assert rows(gold(spark, tmp_path, "dim_adset")) == [("s1", "S"), ("s2", "S2")]
    assert gold(spark, tmp_path, "dim_ad").count() == 4

    names = list_files(spark, str(tmp_path / "campaigns") + "/*.json")
    mark = high_watermark(names, "name", r"campaigns_(\d{4}-\d{2}-\d{2})\.json$")
    assert rows(mark) == [(dt.date(2025, 1, 3),)]
    assert rows(missing_days(mark, F.lit("2025-01-05").cast("date"))) == [
        (dt.date(2025, 1, 4),), (dt.date(2025, 1, 5),)
    ]


def test_ads_b(spark, tmp_path):
    land(tmp_path, "campaigns", "1.csv",
         "data,id_campanha,nome_campanha,tipo_campanha,status_campanha,impressoes,cliques,ctr,cpc_medio,custo,conversoes\n"
         '2025-1-5,7,C,SEARCH,ON,10,x,"1,5",,"1.234,56",2\n')
    land(tmp_path, "campaigns", "2.csv", "")
    land(tmp_path, "groups", "1.csv",
         "data,id_grupo,nome_grupo,status_grupo,id_campanha,impressoes,cliques,ctr,cpc_medio,custo,conversoes\n"
         "2025-01-05,g,G,ON,7,1,1,1,1,1,1\n")
    head = "data,id_campanha,id_grupo,id_anuncio,nome_anuncio,tipo_anuncio,rede,dispositivo,impressoes,cliques,ctr,cpc_medio,custo,conversoes"
    land(tmp_path, "ads", "old.csv", head + "\n2025-01-05,7,g,a1,A,T,SEARCH,MOBILE,1,1,1,1,1,1\n")
    land(tmp_path, "ads", "new.csv", "﻿" + head + ",final_urls,youtube_video_id,youtube_url,thumbnail_url\n"
         "2025-01-06,7,g,a2,B,T,DISPLAY,DESKTOP,2,2,2,2,2,2,u,y,yu,t\n"
         "2025-01-06,7,g,a3,B,T,,DESKTOP,2,2,2,2,2,2,u,y,yu,t\n")
    land(tmp_path, "keywords", "1.csv",
         "data,palavra_chave,tipo_correspondencia,status,criterion_id,grupo_id,campanha_id,impressoes,cliques,custo,conversoes\n"
         "bad,k,EXACT,ON,1,g,7,1,1,1,1\n")
    aud = "data;id_campanha;id_grupo;publicos_do_grupo;faixa_idade;genero;faixa_renda;status_parental;impressoes;cliques;conversoes\n"
    put(str(tmp_path / "audiences"), "1.csv",
        aud + "2025-01-05;7;g; Público B ;18;F;x;y;1.234;12.0;1,5\n"
        "2025-01-05;7;g;NULL;18;F;x;y;None;;\n", "latin-1")
    put(str(tmp_path / "audiences"), "2.csv", aud.replace(";", ",") + "2025-01-05,7,g,Audience A,18,F,x,y,5,6,7\n")
    mart = ads_b.build_ads_b(layers.read_ads_b(spark, str(tmp_path)))
    layers.save(mart, str(tmp_path / "gold"))

    day = dt.date(2025, 1, 5)
    assert rows(gold(spark, tmp_path, "fato_campanha")) == [(day, "7", "ON", 10, 0, 1.5, 0.0, 0.0, 2.0)]
    assert rows(gold(spark, tmp_path, "dim_campanha")) == [("7", "C", "SEARCH")]
    assert rows(gold(spark, tmp_path, "fato_keywords").select("data", "palavra_chave")) == [(None, "k")]
    assert rows(gold(spark, tmp_path, "dim_rede")) == sorted([("DISPLAY", "1"), ("SEARCH", "2"), (None, "3")], key=repr)
    assert rows(gold(spark, tmp_path, "dim_dispositivo")) == [("DESKTOP", "1"), ("MOBILE", "2")]
    ads = gold(spark, tmp_path, "fato_anuncio").select("id_anuncio", "id_rede", "id_dispositivo")
    assert rows(ads) == [("a1", "2", "2"), ("a2", "1", "1"), ("a3", "3", "1")]
    assert rows(gold(spark, tmp_path, "dim_anuncio").select("id_anuncio", "youtube_url")) == sorted(
        [("a1", None), ("a2", "yu"), ("a3", "yu")], key=repr)
    assert rows(gold(spark, tmp_path, "dim_publico_alvo")) == [(0, ""), (1, "Audience A"), (2, "Público B")]
    facts = gold(spark, tmp_path, "fato_publico_alvo").select("id_publico", "impressoes", "cliques", "conversoes")
    assert rows(facts) == [(0, 0, 0, 0.0), (1, 5, 6, 7.0), (2, 1234, 120, 1.5)]
    assert list(gold(spark, tmp_path, "dim_grupoAnuncio").columns) == contracts.DIM_GRUPO


def test_ads_b_writes_no_feed_that_one_table_reads(spark, sf, monkeypatch):
    def refused(df):
        assert "nome_grupo" not in df.columns
        return df

    monkeypatch.setattr(ads_b, "written", refused)
    mart = marts.ads_b_mart(spark, sf, "dim_grupoAnuncio", "fato_anuncio")
    assert mart["dim_grupoAnuncio"].count() == mart["dim_grupoAnuncio"].select("id_grupo").distinct().count()
    with pytest.raises(AssertionError):
        marts.ads_b_mart(spark, sf, "dim_grupoAnuncio", "fato_grupoAnuncio")


def test_crm(spark, tmp_path):
    def move(i, deal, ts, **kw):
        land(tmp_path, "moves", f"{i}.json", {"event_type": "move", "deal_id": deal, "pipeline_id": 1,
                                              "timestamp": ts, "title": str(i)} | kw)

    move(1, 10, "2025-01-05T10:11:12.123+00:00", old_value=1, new_value=2, person_id=5, value="12.5")
    move(2, 10, "2025-01-06T10:11:12Z", old_stage_id=2, new_stage_id=3, person_id=6, value="n/a", owner_id=9)
    move(3, 10, "2025-01-06 10:11:12", person_id=None)
    move(4, 11, "soon")
    land(tmp_path, "moves", "5.json", {"event_type": "move", "deal_id": None, "title": "5"})
    land(tmp_path, "persons", "5.json", {"id": 5, "name": "P", "email": [{"value": "p@x"}, {"value": "q"}],
                                         "phone": [], "fields": {"h1": "camp", "utm_source": "s", "zz": "1"}})
    land(tmp_path, "persons", "6.json", {"id": 6, "name": "Q", "email": None})
    land(tmp_path, "person_fields", "f.json", [{"key": "h1", "name": "UTM Campaign"}, {"key": "zz", "name": "Other"}])
    land(tmp_path, "deals", "d.json", [{"id": 10, "status": "open"}, {"id": 11, "status": "deleted"}, {"id": None}])
    stage = {"stage_id": 1, "stage_name": "Won", "stage_order_nr": 1, "pipeline_id": 1, "pipeline_name": "Funnel"}
    land(tmp_path, "stages", "all_20250101_000000.json", [stage, stage, {"stage_id": 8, "stage_name": "Lost"}])
    land(tmp_path, "stages", "all_20250102_000000.json", [stage | {"stage_id": 4}])
    mart = crm.build_crm(layers.read_crm(spark, str(tmp_path)))
    layers.save(mart, str(tmp_path / "gold"))

    assert mart["silver_moves"].columns == contracts.MOVE_COLUMNS
    assert {d for _, d in mart["silver_moves"].dtypes} == {"string"}
    fact = gold(spark, tmp_path, "ft_move")
    assert not {"owner_id", "fk_allstages", "deal_ativo"} & set(fact.columns)
    got = fact.select("title", "deal_id", "old_stage_id", "new_stage_id", "value", "date", "utm_campaign",
                      "utm_source", "comment", "flag_deal_ativo", "flg_ultimo_movimento")
    five, six = dt.date(2025, 1, 5), dt.date(2025, 1, 6)
    assert rows(got) == [
        ("1", 10, 1, 2, 12.5, five, "camp", "s", "", 1, 0),
        ("2", 10, 2, 3, None, six, "", "", "", 1, 1),
        ("3", 10, None, None, None, six, "", "", "", 1, 1),
        ("4", 11, None, None, None, None, "", "", "", 0, None),
        ("5", None, None, None, None, None, "", "", "", 0, None),
    ]
    silver = mart["silver_moves"].select("title", "fk_allstages", "deal_ativo")
    assert rows(silver)[:4] == [("1", "2|1", "1"), ("2", "3|1", "1"), ("3", None, "1"), ("4", None, "1")]
    assert rows(gold(spark, tmp_path, "dim_person")) == [(5, "P", "p@x", None), (6, "Q", None, None)]
    assert rows(gold(spark, tmp_path, "dim_pipeline")) == [(1, "Funnel")]
    assert rows(gold(spark, tmp_path, "dim_stage")) == [(1, "Won", 1), (4, "Won", 1)]
    assert gold(spark, tmp_path, "rejected_stages").count() == 1
    history = gold(spark, tmp_path, "scd2_dim_stage")
    one, two = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    assert rows(history.select("stage_id", "dt_inicio_vigencia", "dt_fim_vigencia", "pk_allstages")) == [
        (1, one, two, "1|1"), (4, two, END, "4|1")
    ]
    layers.run_crm(spark, str(tmp_path), str(tmp_path / "silver"), str(tmp_path / "gold2"))
    again = spark.read.parquet(str(tmp_path / "gold2" / "ft_move"))
    assert again.columns == fact.columns and rows(again) == rows(fact)
    remapped = crm.remap_stages(
        frame(spark, "old_stage_id long, new_stage_id long, pipeline_id long", (1, 4, 3), (9, 1, 3), (None, 2, 3)),
        history,
    )
    assert rows(remapped) == sorted([(4, 4, 3), (9, 4, 3), (None, 2, 3)], key=repr)


def test_sales_a(spark, tmp_path):
    def sale(tx, ms, **kw):
        return {"purchase": {"transaction": tx, "approved_date": ms, "price": {"value": 10.0, "currency_code": "BRL"}},
                "buyer": {"ucode": "u1", "name": "N"}, "product": {"id": 1, "name": "P"}} | kw

    land(tmp_path, "sales", "s.json", {"total_vendas": 4, "dados": [
        sale("t1", 1736046000000), sale("t1", 1736046000001, product={"id": 1, "name": "later"}),
        sale(None, 1735689600000), {"purchase": None, "buyer": None},
    ]})
    user = {"ucode": "u1", "name": "N"}
    land(tmp_path, "users", "u.json", {"dados": [
        {"users": [{"role": "PRODUCER", "user": {"ucode": "p"}},
                   {"role": "BUYER", "user": user | {"documents": [{"value": None}, {"value": "d1"}]}}]},
        {"users": [{"role": "BUYER", "user": user | {"name": "Later", "documents": [{"value": "d2"}]}}]},
        {"users": [{"role": "BUYER", "user": {"ucode": "u2", "name": "M", "documents": []}}]},
        {"users": None},
    ]})
    layers.run_mart(spark, "sales_a", str(tmp_path), str(tmp_path / "gold"))
    sales = gold(spark, tmp_path, "sales")
    assert sales.columns == [*contracts.SALES_PATHS, "approved_datetime_utc", "approved_datetime_brt", "approved_datetime_br"]
    got = rows(sales.select("product_name", "price_value", "hotmart_fee_total", "approved_datetime_br"))
    assert got == sorted([
        ("later", 10.0, None, "05/01/2025 00:00:00"), ("P", 10.0, None, "31/12/2024 21:00:00"),
        (None, None, None, None),
    ], key=repr)
    assert rows(gold(spark, tmp_path, "users")) == [("u1", "N", "d1"), ("u2", "M", None)]


def test_pulls_land_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(marts, "PULL_RECORDS", 10)
    records = spark.range(1200).select(F.col("id").alias("pos"), F.col("id").alias("x"), (F.col("id") % 300).alias("owner"))
    day = F.when(F.col("pos") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
    marts.land_pulls(records, str(tmp_path), day, F.col("owner"))
    pulls = [json.loads(f.read_text())["dados"] for f in sorted(tmp_path.rglob("*.json"))]
    assert max(map(len, pulls)) <= 240
    assert all([r["x"] for r in p] == sorted(r["x"] for r in p) for p in pulls)
    assert sorted(r["x"] for p in pulls for r in p) == list(range(1200))
    owners = [o for p in pulls for o in {r["owner"] for r in p}]
    assert len(owners) == len(set(owners)) == 300


def test_sales_a_daily_over_many_files(spark, sf, monkeypatch):
    monkeypatch.setattr(marts, "PULL_RECORDS", 30)
    assert differences(QUERIES["mart_sales_a_daily"](spark, sf), connect(sf), ORACLE["mart_sales_a_daily"]) is None


def test_unique_users(spark):
    df = frame(
        spark, "id string, email string, role string, pos long",
        ("7", "a@x", "BUYER", 1), ("7", "b@x", "BUYER", 2), (None, "C@x", "BUYER", 3), (None, "c@x", "BUYER", 4),
        (None, None, "BUYER", 5), (None, "", "BUYER", 6), ("7", "a@x", "SELLER", 7),
    )
    assert rows(sales_a.unique_users(df).select("pos")) == [(2,), (4,), (5,), (6,), (7,)]


def sales_b_csv(rows_):
    cols = list(dict.fromkeys([
        x for x in [*contracts.F_VENDAS, *contracts.DIM_CLIENTE, *contracts.DIM_OFERTA, *contracts.DIM_PRODUTO,
                    contracts.AFFILIATE_COLUMN] if x not in ("ID_Cliente", "ID_Afiliado")
    ]))
    return ",".join(cols) + "\n" + "\n".join(",".join(str(r.get(x, "-")) for x in cols) for r in rows_) + "\n"


def test_sales_b(spark, tmp_path):
    base = {"ID Venda": 1, "Nome do comprador": "N", "Email do comprador": "e", "Nome Afiliado": ""}
    land(tmp_path, "sales", "s.csv", sales_b_csv([
        base, base | {"ID Venda": 2, "Nome Afiliado": "Af"}, base | {"ID Venda": 3, "Nome do comprador": ""},
        base | {"ID Venda": 445793}, base | {"ID Venda": "x"},
    ]))
    land(tmp_path, "projection", "p.csv", 'Mês,Valor Total\njan/2025,"R$ 1.234,56"\nFEV/2025,"R$ 1,00"\nxyz/2025,2\n')
    mart = sales_b.build_sales_b(layers.read_sales_b(spark, str(tmp_path)))
    layers.save(mart, str(tmp_path / "gold"))
    fact = gold(spark, tmp_path, "f_vendas")
    assert fact.columns == contracts.F_VENDAS and len(fact.columns) == 35
    client = hashlib.md5(b"Ne").hexdigest()
    none, af = hashlib.md5(b"").hexdigest(), hashlib.md5(b"Af").hexdigest()
    assert rows(fact.select("ID Venda", "ID_Cliente", "ID_Afiliado")) == [(1, client, none), (2, client, af)]
    assert rows(gold(spark, tmp_path, "dim_afiliado")) == sorted([(none, None), (af, "Af")], key=repr)
    assert gold(spark, tmp_path, "dim_cliente").count() == 1
    assert rows(gold(spark, tmp_path, "projetadas")) == sorted([
        ("01/01/2025", Decimal("1234.56")), ("01/02/2025", Decimal("1.00")), (None, Decimal("2.00")),
    ], key=repr)
    assert len(contracts.F_PROJECAO) == 24
    bad = frame(spark, "`Mês` string, `Valor Total` string", ("jan/2025", "dez reais"))
    with pytest.raises(PySparkException, match="not an amount"):
        sales_b.projected(bad).collect()


def test_contacts(spark, tmp_path):
    def one(folder, value):
        land(tmp_path, folder, "x.json", value)

    one("contacts", [
        {"id": "1", "firstName": "A", "email": "a@x", "cdate": "2025-03-04T10:11:12-03:00"},
        {"id": "2", "firstName": "B", "email": "a@x", "cdate": " 2025-03-05T00:00:00"},
        {"id": "3", "firstName": "C", "email": ""},
    ])
    one("fields", [{"id": "1", "title": "UTM Campaign"}, {"id": "2", "title": " "}])
    one("field_values", {"fieldValues": [
        {"contact": "1", "field": "1", "value": "first"}, {"contact": "1", "field": "1", "value": "second"},
        {"contact": "1", "field": "2", "value": "blank title"}, {"contact": "2", "field": "9", "value": "unknown"},
    ]})
    one("tags", [{"id": "1", "tag": "vip"}, {"id": "2", "tag": " new "}])
    one("contact_tags", [{"contact": "1", "tag": t} for t in ("1", "2", "1", "404")])
    one("lists", [{"id": "1", "name": "News"}, {"id": "2", "name": ""}])
    one("contact_lists", [{"contact": "1", "list": "1", "status": "1"}, {"contact": "1", "list": "2"},
                          {"contact": "2", "list": "404", "status": "2"}])
    mart = contacts.build_contacts(layers.read_contacts(spark, str(tmp_path)))
    wide = mart["contacts"].select("id", "cf__utm_campaign", "cf__field_2", "cf__field_9", "tags", "lists")
    assert rows(wide) == sorted([
        ("1", "first", "blank title", None, "new, vip", "News [1], unknown_list"),
        ("2", None, None, "unknown", None, "unknown_list [2]"), ("3", None, None, None, None, None),
    ], key=repr)
    leads = mart["leads"]
    assert leads.columns == list(contracts.CONTACT_LEAD.values())
    assert [tuple(r)[:3] + (r["cdate_Active"],) for r in leads.collect()] == [("A", "a@x", "first", "2025-03-04")]
    older = frame(
        spark, "nome_lead_Active string, email_lead_Active string, umt_campaign_Active string, "
        "utm_source_Active string, utm_medium_Active string, utm_content_Active string, cdate_Active string",
        ("Old", "a@x", "o", None, None, None, "2024-01-01 x"),
    )
    both = contacts.leads(older, leads)
    assert [(r["nome_lead_Active"], r["utm_campaign_Active"]) for r in both.collect()] == [("Old", "o")]


def test_social_calls_fx_web(spark, tmp_path):
    land(tmp_path, "pages", "2025-01-01.json", {"pagina": "P", "data": "2025-01-01", "seguidores": 5})
    land(tmp_path, "pages", "2025-01-02.json", [{"pagina": "P", "data": "2025-01-02", "seguidores": None,
                                                 "erro": "token", "needs_token_refresh": True, "detalhes": {"c": 1}}])
    land(tmp_path, "accounts", "a.json", {"conta": "C", "data": "2025-01-01", "seguidores": 7})
    land(tmp_path, "channels", "c.json", [{"data": "2025-01-01", "canal": "K", "inscritos": 1, "visualizacoes": 2}])
    social = small.build_social(layers.read_social(spark, str(tmp_path)))
    assert rows(social["pages"].select("data", "seguidores", "erro", "detalhes")) == [
        ("2025-01-01", 5, None, None), ("2025-01-02", None, "token", '{"c": 1}')
    ]
    assert small.failed_pulls(social["pages"]).count() == 1
    assert rows(social["channels"]) == [("2025-01-01", "K", 1, 2)]

    land(tmp_path, "calls", "c.csv", "DATA,AGENDAMENTOS,CALLS REALIZADAS,OBS\n05/01/2025,3,1.5,x\n31/02/2025,,4,\n")
    assert rows(small.build_calls(layers.read_calls(spark, str(tmp_path)))) == sorted(
        [(dt.date(2025, 1, 5), 3, None, "x"), (None, None, 4, None)], key=repr)

    land(tmp_path, "fx", "2025-01-01.json", {"success": True, "base": "BRL", "date": "2025-01-01", "rates": {"USD": 0.2, "EUR": 0.1}})
    land(tmp_path, "fx", "2025-01-02.json", {"success": False, "base": "BRL", "date": "2025-01-02", "rates": {"USD": 9}})
    land(tmp_path, "fx", "2025-01-03.json", {"success": True, "base": "BRL", "date": "2025-01-03", "rates": {}})
    fx = small.build_fx(layers.read_fx(spark, str(tmp_path)), F.lit("now"))
    assert fx.columns == contracts.FX_COLUMNS
    assert rows(fx) == [("now", "2025-01-01", "BRL", "EUR", 1, 0.1), ("now", "2025-01-01", "BRL", "USD", 1, 0.2)]

    def answer(*dims):
        return {"rows": [{"dimension_values": [{"value": d} for d in dims], "metric_values": [{"value": "4"}]}]}

    land(tmp_path, "eventos", "e.json", answer("20250101", "click"))
    land(tmp_path, "origem", "o.json", answer("20250101", "camp", "src"))
    land(tmp_path, "paginas", "p.json", answer("20250101", "Home"))
    web = small.build_web(layers.read_web(spark, str(tmp_path)))
    assert rows(web["eventos"]) == [("20250101", "click", 4)]
    assert rows(web["origem"]) == [("20250101", "camp", "src", None, 4)]
    assert web["paginas"].columns == ["Data", "Título da Página", "Visualizações"]


def test_outputs_survive_a_second_run(spark, tmp_path):
    land(tmp_path, "calls", "c.csv", "DATA,AGENDAMENTOS,CALLS REALIZADAS\n05/01/2025,3,1\n")
    for _ in range(2):
        layers.run_mart(spark, "calls", str(tmp_path), str(tmp_path / "gold"))
    assert gold(spark, tmp_path, "calls").count() == 1
    assert os.path.isdir(tmp_path / "gold" / "calls")


def test_run_mart_takes_every_mart_and_writes_rejects(spark, tmp_path):
    land(tmp_path, "moves", "m.json", [
        {"deal_id": "7", "timestamp": "2025-01-01 00:00:00"}, {"deal_id": "7", "timestamp": "2025-01-02 00:00:00"},
    ])
    land(tmp_path, "persons", "p.json", [{"id": 5, "name": "P"}, {"id": "x", "name": "Q"}, {"id": 6, "name": "R"}])
    land(tmp_path, "person_fields", "f.json", [{"key": "k", "name": "n"}])
    land(tmp_path, "deals", "d.json", [{"id": 7, "status": "open"}])
    land(tmp_path, "stages", "s_20250101_000000.json", [
        {"stage_id": 1, "stage_name": "Won", "pipeline_id": 1, "pipeline_name": "Funnel", "stage_order_nr": 1},
    ])
    layers.run_mart(spark, "crm", str(tmp_path), str(tmp_path / "gold"))
    assert rows(gold(spark, tmp_path, "ft_move").select("flg_ultimo_movimento")) == [(0,), (1,)]
    assert rows(gold(spark, tmp_path, "dim_person").select("id")) == [(5,), (6,)]
    left_out = gold(spark, tmp_path, "rejects").collect()
    assert [(os.path.basename(r["source_file"]), r["reason"]) for r in left_out] == [("p.json", "wrong type: id")]


def test_snapshot_without_time_stops_the_history(spark):
    df = frame(spark, "stage_id long, stage_name string, pipeline_id long, pipeline_name string, stage_order long, snapshot_time timestamp_ntz",
               (1, "a", 1, "p", 1, None))
    with pytest.raises(PySparkException, match="no snapshot_time"):
        crm.scd2_dim_stage(df).collect()


def test_daily_moves_after_a_failed_run(spark, tmp_path, monkeypatch):
    """A run that stops before its control entry is written again by the next one, with nothing lost or doubled."""
    persons = frame(spark, "id bigint, fields map<string,string>", (1, {"utm_campaign": "c"}))
    names, deals = frame(spark, "key string, name string"), frame(spark, "id bigint, status string", (7, "open"))

    def deliver(name, *lines):
        (tmp_path / "feed").mkdir(exist_ok=True)
        (tmp_path / "feed" / name).write_text("\n".join(lines))

    def move(title, hour, deal="7"):
        return f'{{"deal_id": "{deal}", "title": "{title}", "person_id": "1", "timestamp": "2025-01-01T{hour:02}:00:00+00:00"}}'

    def run(version):
        return daily.run_moves(
            spark, str(tmp_path / "feed"), str(tmp_path / "silver"), str(tmp_path / "gold"), version, persons, names, deals
        )

    def stop(*_, **__):
        raise RuntimeError("stopped")

    deliver("a.json", move("a", 1), move("b", 2), "half a rec", move("other", 1, "8"))
    with monkeypatch.context() as m:
        m.setattr(PointedTable, "replace", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run("20250101_000000")
    deliver("b.json", move("c", 3))
    assert run("20250102_000000") == ["20250101_000000", "20250102_000000"]
    assert run("20250103_000000") == []
    fact = daily.read_moves(spark, str(tmp_path / "gold"))
    got = fact.select("title", "flg_ultimo_movimento", "flag_deal_ativo", "utm_campaign", "load_ts").collect()
    assert sorted(map(tuple, got)) == [
        ("a", 0, 1, "c", "20250101_000000"), ("b", 0, 1, "c", "20250101_000000"),
        ("c", 1, 1, "c", "20250102_000000"), ("other", 1, 0, "c", "20250101_000000"),
    ]
    rejects = spark.read.parquet(str(tmp_path / "gold" / "ft_move_rejects"))
    assert [r[0] for r in rejects.collect()] == ["half a rec"]
