"""Column lists and read schemas (DDL) of the feeds and gold tables.

Business column names are kept as the feeds spell them.
"""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


# ads A
INSIGHT_DOUBLES = ["spend", "ctr", "cpc", "frequency", "cost_per_unique_click"]
INSIGHT_LONGS = ["impressions", "clicks", "reach"]
ACTIONS = {"leads": "lead", "purchases": "purchase"}
ACTION_VALUES = {"purchase_value": "omni_purchase"}
ADS_A_DIM_CAMP = ["campaign_id", "campaign_name", "spend"]
ADS_A_DIM_ADSET = ["adset_id", "adset_name"]
ADS_A_DIM_AD = ["ad_id", "ad_name"]
ADS_A_DIM_ALIASES = {"id": "campaign_id", "name": "campaign_name"}
_INSIGHT = (
    "date_start string, date_stop string, spend string, impressions string, clicks string, "
    "ctr string, cpc string, reach string, frequency string, cost_per_unique_click string, "
    "actions array<struct<action_type:string,value:string>>"
)
ADS_A_CAMPAIGN = ("campaign_id string, campaign_name string, " + _INSIGHT)
ADS_A_ADSET = (
    "adset_id string, adset_name string, campaign_id string, campaign_name string, " + _INSIGHT
)
ADS_A_AD = ("ad_id string, ad_name string, campaign_id string, adset_id string, " + _INSIGHT)
ADS_A_TARGETING = (
    "id string, name string, targeting struct<custom_audiences:array<struct<id:string,name:string>>,"
    "flexible_spec:array<struct<custom_audiences:array<struct<id:string,name:string>>>>>"
)
ADS_A_CREATIVE = (
    "ad_id string, creative struct<effective_object_story_id:string,object_story_id:string,"
    "asset_feed_spec:struct<videos:array<struct<video_id:string>>>,"
    "object_story_spec:struct<video_data:struct<video_id:string>>>"
)
ADS_A_MEDIA = (
    "id string, permalink_url string, picture string, full_picture string, "
    "thumbnails struct<data:array<struct<uri:string>>>"
)

# ads B
ADS_B_INTS = ["impressoes", "cliques"]
ADS_B_FLOATS = ["ctr", "cpc_medio", "custo", "conversoes"]
ADS_B_AUDIENCE_FLOATS = ["conversoes"]
ADS_B_AD_COLUMNS = [
    "data", "id_campanha", "id_grupo", "id_anuncio", "nome_anuncio", "tipo_anuncio", "rede", "id_rede",
    "dispositivo", "id_dispositivo", "impressoes", "cliques", "ctr", "cpc_medio", "custo", "conversoes",
    "final_urls", "youtube_video_id", "youtube_url", "thumbnail_url",
]
DIM_ANUNCIO = [
    "id_anuncio", "nome_anuncio", "tipo_anuncio", "final_urls", "youtube_video_id", "youtube_url", "thumbnail_url",
]
DIM_CAMPANHA = ["id_campanha", "nome_campanha", "tipo_campanha"]
DIM_DISPOSITIVO = ["dispositivo", "id_dispositivo"]
DIM_GRUPO = ["id_grupo", "nome_grupo"]
DIM_REDE = ["rede", "id_rede"]
DIM_PUBLICO = ["id_publico", "publicos_do_grupo"]
FATO_CAMPANHA = [
    "data", "id_campanha", "status_campanha", "impressoes", "cliques", "ctr", "cpc_medio", "custo", "conversoes",
]
FATO_GRUPO = [
    "data", "id_grupo", "status_grupo", "id_campanha", "impressoes", "cliques", "ctr", "cpc_medio", "custo",
    "conversoes",
]
FATO_KEYWORDS = [
    "data", "palavra_chave", "tipo_correspondencia", "status", "criterion_id", "grupo_id", "campanha_id",
    "impressoes", "cliques", "custo", "conversoes",
]
FATO_ANUNCIO = [
    "data", "id_campanha", "id_grupo", "id_anuncio", "id_rede", "id_dispositivo", "impressoes", "cliques", "ctr",
    "cpc_medio", "custo", "conversoes",
]
FATO_PUBLICO = [
    "data", "id_campanha", "id_grupo", "id_publico", "faixa_idade", "genero", "faixa_renda", "status_parental",
    "impressoes", "cliques", "conversoes",
]

# CRM
MOVE_COLUMNS = [
    "event_type", "deal_id", "pipeline_id", "old_stage_id", "new_stage_id", "title", "value", "currency",
    "person_id", "owner_id", "status", "pipeline_name", "movement_type", "comment", "timestamp", "email",
    "utm_campaign", "utm_source", "utm_medium", "utm_content", "fk_allstages", "deal_ativo",
]
MOVE_RENAMES = {"old_value": "old_stage_id", "new_value": "new_stage_id"}
MOVE_INTS = ["deal_id", "pipeline_id", "old_stage_id", "new_stage_id", "person_id", "deal_ativo"]
MOVE_FLOATS = ["value"]
MOVE_TIMES = ["timestamp"]
MOVE_DROPPED = ["owner_id", "fk_allstages"]
UTM_COLUMNS = ["utm_campaign", "utm_source", "utm_medium", "utm_content"]
UTM_ALIASES = {c.replace("_", " "): c for c in UTM_COLUMNS}
MOVE_EVENT = (
    "event_type string, deal_id string, pipeline_id string, old_value string, new_value string, "
    "old_stage_id string, new_stage_id string, title string, value string, currency string, "
    "person_id string, owner_id string, status string, pipeline_name string, "
    "movement_type string, comment string, timestamp string, email string"
)
PERSON = (
    "id bigint, name string, email array<struct<value:string>>, phone array<struct<value:string>>"
)
STAGE_FIELDS = ["stage_id", "stage_name", "stage_order_nr", "pipeline_id", "pipeline_name"]
STAGE = (
    "stage_id bigint, stage_name string, stage_order_nr int, pipeline_id bigint, "
    "pipeline_name string"
)
STAGE_KEY = ["stage_name", "pipeline_id", "stage_order_nr"]
STAGE_TRACKED = ["stage_id", "pipeline_name"]
DIM_PERSON = ["id", "name", "email", "phone"]
DIM_PIPELINE = ["pipeline_id", "pipeline_name"]
DIM_STAGE = ["stage_id", "stage_name", "stage_order_nr"]

# sales A
SALES_PATHS = {
    "approved_date": "purchase.approved_date",
    "buyer_ucode": "buyer.ucode",
    "buyer_name": "buyer.name",
    "buyer_email": "buyer.email",
    "price_value": "purchase.price.value",
    "price_currency_code": "purchase.price.currency_code",
    "payment_method": "purchase.payment.method",
    "payment_type": "purchase.payment.type",
    "payment_installments_number": "purchase.payment.installments_number",
    "hotmart_fee_total": "purchase.hotmart_fee.total",
    "hotmart_fee_currency_code": "purchase.hotmart_fee.currency_code",
    "hotmart_fee_base": "purchase.hotmart_fee.base",
    "hotmart_fee_fixed": "purchase.hotmart_fee.fixed",
    "hotmart_fee_percentage": "purchase.hotmart_fee.percentage",
    "product_id": "product.id",
    "product_name": "product.name",
}
SALES_A_RECORD = (
    "purchase struct<transaction:string,approved_date:bigint,"
    "price:struct<value:double,currency_code:string>,"
    "payment:struct<method:string,type:string,installments_number:int>,"
    "hotmart_fee:struct<total:double,currency_code:string,base:double,fixed:double,"
    "percentage:double>>, "
    "buyer struct<ucode:string,name:string,email:string>, product struct<id:bigint,name:string>"
)
USERS_A_RECORD = (
    "users array<struct<role:string,user:struct<ucode:string,name:string,email:string,"
    "documents:array<struct<type:string,value:string>>>>>"
)
BUYER_ROLE = "BUYER"

# sales B
BUYER_COLUMNS = ["Nome do comprador", "Email do comprador"]
AFFILIATE_COLUMN = "Nome Afiliado"
TEST_SALES = [445793, 445784]
DIM_AFILIADO = ["ID_Afiliado", "Nome Afiliado"]
DIM_CLIENTE = [
    "Nome do comprador", "Email do comprador", "Número de telefone", "Endereço físico", "ID_Cliente", "CPF/CNPJ",
]
DIM_OFERTA = ["ID Oferta", "Nome da oferta"]
DIM_PRODUTO = ["ID Produto", "Nome do produto", "Categoria", "Tipo do produto"]
F_VENDAS = [
    "ID Venda", "Data da venda", "Data de pagamento", "Data de vencimento do boleto", "Data liberação do saldo",
    "ID Produto", "ID Oferta", "Método de pagamento", "Forma de pagamento", "Cupom", "Valor Oferta", "Valor Pago",
    "Taxa Voomp", "Valor comissão afiliado", "Valor comissão co-produtor", "Valor Recebido", "Status da venda",
    "Motivo do reembolso", "Motivo da recusa", "Venda inteligente", "Tipo de cobrança", "ID Contrato",
    "Status de Contrato", "Período", "Recorrência atual", "Recorrência total", "Assinaturas em atraso (dias)",
    "Nota fiscal", "Order Bump", "UF Origem", "Taxa de câmbio", "Link Boleto", "Cod. de Barras", "ID_Afiliado",
    "ID_Cliente",
]
F_PROJECAO = [
    "ID Venda", "Data Prevista de Pagamento", "ID Produto", "ID Oferta", "Método de pagamento",
    "Forma de pagamento", "Cupom", "Valor a pagar", "Taxa Voomp", "Valor comissão afiliado",
    "Valor comissão co-produtor", "Taxa de parcelamento do cliente", "Valor a receber", "Status da venda",
    "Venda inteligente", "Tipo de cobrança", "ID Contrato", "Período", "Recorrência atual", "Recorrência total",
    "Order Bump", "UF Origem", "ID_Afiliado", "ID_Cliente",
]

# social
SOCIAL_PAGE = (
    "pagina string, data string, seguidores bigint, erro string, "
    "needs_token_refresh boolean, detalhes string"
)
SOCIAL_ACCOUNT = ("conta string, data string, seguidores bigint")
SOCIAL_CHANNEL = ("data string, canal string, inscritos bigint, visualizacoes bigint")

# calls
CALLS_DATE = "DATA"
CALLS_INTS = ["AGENDAMENTOS", "CALLS REALIZADAS"]

# FX
FX = ("success boolean, base string, date string, rates map<string,double>")
FX_COLUMNS = [
    "data_extracao", "data_referencia", "moeda_origem", "moeda_destino", "quantidade", "resultado",
]

# contacts
CONTACT_LEAD = {
    "firstName": "nome_lead_Active",
    "email": "email_lead_Active",
    "cf__utm_campaign": "utm_campaign_Active",
    "cf__utm_source": "utm_source_Active",
    "cf__utm_medium": "utm_medium_Active",
    "cf__utm_content": "utm_content_Active",
    "cdate": "cdate_Active",
}
CONTACT_LEAD_ALIASES = {"umt_campaign_Active": "utm_campaign_Active"}

# web analytics
WEB_ROW = (
    "rows array<struct<dimension_values:array<struct<value:string>>,"
    "metric_values:array<struct<value:string>>>>"
)
WEB_REPORTS = {
    "eventos": (["Data", "Evento"], ["Total"]),
    "origem": (["Data", "Campanha", "Origem", "Canal"], ["Sessões"]),
    "paginas": (["Data", "Título da Página"], ["Visualizações"]),
}
