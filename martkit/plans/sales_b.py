"""Sales B mart: sales export to hashed keys, four dimensions and the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martkit.functions.dates import pt_month_to_date_text
from martkit.functions.keys import md5_key
from martkit.functions.numbers import brl_to_decimal, to_long
from martkit.operators.filters import exclude_ids, require_not_null
from martkit.operators.project import q
from martkit.operators.star import build_dim, build_fact
from martkit.plans import contracts as c


def silver(export: DataFrame) -> DataFrame:
    """Sales with a known buyer, keyed by hash, without the test sales."""
    df = require_not_null(export, c.BUYER_COLUMNS).withColumns(
        {
            "ID Venda": to_long(q("ID Venda")),
            "ID_Cliente": md5_key(*[q(x) for x in c.BUYER_COLUMNS]),
            "ID_Afiliado": md5_key(q(c.AFFILIATE_COLUMN)),
        }
    )
    return exclude_ids(df, "ID Venda", c.TEST_SALES)


def projected(feed: DataFrame) -> DataFrame:
    """Projected revenue: month as date text, amount as decimal."""
    return feed.select(
        pt_month_to_date_text(q("Mês")).alias("Data"),
        brl_to_decimal(q("Valor Total")).alias("Valor"),
    )


def f_projecao(feed: DataFrame) -> DataFrame:
    """Projection fact, for exports that still carry the projection sheet."""
    return build_fact(silver(feed), c.F_PROJECAO)


def build_sales_b(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``sales`` and ``projection`` exports (text) to the tables of the mart."""
    rows = silver(inputs["sales"])
    return {
        "dim_afiliado": build_dim(rows, c.DIM_AFILIADO),
        "dim_cliente": build_dim(rows, c.DIM_CLIENTE),
        "dim_oferta": build_dim(rows, c.DIM_OFERTA),
        "dim_produto": build_dim(rows, c.DIM_PRODUTO),
        "f_vendas": build_fact(rows, c.F_VENDAS),
        "projetadas": projected(inputs["projection"]),
    }


