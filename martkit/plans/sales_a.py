"""Sales A mart: nested sales and user records to flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import br_text, epoch_ms_to_ts, fixed_offset
from martkit.functions.keys import fallback_key
from martkit.operators.aggregate import first_per_group
from martkit.operators.dedup import last_wins
from martkit.operators.explode import explode_children, flatten_paths
from martkit.operators.spread import left_lookup
from martkit.plans import contracts as c


def _place(df: DataFrame) -> list[str]:
    """What orders the records: the pull's file, where the reader kept it, then the position."""
    return [x for x in ("source_file", "pos") if x in df.columns]


def _newest_first(df: DataFrame) -> list[Column]:
    return [F.col(x).desc() for x in _place(df)]


def unique_sales(records: DataFrame) -> DataFrame:
    """The newest copy of each transaction over overlapping pulls."""
    keyed = records.withColumn("__tx", F.col("purchase.transaction"))
    return last_wins(keyed, "__tx", _newest_first(records)).drop("__tx")


def unique_users(users: DataFrame) -> DataFrame:
    """The newest copy of each user: by id, else by e-mail, within the role."""
    key = fallback_key(F.col("role"), id=F.col("id"), email=F.lower("email"))
    return last_wins(users.withColumn("__key", key), "__key", _newest_first(users)).drop("__key")


def sales(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat sales with the approval time in UTC, at UTC-3 and as local text; columns of ``keep`` stay."""
    df = flatten_paths(records, {**c.SALES_PATHS, **{k: k for k in keep}})
    if "approved_datetime_utc" not in df.columns:
        df = df.withColumn("approved_datetime_utc", epoch_ms_to_ts(F.col("approved_date")))
    local = fixed_offset(F.col("approved_datetime_utc"))
    return df.withColumns({"approved_datetime_brt": local, "approved_datetime_br": br_text(local)})


def buyers(records: DataFrame, with_pull: bool = False) -> DataFrame:
    """One row per buyer: first name, first document that has a value, of the newest pull that shows the buyer.

    The order is that of the records and of the entries inside each. Pulls are
    told apart by their file, where the reader kept it; ``with_pull`` adds it.
    """
    placed = records.withColumn("record", F.struct(*_place(records))).drop("pos")
    rows = explode_children(
        placed,
        "users",
        keep=lambda u: u["role"] == c.BUYER_ROLE,
        child=lambda u: u["user"]["documents"],
        parent_cols={
            "buyer_ucode": lambda u: u["user"]["ucode"],
            "buyer_name": lambda u: u["user"]["name"],
        },
        child_cols={"document_value": lambda d: d["value"]},
        carry=["record"],
    )
    if "source_file" in records.columns:
        rows = rows.withColumn("__pull", F.col("record.source_file"))
        newest = rows.groupBy("buyer_ucode").agg(F.max("__pull").alias("__newest"), F.count(F.lit(1)).alias("__n"))
        dated = left_lookup(rows, newest, ["buyer_ucode"], nulls_match=True, count_col="__n")
        rows = dated.where(F.col("__pull").eqNullSafe(F.col("__newest"))).drop("__pull", "__newest")
    order = F.struct("record", "pos", F.coalesce("child_pos", F.lit(-1)))
    first = {"buyer_name": False, "document_value": True}
    if not with_pull:
        return first_per_group(rows, ["buyer_ucode"], order, first)
    dated = rows.withColumn("pull", F.col("record.source_file"))
    return first_per_group(dated, ["buyer_ucode"], order, {**first, "pull": False})


def build_sales_a(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``sales`` and ``users`` records (with ``pos``) to the tables of the mart."""
    return {"sales": sales(unique_sales(inputs["sales"])), "users": buyers(inputs["users"])}
