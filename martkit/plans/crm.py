"""CRM mart: deal movements, persons, pipelines, stages and their history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.keys import pipe_key
from martkit.functions.nested import first_of
from martkit.operators.dedup import dedup_by_key
from martkit.operators.filters import split_valid
from martkit.operators.history import flag_latest, remap_to_current, scd2_from_snapshots
from martkit.operators.joins import enrich_attributes, member_flag
from martkit.operators.project import (
    align_to_contract,
    all_to_string,
    drop_present,
    fill_text,
    lenient_cast,
    rename_aliases,
    select_all,
)
from martkit.operators.star import build_dim_by_key
from martkit.plans import contracts as c

# Fixed value: status of a deal that no longer exists.
DELETED = "deleted"


def _event_texts(events: DataFrame) -> DataFrame:
    if {"old_value", "old_stage_id"} <= set(events.columns):
        events = events.withColumns(
            {new: F.coalesce(new, old) for old, new in c.MOVE_RENAMES.items()}
        ).drop(*c.MOVE_RENAMES)
    return all_to_string(rename_aliases(events, c.MOVE_RENAMES))


def silver_moves(
    events: DataFrame, persons: DataFrame, person_fields: DataFrame, deals: DataFrame
) -> DataFrame:
    """Movement events as text, with the person's campaign tags and the active flag."""
    source = _event_texts(events)
    df = enrich_attributes(
        source, persons, "person_id", "id", "fields", person_fields, c.UTM_ALIASES
    )
    df = df.withColumn("fk_allstages", pipe_key(F.col("new_stage_id"), F.col("pipeline_id")))
    known = deals.select(F.col("id").alias("deal_id"))
    df = member_flag(df, known, "deal_id", "deal_ativo", as_text=True, counts_from=source)
    schema = c.text_schema(c.MOVE_COLUMNS)
    return align_to_contract(df, schema, dict.fromkeys(c.MOVE_COLUMNS, ""))


def _typed_moves(silver: DataFrame) -> DataFrame:
    df = fill_text(drop_present(silver, c.MOVE_DROPPED))
    return lenient_cast(df, ints=c.MOVE_INTS, floats=c.MOVE_FLOATS, timestamps=c.MOVE_TIMES)


def ft_move(
    silver: DataFrame, deals: DataFrame | None = None, events: DataFrame | None = None
) -> DataFrame:
    """Typed fact with the movement date and the latest-movement flag.

    With a deals snapshot the active flag is taken from it again: deals that are
    not deleted count as active. The newest time of each deal is looked for in
    the raw ``events``, where given, so that the enrichment need not run twice.
    """
    times = None
    if events is not None:
        key = {n: T.StringType() for n in ("deal_id", "timestamp")}
        schema = T.StructType([T.StructField(n, t) for n, t in key.items()])
        times = _typed_moves(align_to_contract(_event_texts(events), schema, dict.fromkeys(key, "")))
    df = flag_latest(_dated_moves(silver), "deal_id", "timestamp", "flg_ultimo_movimento", times_from=times)
    return df if deals is None else _with_active(df, silver, deals)


def ft_move_rows(silver: DataFrame, deals: DataFrame) -> DataFrame:
    """The rows of :func:`ft_move` without the latest flag, which needs the rows of other deliveries."""
    return _with_active(_dated_moves(silver), silver, deals)


def _dated_moves(silver: DataFrame) -> DataFrame:
    df = rename_aliases(_typed_moves(silver), {"deal_ativo": "flag_deal_ativo"})
    return df.withColumn("date", F.to_date("timestamp"))


def _with_active(df: DataFrame, silver: DataFrame, deals: DataFrame) -> DataFrame:
    alive = deals.where(~F.col("status").eqNullSafe(DELETED)).select(F.col("id").alias("deal_id"))
    return member_flag(df, alive, "deal_id", "flag_deal_ativo", counts_from=silver)


def dim_person(persons: DataFrame) -> DataFrame:
    """First e-mail address and phone number of each person."""
    return persons.select(
        "id",
        "name",
        first_of(F.col("email"), "value").alias("email"),
        first_of(F.col("phone"), "value").alias("phone"),
    )


def stage_snapshot(stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid stages, one row per id and snapshot, and the rows that lack a field."""
    valid, rejected = split_valid(stages, c.STAGE_FIELDS)
    keys = ["stage_id"] + (["snapshot_time"] if "snapshot_time" in stages.columns else [])
    unique = dedup_by_key(valid, keys)
    return (
        unique.withColumn("pk_allstages", pipe_key(F.col("stage_id"), F.col("pipeline_id"))),
        rejected,
    )


def scd2_dim_stage(snapshots: DataFrame) -> DataFrame:
    """Validity intervals of each stage over all snapshots."""
    history = scd2_from_snapshots(snapshots, c.STAGE_KEY, c.STAGE_TRACKED, "snapshot_time")
    return history.withColumn("pk_allstages", pipe_key(F.col("stage_id"), F.col("pipeline_id")))


def remap_stages(fact: DataFrame, history: DataFrame) -> DataFrame:
    """Stage ids on the fact replaced by the ids that stand for the same stage today."""
    return remap_to_current(
        fact, history, ["new_stage_id", "old_stage_id"], "stage_id", ["stage_name", "pipeline_id"]
    )


def stage_dims(stages: DataFrame) -> dict[str, DataFrame]:
    """Pipelines, stages, stage history and rejected rows from all stage snapshots.

    The pipeline and stage dimensions take the newest row of each id.
    """
    valid, rejected = stage_snapshot(stages)
    newest = [F.col("snapshot_time").desc(), F.col("stage_id"), F.col("pipeline_id")]
    return {
        "dim_pipeline": build_dim_by_key(valid, c.DIM_PIPELINE, ["pipeline_id"], newest),
        "dim_stage": build_dim_by_key(valid, c.DIM_STAGE, ["stage_id"], newest),
        "scd2_dim_stage": scd2_dim_stage(valid),
        "rejected_stages": rejected,
    }


def build_crm(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``moves, persons, person_fields, deals, stages`` to the tables of the mart.

    ``stages`` holds all snapshots with their ``snapshot_time``.
    """
    silver = silver_moves(
        inputs["moves"], inputs["persons"], inputs["person_fields"], inputs["deals"]
    )
    return {
        "silver_moves": silver,
        "ft_move": ft_move(silver, inputs["deals"], inputs["moves"]),
        "dim_person": select_all(dim_person(inputs["persons"]), c.DIM_PERSON),
        **stage_dims(inputs["stages"]),
    }
