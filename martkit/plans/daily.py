"""Incremental runs of the CRM mart: new files and new snapshots only, merged with what earlier runs kept."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.dates import open_end
from martkit.functions.keys import pipe_key
from martkit.operators.joins import new_rows
from martkit.operators.project import align_to_contract
from martkit.operators.state import BUCKET, bucket_of, flag_from_state, merge_newest, merge_snapshot, newest_times
from martkit.plans import contracts as c
from martkit.plans import crm
from martkit.sources.pointed import PointedTable
from martkit.sources.readers import CORRUPT, as_schema
from martkit.sources.writers import LOAD_COL, write_version
from martkit.streaming.ingest import ingest_new_files
from martkit.workspace import written

KEY, TIME, FLAG = "deal_id", "timestamp", "flg_ultimo_movimento"
CONTROL = f"{LOAD_COL} string"
BUCKETS = 16  # of deals, in the fact's versions and in the kept newest times
OPEN, CLOSED = "open", "closed"
SNAPSHOT = "snapshot_time"


def _table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def moves_table(spark: SparkSession, gold: str) -> PointedTable:
    """The movement fact, by version and bucket of deals."""
    empty = spark.createDataFrame([], c.text_schema(c.MOVE_COLUMNS))
    fact = crm.ft_move(empty, spark.createDataFrame([], "id bigint, status string"))
    fields = [f for f in fact.schema.fields if f.name not in (LOAD_COL, BUCKET)]
    schema = T.StructType([*fields, T.StructField(LOAD_COL, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    return PointedTable(spark, f"{gold}/ft_move", schema, [LOAD_COL, BUCKET])


def newest_table(spark: SparkSession, gold: str) -> PointedTable:
    """Each deal's newest time and the versions that hold it, by bucket of deals."""
    fact = moves_table(spark, gold).schema
    kinds = f"key {fact[KEY].dataType.simpleString()}, newest {fact[TIME].dataType.simpleString()}"
    return PointedTable(spark, f"{gold}/ft_move_newest", f"{kinds}, versions array<string>, {BUCKET} int", [BUCKET])


def read_moves(spark: SparkSession, gold: str) -> DataFrame:
    """The movement fact as the last run that ended left it."""
    return moves_table(spark, gold).read().drop(BUCKET)


def run_moves(
    spark: SparkSession, feed: str, silver: str, gold: str, version: str,
    persons: DataFrame, person_fields: DataFrame, deals: DataFrame, lines: bool = True,
) -> list[str]:
    """Take in the new files of the movement feed and bring ``ft_move`` up to date.

    The new files' records land in the silver table under this run's ``version``
    (a name that sorts after those before it). Versions that the control table
    lacks are enriched and typed. Their deals' newest times are merged with the
    kept ones, of the buckets that the delivery touches only; these tell which
    older partitions hold a row that is the latest no longer. New and renewed
    partitions replace the old ones in one commit: a run reads what it got, the
    touched buckets of the state, and the partitions that it has to renew, and
    no other part of the fact. A run that stopped anywhere leaves its version
    out of the control table, and the next run does all of it again, with the
    same result. What reaches the driver are names of versions and partitions.
    Records that are no JSON go to ``ft_move_rejects``. Returns the versions
    taken in; :func:`read_moves` reads the fact.
    """
    schema = as_schema(f"{c.MOVE_EVENT}, {CORRUPT} string")
    ingest_new_files(
        spark, feed, schema, f"{silver}/moves", f"{silver}/moves_files",
        options={"multiLine": not lines, "columnNameOfCorruptRecord": CORRUPT},
        transform=lambda df: df.withColumn(LOAD_COL, F.lit(version)),
    )
    landed = _table_or_empty(spark, f"{silver}/moves", f"{c.MOVE_EVENT}, {CORRUPT} string, {CONTROL}")
    control = _table_or_empty(spark, f"{silver}/moves_control", CONTROL)
    fresh = new_rows(landed, control, LOAD_COL)
    versions = sorted(r[0] for r in fresh.select(LOAD_COL).distinct().collect())
    if not versions:
        return []
    fact, newest = moves_table(spark, gold), newest_table(spark, gold)
    parts = []
    for name in versions:
        rows = landed.where(F.col(LOAD_COL) == name)
        bad = F.col(CORRUPT).isNotNull()
        write_version(rows.where(bad).select(CORRUPT), f"{gold}/ft_move_rejects", name)
        events = align_to_contract(rows.where(~bad), as_schema(c.MOVE_EVENT))
        moves = crm.ft_move_rows(crm.silver_moves(events, persons, person_fields, deals), deals)
        parts.append(moves.withColumn(LOAD_COL, F.lit(name)))
    delivered = parts[0]
    for part in parts[1:]:
        delivered = delivered.unionByName(part)
    delivered = written(delivered.withColumn(BUCKET, bucket_of(KEY, BUCKETS)))

    times = newest_times(delivered, KEY, TIME, LOAD_COL)
    touched = [str(r[0]) for r in delivered.select(BUCKET).distinct().collect()]
    state = written(merge_newest(newest.read(touched), times).withColumn(BUCKET, bucket_of("key", BUCKETS)))
    stale = state.select(F.explode("stale").alias("v"), BUCKET).where(~F.col("v").isin(versions)).distinct()
    older = fact.read([f"{r['v']}|{r[BUCKET]}" for r in stale.collect()])
    rows = delivered.unionByName(older.drop(FLAG))
    # a fresh version that a stopped run had committed before goes as a whole
    redone = [p for p in fact.partitions() if p.rsplit("|", 1)[0] in versions]
    fact.replace(flag_from_state(rows, state, KEY, TIME, FLAG), drop=redone)
    newest.replace(state)
    spark.createDataFrame([(v,) for v in versions], CONTROL).write.mode("append").parquet(f"{silver}/moves_control")
    return versions


def history_table(spark: SparkSession, gold: str) -> PointedTable:
    """Validity intervals of the stages: the open ones, and those that each snapshot has closed."""
    kinds = {f.name: f.dataType for f in as_schema(c.STAGE).fields}
    fields = [T.StructField(n, kinds.get(n, T.StringType())) for n in (*c.STAGE_KEY, *c.STAGE_TRACKED)]
    times = [T.StructField(n, T.TimestampNTZType()) for n in ("dt_inicio_vigencia", "dt_fim_vigencia", SNAPSHOT)]
    return PointedTable(spark, f"{gold}/scd2_dim_stage", T.StructType([*fields, *times, T.StructField("state", T.StringType())]),
                        ["state"])


def read_history(spark: SparkSession, gold: str) -> DataFrame:
    """All validity intervals, as :func:`crm.scd2_dim_stage` gives them."""
    rows = history_table(spark, gold).read().where(F.col("dt_inicio_vigencia").isNotNull()).drop(SNAPSHOT, "state")
    return rows.withColumn("pk_allstages", pipe_key(F.col("stage_id"), F.col("pipeline_id")))


def merge_stage_snapshot(spark: SparkSession, stages: DataFrame, at: datetime, gold: str) -> bool:
    """Bring the stages' history up to date with one new full snapshot, taken ``at`` that time.

    Only the open intervals are read; those that end go to a partition of their
    own, beside the closed ones of earlier snapshots. Both are committed at once.
    A snapshot that is not newer than the last one has been merged, or comes too
    late: nothing is done, and the result is False. An empty snapshot ends all.
    """
    table = history_table(spark, gold)
    valid = table.read([OPEN])
    last = valid.agg(F.max(SNAPSHOT)).first()[0]
    if last is not None and at <= last:
        return False
    known = valid.where(F.col("dt_inicio_vigencia").isNotNull())
    unique, _ = crm.stage_snapshot(stages)
    moment = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = written(merge_snapshot(known, unique, c.STAGE_KEY, c.STAGE_TRACKED, moment))
    is_open = F.col("dt_fim_vigencia") == open_end()
    state = F.when(is_open, F.lit(OPEN)).otherwise(F.concat(F.lit(f"{CLOSED} "), moment.cast("string")))
    rows = rows.withColumn(SNAPSHOT, moment).withColumn("state", state)
    # a row without an interval keeps the snapshot's time where no stage is left open
    mark = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields[:-2]], moment.alias(SNAPSHOT), F.lit(OPEN).alias("state")
    )
    table.replace(rows.unionByName(mark))
    return True
