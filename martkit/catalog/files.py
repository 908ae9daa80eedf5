"""Round trips through files: landed feeds, versions, in-place rewrites, ingestion.

Each query writes what a feed would land to a new folder in the shared folder
and reads it back with the tolerant readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.catalog.registry import query, table
from martkit.operators import combine, history
from martkit.operators.explode import flatten_report
from martkit.sources import readers, writers
from martkit.streaming import ingest
from martkit.streaming.ingest import ingest_new_files
from martkit.workspace import new_folder

# Records per landed JSON file. event_id is unique, so a file never holds more.
FILE_ROWS = 5000
EVENT = "event_id bigint, ts string, user_id bigint, event_type string, value double"


def event_records(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value"
    )


def land_json(df, path, whole):
    """One JSON document per file, each made of the records of one id range."""
    record = F.struct(*df.columns)
    packs = df.groupBy(F.floor(F.col("event_id") / FILE_ROWS)).agg(
        F.sort_array(F.collect_list(record)).alias("records")
    )
    packs.select(F.to_json(whole(F.col("records"))).alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).text(path)


EVENTS_SQL = "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value FROM events"


@query("json_records", EVENTS_SQL)
def json_records(spark, sf):
    path = new_folder(spark, "json")
    land_json(event_records(spark, sf), f"{path}/arrays", lambda r: r)
    # files with one object, with an empty array and with half a record
    spark.range(1).select(F.lit("[]").alias("value")).write.text(f"{path}/empty")
    spark.range(1).select(F.lit('[{"event_id": 1, "ts"').alias("value")).write.text(f"{path}/broken")
    return readers.read_json_records(spark, f"{path}/*", EVENT)


@query(
    "json_single_objects",
    """
    SELECT r_regionkey AS event_id, CAST(NULL AS VARCHAR) AS ts, CAST(NULL AS BIGINT) AS user_id,
           r_name AS event_type, CAST(NULL AS DOUBLE) AS value
    FROM (SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region)
    """,
)
def json_single_objects(spark, sf):
    path = new_folder(spark, "json")
    regions = table(spark, sf, "region").select(
        F.to_json(F.struct(F.col("r_regionkey").alias("event_id"), F.col("r_name").alias("event_type")))
        .alias("value")
    )
    regions.write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json_records(spark, path, EVENT)


@query("json_rejects", "SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT event_type FROM events)")
def json_rejects(spark, sf):
    path = new_folder(spark, "json")
    land_json(event_records(spark, sf), f"{path}/arrays", lambda r: r)
    cut = table(spark, sf, "events").select("event_type").distinct().select(
        F.concat(F.lit('{"event_type": "'), "event_type").alias("value")
    )
    cut.write.option("maxRecordsPerFile", 1).text(f"{path}/broken")
    return readers.read_json_rejects(spark, f"{path}/*", EVENT).agg(
        F.count_distinct("source_file").alias("n")
    )


@query("json_envelope", EVENTS_SQL)
def json_envelope(spark, sf):
    path = new_folder(spark, "envelope")
    land_json(
        event_records(spark, sf), path,
        lambda r: F.struct(F.size(r).alias("total_vendas"), r.alias("dados")),
    )
    return readers.read_json_envelope(spark, path, EVENT).drop("pos")


@query(
    "csv_text_mixed",
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang,
           CASE WHEN source = 'src0' THEN NULL ELSE source END AS source, md5(text) AS digest
    FROM documents
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), 'São ' || c_mktsegment, c_name, NULL FROM customer
    """,
)
def csv_text_mixed(spark, sf):
    path = new_folder(spark, "csv")
    # texts keep their line breaks, quotes and separators
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang",
        F.when(F.col("source") == "src0", F.lit("NULL")).otherwise(F.col("source")).alias("source"),
        "text",
    )
    writers.write_csv(docs.where("doc_id % 2 = 0"), f"{path}/a", bom=True)
    writers.write_csv(docs.where("doc_id % 2 = 1").select("text", "doc_id", "source"), f"{path}/b")
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("doc_id"), F.concat(F.lit("São "), "c_mktsegment").alias("lang"),
        F.col("c_name").alias("source"),
    )
    latin = people.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
    latin.csv(f"{path}/c")
    writers.write_csv(people.where("doc_id < 0").coalesce(1), f"{path}/header_only")
    df = readers.read_csv_text(
        spark, f"{path}/*/*.csv", null_tokens=("", "null", "NULL", "None", "NaN"),
        columns=["doc_id", "lang", "source", "text"],
    )
    return df.select("doc_id", "lang", "source", F.md5("text").alias("digest"))


@query(
    "parquet_feed_contract",
    "SELECT o_orderkey AS campaign_id, o_orderstatus AS campaign_name, o_totalprice AS spend FROM orders",
)
def parquet_feed_contract(spark, sf):
    path = new_folder(spark, "feed")
    orders = table(spark, sf, "orders")
    good = orders.select(
        F.col("o_orderkey").alias("campaign_id"), F.col("o_orderstatus").alias("campaign_name"),
        F.col("o_totalprice").alias("spend"), "o_orderdate",
    )
    named = good.withColumnsRenamed({"campaign_id": "id", "campaign_name": "name"})
    good.where("campaign_id % 2 = 0").write.parquet(path)
    named.where("id % 2 = 1").write.mode("append").parquet(path)
    # lacks a column, lies in a sub-folder, holds no table
    good.drop("spend").write.mode("append").parquet(path)
    good.write.parquet(f"{path}/nested")
    required = ["campaign_id", "campaign_name", "spend"]
    return readers.read_parquet_feed(
        spark, path, required, aliases={"id": "campaign_id", "name": "campaign_name"}
    )


@query("single_file_guard", "SELECT n_nationkey, n_name FROM nation")
def single_file_guard(spark, sf):
    readers.require_single_file(spark, f"{sf}/nation.parquet")
    return table(spark, sf, "nation").select("n_nationkey", "n_name")


@query("single_file_refusals", "SELECT n_nationkey, 'several' AS found FROM nation UNION ALL SELECT n_nationkey, 'none' FROM nation")
def single_file_refusals(spark, sf):
    """The guard's refusals on a delivery of two files and on an empty one; a guard that passes them gives no rows."""
    nation = table(spark, sf, "nation").select("n_nationkey")
    path = new_folder(spark, "guard")
    for part in (0, 1):
        nation.where(F.col("n_nationkey") % 2 == part).coalesce(1).write.mode("append").parquet(path)
    refused = [nation.select("n_nationkey", F.lit("").alias("found")).where("false")]
    for pattern in (f"{path}/*.parquet", f"{path}/*.csv"):
        try:
            readers.require_single_file(spark, pattern)
        except ValueError as error:
            refused.append(nation.select("n_nationkey", F.lit(str(error).rpartition(" ")[2]).alias("found")))
    return combine.stack_strict(*refused)


@query(
    "stack_snapshots",
    "SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_time FROM events",
)
def stack_snapshots(spark, sf):
    path = new_folder(spark, "versions")
    stamp = F.date_format("ts", "yyyyMMdd_000000")
    df = table(spark, sf, "events").select("event_id", "user_id", stamp.alias("load_ts"))
    writers.overwrite_versions(df, path)
    return readers.stack_snapshots(spark, path)


@query(
    "write_version",
    """
    SELECT c_custkey, c_acctbal, '20250101_000000' AS load_ts FROM customer
    UNION ALL SELECT c_custkey, c_acctbal + 1, '20250102_000000' FROM customer
    """,
)
def write_version(spark, sf):
    path = new_folder(spark, "versions")
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    newer = df.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    writers.write_version(df, path, "20250101_000000")
    writers.write_version(df, path, "20250102_000000")
    # the same version again replaces itself and leaves the older one alone
    writers.write_version(newer, path, "20250102_000000")
    return spark.read.parquet(path)


@query(
    "rewrite_by_source",
    """
    SELECT event_id, user_id, strftime(ts, '%Y%m%d_000000') AS load_ts,
           CAST(ts = max(ts) OVER (PARTITION BY user_id) AS BIGINT) AS flg_ultimo_movimento
    FROM events
    """,
)
def rewrite_by_source(spark, sf):
    path = new_folder(spark, "fact")
    stamp = F.date_format("ts", "yyyyMMdd_000000")
    moves = table(spark, sf, "events").select("event_id", "user_id", "ts", stamp.alias("load_ts"))
    writers.overwrite_versions(moves, path)
    writers.backup_table(spark, path, new_folder(spark, "backup"))
    writers.rewrite_versions(
        spark, path, lambda df: history.flag_latest(df, "user_id", "ts", "flg_ultimo_movimento")
    )
    return spark.read.parquet(path).drop("ts")


@query("promote_layer", "SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, p_brand FROM part")
def promote_layer(spark, sf):
    silver, gold = new_folder(spark, "silver"), new_folder(spark, "gold")
    writers.write_table(table(spark, sf, "part").select("p_partkey", "p_brand"), silver)
    writers.write_table(table(spark, sf, "part").select("p_partkey", "p_brand"), silver)
    writers.promote(spark, silver, gold)
    return combine.stack_strict(spark.read.parquet(silver), spark.read.parquet(gold))


@query("ingest_once", EVENTS_SQL)
def ingest_once(spark, sf):
    base = new_folder(spark, "ingest")
    landing, target, marks = f"{base}/landing", f"{base}/bronze", f"{base}/marks"
    events = event_records(spark, sf)
    # two deliveries, and a run after each and one more with nothing new
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").json(landing)
        ingest_new_files(spark, landing, readers.as_schema(EVENT), target, marks, archive=f"{base}/archive")
    ingest_new_files(spark, landing, readers.as_schema(EVENT), target, marks, archive=f"{base}/archive")
    return spark.read.parquet(target)


@query(
    "ingest_last_wins",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS pull,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
    """,
)
def ingest_last_wins(spark, sf):
    """Two overlapping pulls, a run after each and one more with nothing new: the second pull's rows count."""
    base = new_folder(spark, "last-wins")
    schema = readers.as_schema("o_orderkey bigint, pull int, price double")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    again = orders.where("o_orderstatus = 'O'").withColumn("price", F.col("price") + 1)
    for pull, rows in enumerate((orders, again, None), 1):
        if rows is not None:
            rows.select("o_orderkey", F.lit(pull).alias("pull"), "price").write.mode("append").json(f"{base}/landing")
        ingest.ingest_last_wins(
            spark, f"{base}/landing", schema, f"{base}/kept", f"{base}/marks", "o_orderkey", [F.col("pull").desc()]
        )
    return ingest.last_wins_table(spark, f"{base}/kept", schema).read().select("o_orderkey", "pull", "price")


@query(
    "web_report_json",
    """
    SELECT strftime(ts, '%Y%m%d') AS "Data", event_type AS "Evento", count(*) AS "Total"
    FROM events GROUP BY ALL
    """,
)
def web_report_json(spark, sf):
    path = new_folder(spark, "report")
    counted = table(spark, sf, "events").groupBy(
        F.date_format("ts", "yyyyMMdd").alias("day"), "event_type"
    ).agg(F.count(F.lit(1)).cast("string").alias("n"))

    def cell(c):
        return F.struct(F.col(c).alias("value"))

    row = F.struct(
        F.array(cell("day"), cell("event_type")).alias("dimension_values"),
        F.array(cell("n")).alias("metric_values"),
    )
    answer = F.struct(F.array(row).alias("rows"))
    counted.select(F.to_json(answer).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    record = (
        "dimension_values array<struct<value:string>>, metric_values array<struct<value:string>>"
    )
    rows = readers.read_json_envelope(spark, path, record, field="rows")
    return flatten_report(rows, ["Data", "Evento"], ["Total"])


@query(
    "json_bad_record",
    """
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS reason FROM events WHERE event_id % 10 <> 3
    UNION ALL SELECT NULL, NULL, 'wrong type: user_id' FROM events WHERE event_id % 10 = 3
    """,
)
def json_bad_record(spark, sf):
    """One record in ten has a text for an id; the nine beside it in its file stay."""
    path = new_folder(spark, "json")
    bad = F.when(F.col("event_id") % 10 == 3, F.lit("none")).otherwise(F.col("user_id").cast("string"))
    land_json(event_records(spark, sf).withColumn("user_id", bad), path, lambda r: r)
    good = readers.read_json_records(spark, path, EVENT).select("event_id", "user_id")
    rejects = readers.read_json_rejects(spark, path, EVENT)
    return combine.stack_diagonal(good.withColumn("reason", F.lit(None).cast("string")), rejects.select("reason"))


@query(
    "json_envelope_bad_record",
    """
    SELECT event_id, value, CAST(NULL AS VARCHAR) AS reason FROM events WHERE event_id % 10 <> 3
    UNION ALL SELECT NULL, NULL, 'wrong type: value' FROM events WHERE event_id % 10 = 3
    """,
)
def json_envelope_bad_record(spark, sf):
    """Numbers as text are numbers; a record with no number at all is left out alone."""
    path = new_folder(spark, "envelope")
    text = F.when(F.col("event_id") % 10 == 3, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    land_json(event_records(spark, sf).withColumn("value", text), path, lambda r: F.struct(r.alias("dados")))
    good = readers.read_json_envelope(spark, path, EVENT).select("event_id", "value")
    rejects = readers.read_envelope_rejects(spark, path, EVENT)
    return combine.stack_diagonal(good.withColumn("reason", F.lit(None).cast("string")), rejects.select("reason"))


@query(
    "csv_ragged_rows",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS reason
    FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT NULL, NULL, 'more or fewer values than the header' FROM customer WHERE c_custkey % 7 = 0
    """,
)
def csv_ragged_rows(spark, sf):
    path = new_folder(spark, "csv")
    key = F.col("c_custkey").cast("string")
    row = F.when(F.col("c_custkey") % 14 == 7, key).when(
        F.col("c_custkey") % 14 == 0, F.concat_ws(",", key, "c_name", F.lit("more"))
    ).otherwise(F.concat_ws(",", key, "c_name"))
    lines = table(spark, sf, "customer").select(row.alias("value")).coalesce(1)
    spark.createDataFrame([("id,name",)], "value string").unionByName(lines).coalesce(1).write.text(path)
    good = readers.read_csv_text(spark, f"{path}/*.txt")
    rejects = readers.read_csv_rejects(spark, f"{path}/*.txt")
    return combine.stack_diagonal(good.withColumn("reason", F.lit(None).cast("string")), rejects.select("reason"))


@query(
    "parquet_feed_rejects",
    """
    SELECT n_nationkey AS id, n_name AS name, CAST(NULL AS VARCHAR) AS reason FROM nation
    UNION ALL SELECT NULL, NULL, 'no readable Parquet footer' FROM region WHERE r_regionkey = 0
    UNION ALL SELECT NULL, NULL, 'smaller than 100 bytes' FROM region WHERE r_regionkey = 0
    UNION ALL SELECT NULL, NULL, 'lacks name' FROM region WHERE r_regionkey = 0
    """,
)
def parquet_feed_rejects(spark, sf):
    """A damaged, a tiny and an incomplete file beside good ones."""
    base = new_folder(spark, "feed")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    nation.write.parquet(f"{base}/a")
    nation.select("id").coalesce(1).write.parquet(f"{base}/b")
    for name, text in (("c", "x" * 5000), ("d", "x")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{base}/{name}")
    feed = _gathered(spark, base, ("a", "b", "c", "d"))
    good = readers.read_parquet_feed(spark, feed, ["id", "name"])
    rejects = readers.read_parquet_rejects(spark, feed, ["id", "name"])
    return combine.stack_diagonal(good.withColumn("reason", F.lit(None).cast("string")), rejects.select("reason"))


def _gathered(spark, base, folders):
    """The part files of several folders in one, all named as Parquet files."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{base}/feed")
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(target)
    for folder in folders:
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/{folder}/part-*")):
            name = status.getPath().getName()
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{base}/feed/{name.split('.')[0]}.parquet"))
    return f"{base}/feed"


@query(
    "stack_versions_columns",
    """
    SELECT n_nationkey AS id, CAST(NULL AS VARCHAR) AS name, TIMESTAMP '2025-01-01' AS snapshot_time,
           CAST(NULL AS VARCHAR) AS reason FROM nation
    UNION ALL SELECT n_nationkey, n_name, TIMESTAMP '2025-01-02', NULL FROM nation
    UNION ALL SELECT NULL, NULL, NULL, 'no version time in the path' FROM region WHERE r_regionkey = 0
    """,
)
def stack_versions_columns(spark, sf):
    """The second version has a column more, a third folder no time."""
    path = new_folder(spark, "versions")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    nation.select("id").write.parquet(f"{path}/load=20250101_000000")
    nation.write.parquet(f"{path}/load=20250102_000000")
    nation.coalesce(1).write.parquet(f"{path}/unknown")
    stacked = readers.stack_snapshots(spark, path).select("id", "name", "snapshot_time")
    rejects = readers.unstamped_files(spark, path).select("reason")
    return combine.stack_diagonal(stacked.withColumn("reason", F.lit(None).cast("string")), rejects)


@query(
    "single_file_verdicts",
    """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, count(DISTINCT event_type) AS n_files FROM events GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS delivery, n_files, n_rows,
           CASE WHEN n_files = 1 THEN 'accepted' ELSE 'refused' END AS verdict FROM d
    """,
)
def single_file_verdicts(spark, sf):
    """One delivery per day of events, one file per kind of event that the day has: days with one file pass."""
    path = new_folder(spark, "deliveries")
    events = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").cast("string").alias("day"))
    events.repartition("day", "event_type").write.partitionBy("day", "event_type").parquet(path)
    verdicts = readers.single_file_verdicts(spark, path, r"/day=([^/]+)/")
    landed = spark.read.schema("event_id bigint, day string, event_type string").parquet(path)
    rows = landed.groupBy("day").agg(F.count("*").alias("n_rows"))
    return verdicts.join(rows, F.col("delivery") == F.col("day")).select("delivery", "n_files", "n_rows", "verdict")


@query("backup_table", "SELECT n_nationkey, n_name FROM nation")
def backup_table(spark, sf):
    """What a backup holds after the table has been replaced."""
    path, copy = new_folder(spark, "table"), new_folder(spark, "backup")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    writers.write_table(nation, path)
    writers.backup_table(spark, path, copy)
    writers.write_table(nation.where("n_nationkey < 3"), path)
    return spark.read.parquet(copy)
