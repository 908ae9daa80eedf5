"""Tolerant readers for landed feeds."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.text import strip
from martkit.operators.combine import stack_diagonal, stack_relaxed, stack_strict
from martkit.operators.project import null_tokens as apply_null_tokens
from martkit.operators.project import q, rename_aliases, select_all
from martkit.workspace import written

CORRUPT = "_corrupt_record"
NO_SEPARATOR = "\x00\x01\x00 no line ends here \x00\x01\x00"
# What readers leave out: file, text where there is one, reason.
REJECTS = f"source_file string, {CORRUPT} string, reason string"
# Fixed value: the id of the writing job in the name of a part file.
SPARK_JOB_IN_NAME = r"^part-\d+-([0-9a-f-]{36})"
# Fixed value: smaller Parquet files cannot hold a table.
MIN_PARQUET_BYTES = 100
# Fixed value: the version stamp in file and folder names.
VERSION_IN_PATH = r"^.*(\d{4})(\d\d)(\d\d)_(\d\d)(\d\d)(\d\d).*$"


def as_schema(schema: T.StructType | str) -> T.StructType:
    """A schema given as such or as DDL text."""
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _json(
    spark: SparkSession, path: str | Sequence[str], fields: Sequence[str], lines: bool = False
) -> DataFrame:
    """The records with every field as text, so that no value of a strange type spoils its file.

    A file that isn't one record per line is read as one line up to a separator
    that no file holds: its text is parsed in memory. As a multi-line file, Spark
    would fetch the text of each number from the file again, by its place.
    """
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*fields, CORRUPT)])
    reader = spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader if lines else reader.option("lineSep", NO_SEPARATOR)
    return reader.json(path if isinstance(path, str) else list(path))


def _typed(text: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A field's text as its type, and whether it cannot be read as that. Blank text of a plain type is null."""
    if isinstance(kind, T.StringType):
        return text, F.lit(False)
    if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        value = F.when(strip(text) != "", text.try_cast(kind))
        return value, (strip(text) != "") & value.isNull()
    shell = T.StructType([T.StructField("v", kind), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), shell, {"columnNameOfCorruptRecord": CORRUPT}
    )
    return parsed["v"], text.isNotNull() & parsed[CORRUPT].isNotNull()


def _typed_records(texts: DataFrame, schema: T.StructType, keep: Sequence[str]) -> DataFrame:
    """Records of text fields with their types; ``__reason`` names the fields that do not fit, or is null."""
    typed = [(f.name, *_typed(q(f.name), f.dataType)) for f in schema.fields]
    wrong = F.concat_ws(", ", *[F.when(bad, F.lit(n)) for n, _, bad in typed])
    reason = F.when(q(CORRUPT).isNotNull(), F.lit("not JSON")).when(
        wrong != "", F.concat(F.lit("wrong type: "), wrong)
    )
    source = F.coalesce(q(CORRUPT), F.to_json(F.struct(*[q(f.name) for f in schema.fields])))
    return texts.select(
        *[q(k) for k in keep], *[v.alias(n) for n, v, _ in typed],
        reason.alias("__reason"), F.when(reason.isNotNull(), source).alias("__record"),
    )


def _good(records: DataFrame) -> DataFrame:
    return records.where(F.col("__reason").isNull()).drop("__reason", "__record")


def _rejects(records: DataFrame) -> DataFrame:
    return records.where(F.col("__reason").isNotNull()).select(
        "source_file", F.col("__record").alias(CORRUPT), F.col("__reason").alias("reason")
    )


def _json_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, with_file: bool, lines: bool
) -> DataFrame:
    schema = as_schema(schema)
    df = _json(spark, path, schema.fieldNames(), lines)
    return _typed_records(with_source_file(df) if with_file else df, schema, ["source_file"] * with_file).select(
        *[q(f.name) for f in schema.fields], *["source_file"] * with_file, "__reason", "__record"
    )


def read_json_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    with_file: bool = False,
    lines: bool = False,
) -> DataFrame:
    """Files that hold one object or an array of objects.

    An empty array gives no rows. Fields are typed one by one: a record with a
    value that does not fit its type, and a file that is no JSON, are left out
    here and listed by :func:`read_json_rejects`; the other records of the file
    stay. A file is decoded by one task; feeds too large for that are landed
    with one record per line and read with ``lines``, which splits them.
    """
    return _good(_json_records(spark, path, schema, with_file, lines))


def read_json_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, lines: bool = False
) -> DataFrame:
    """File and text of the records that are left out, and why."""
    return _rejects(_json_records(spark, path, schema, True, lines))


def split_json_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The records with their file, and those left out, from one scan.

    The typed records are written to the shared folder and both are read from there.
    """
    records = written(_json_records(spark, path, schema, True, lines))
    return _good(records), _rejects(records)


def split_json_envelope(
    spark: SparkSession, path: str | Sequence[str], record: T.StructType | str, field: str = "dados"
) -> tuple[DataFrame, DataFrame]:
    """As :func:`split_json_records`, for the records of an envelope; the good ones carry ``pos``."""
    records = written(_envelope_items(spark, path, as_schema(record), field, True))
    return _good(records), _rejects(records)


def _envelope_items(
    spark: SparkSession, path: str | Sequence[str], record: T.StructType, field: str, with_file: bool
) -> DataFrame:
    raw = _json(spark, path, [field])
    raw = with_source_file(raw) if with_file else raw
    wrong = F.when(q(CORRUPT).isNotNull() | ~q(field).startswith("["), F.coalesce(q(CORRUPT), q(field)))
    bad = F.raise_error(
        F.concat(F.lit(f"{field} is not a list of records: "), F.substring(wrong, 1, 200))
    ).cast("array<string>")
    items = F.when(wrong.isNull(), F.from_json(q(field), T.ArrayType(T.StringType()))).otherwise(bad)
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*record.fieldNames(), CORRUPT)])
    origin = ["source_file"] * with_file
    rows = raw.select(*origin, F.posexplode(items).alias("pos", "__item")).select(
        *origin, "pos", F.from_json("__item", text, {"columnNameOfCorruptRecord": CORRUPT}).alias("__item")
    )
    return _typed_records(rows.select(*origin, "pos", "__item.*"), record, [*origin, "pos"])


def read_json_envelope(
    spark: SparkSession,
    path: str,
    record: T.StructType | str,
    field: str = "dados",
    with_file: bool = False,
) -> DataFrame:
    """The records of ``{"dados": [...]}``, with their position in the file.

    A file whose field is no list stops the job; a file without the field has no
    records. A record with a value that does not fit its type is left out here
    and listed by :func:`read_envelope_rejects`.
    """
    return _good(_envelope_items(spark, path, as_schema(record), field, with_file))


def read_envelope_rejects(
    spark: SparkSession, path: str, record: T.StructType | str, field: str = "dados"
) -> DataFrame:
    """File and text of the records that are left out, and why."""
    return _rejects(_envelope_items(spark, path, as_schema(record), field, True))


def _occurrences(mark: str) -> Column:
    return F.length("value") - F.length(F.replace(F.col("value"), F.lit(mark)))


def _csv_classes(spark: SparkSession, path: str, seps: Sequence[str]) -> list:
    """One row per way of reading the files: header, separator, encoding, line breaks.

    A single distributed pass over the text decides; what reaches the driver is
    file names and one header line per class. Collecting the set of encodings
    makes Spark aggregate by hash, so the lines need not be sorted by file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("place"),
        "value",
    )
    body = lines.where(strip(F.col("value")) != "")
    files = body.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        (~F.array_contains(F.collect_set(F.is_valid_utf8("value")), False)).alias("utf8"),
        F.sum(_occurrences(seps[0])).alias("n_first"),
        F.sum(_occurrences(seps[1])).alias("n_second"),
        F.bool_or(_occurrences('"') % 2 == 1).alias("breaks"),
        F.min_by("value", "place").alias("header"),
    )
    return (
        files.where(F.col("n_lines") > 1)
        .groupBy(
            "utf8",
            "breaks",
            F.when(F.col("n_second") > F.col("n_first"), seps[1]).otherwise(seps[0]).alias("sep"),
            F.when(F.col("utf8"), F.col("header"))
            .otherwise(F.decode(F.col("header").cast("binary"), "ISO-8859-1"))
            .alias("header"),
        )
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )


def _csv_frames(spark: SparkSession, path: str, seps: Sequence[str]) -> list[DataFrame]:
    """The rows of each class of files, with the file and, where a row does not fit the header, its text."""
    frames = []
    for c in _csv_classes(spark, path, seps):
        names = next(csv.reader([c["header"].removeprefix("\ufeff")], delimiter=c["sep"]))
        text = T.StructType([T.StructField(n, T.StringType()) for n in (*(n.strip() for n in names), CORRUPT)])
        frames.append(
            with_source_file(
                spark.read.schema(text)
                .option("header", True)
                .option("sep", c["sep"])
                .option("encoding", "UTF-8" if c["utf8"] else "ISO-8859-1")
                .option("multiLine", c["breaks"])
                .option("escape", '"')
                .option("columnNameOfCorruptRecord", CORRUPT)
                .option("columnPruning", False)  # else a row is judged by the columns that a query takes
                .csv(c["paths"])
            )
        )
    return frames


def read_csv_text(
    spark: SparkSession,
    path: str,
    seps: Sequence[str] = (",", ";"),
    null_tokens: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV files as text columns, whatever their separator or encoding.

    Empty and header-only files are skipped, a byte order mark is dropped, files
    that are not UTF-8 are read as latin-1, the more frequent separator wins.
    Files of one class are read in one scan, split into tasks unless a quoted
    value contains a line break. Columns a file lacks are null. Rows with more
    or fewer values than the header are left out here and listed by
    :func:`read_csv_rejects`.
    """
    frames = [f.where(q(CORRUPT).isNull()).drop(CORRUPT, "source_file") for f in _csv_frames(spark, path, seps)]
    if not frames:
        wanted = T.StructType([T.StructField(n, T.StringType()) for n in columns or ()])
        return spark.createDataFrame([], wanted)
    df = stack_diagonal(*frames)
    if columns is not None:
        df = df.select(
            [q(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in columns]
        )
    return apply_null_tokens(df, null_tokens) if null_tokens else df


def read_csv_rejects(spark: SparkSession, path: str, seps: Sequence[str] = (",", ";")) -> DataFrame:
    """File and text of the rows that do not fit their header.

    Spark refuses to read the corrupt record column alone, hence the condition
    on a data column, which always holds.
    """
    frames = [
        f.where(q(CORRUPT).isNotNull() & (F.coalesce(q(f.columns[0]), F.lit("")) >= "")).select(
            "source_file", CORRUPT, F.lit("more or fewer values than the header").alias("reason")
        )
        for f in _csv_frames(spark, path, seps)
    ]
    return stack_strict(*frames) if frames else spark.createDataFrame([], REJECTS)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, name and size of the files that match, without reading them."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1))


def _parquet_groups(spark: SparkSession, path: str, min_bytes: int) -> tuple[list, list]:
    """Files of one schema each, with that schema; and the files that cannot be read, with the reason.

    Files that one Spark job wrote share a job id in their names and a schema.
    Spark reads all their footers in one distributed job; only where that fails,
    and for files of other writers, footers are looked at one by one.
    """
    found = list_files(spark, path.rstrip("/") + "/*.parquet")
    job = F.regexp_extract("name", SPARK_JOB_IN_NAME, 1)
    sized = found.withColumn("small", F.col("length") < min_bytes)
    groups = (
        sized.groupBy("small", F.when(job != "", job).otherwise(F.col("path")))
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .collect()
    )
    rejects = [(p, f"smaller than {min_bytes} bytes") for g in groups if g["small"] for p in g["paths"]]

    def footers(paths: list[str]) -> T.StructType | None:
        try:
            return spark.read.option("mergeSchema", True).parquet(*paths).schema
        except (PySparkException, Py4JError):
            return None

    def readable(paths: list[str]) -> list[tuple[list[str], T.StructType | None]]:
        schema = footers(paths)
        if schema is not None or len(paths) == 1:
            return [(paths, schema)]
        return [([p], footers([p])) for p in paths]

    with ThreadPoolExecutor(16) as pool:
        every = sorted(g["paths"] for g in groups if not g["small"])
        checked = [x for part in pool.map(readable, every) for x in part]
    rejects += [(p, "no readable Parquet footer") for paths, schema in checked if schema is None for p in paths]
    by_schema: dict[str, list[str]] = defaultdict(list)
    schemas: dict[str, T.StructType] = {}
    for paths, schema in checked:
        if schema is not None:
            by_schema[schema.json()] += paths
            schemas[schema.json()] = schema
    return [(schemas[key], paths) for key, paths in by_schema.items()], sorted(rejects)


def read_parquet_feed(
    spark: SparkSession,
    path: str,
    required: Sequence[str] | None = None,
    min_bytes: int = MIN_PARQUET_BYTES,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """The Parquet files that lie directly in a folder, as one frame.

    Files that are tiny or have no readable footer are left out as a whole, and
    so is a file that lacks a required column after renaming;
    :func:`read_parquet_rejects` lists them. Damage behind a good footer stops
    the job that meets it: no file is read in part. The files are read in one
    scan per distinct schema. Without ``required`` the columns are the union
    over all files.
    """
    frames = []
    for schema, paths in _parquet_groups(spark, path, min_bytes)[0]:
        df = rename_aliases(spark.read.schema(schema).parquet(*paths), aliases or {})
        if required is None:
            frames.append(df)
        elif set(required) <= set(df.columns):
            frames.append(select_all(df, required))
    if not frames:
        raise ValueError(f"no usable Parquet file in {path}")
    return stack_diagonal(*frames) if required is None else stack_relaxed(*frames)


def read_parquet_rejects(
    spark: SparkSession,
    path: str,
    required: Sequence[str] | None = None,
    min_bytes: int = MIN_PARQUET_BYTES,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """The files that are left out, and why."""
    good, rejects = _parquet_groups(spark, path, min_bytes)
    for schema, paths in good:
        names = {(aliases or {}).get(n, n) for n in schema.fieldNames()}
        lacking = [c for c in required or () if c not in names]
        rejects += [(p, "lacks " + ", ".join(lacking)) for p in paths if lacking]
    return spark.createDataFrame([(p, None, why) for p, why in rejects], REJECTS)


def with_source_file(df: DataFrame) -> DataFrame:
    """A10: the origin file of each row; to be applied right after reading."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def require_single_file(spark: SparkSession, pattern: str) -> None:
    """Raise unless exactly one file matches."""
    try:
        found = len(list_files(spark, pattern).limit(2).collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = 0
    if found != 1:
        raise ValueError(f"expected exactly one file in {pattern}, found {'several' if found else 'none'}")


def single_file_verdicts(spark: SparkSession, path: str, delivery: str) -> DataFrame:
    """For each delivery below a folder, its number of files and whether it is the one file that is expected.

    ``delivery`` is a pattern whose first group is the delivery's name in a
    file's path; files that don't match belong to none. Only names are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    named = files.where(F.col("path").rlike(delivery)).groupBy(F.regexp_extract("path", delivery, 1).alias("delivery"))
    verdict = F.when(F.col("n_files") == 1, F.lit("accepted")).otherwise(F.lit("refused"))
    return named.agg(F.count(F.lit(1)).alias("n_files")).withColumn("verdict", verdict)


def version_time(path: Column) -> Column:
    """Time stamp ``yyyyMMdd_HHmmss`` in a file or folder name, the last one if several."""
    text = F.when(
        path.rlike(VERSION_IN_PATH),
        F.regexp_replace(path, VERSION_IN_PATH, "$1-$2-$3 $4:$5:$6"),
    )
    return text.try_cast("timestamp_ntz")


def stack_snapshots(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Every version below a folder, with its time as ``snapshot_time``.

    Without a schema the columns are those of all versions, null where a version
    lacks one. Files without a stamp in their path are no version; they are left
    out here and listed by :func:`unstamped_files`.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    df = (reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(path)
    stamped = df.withColumn("snapshot_time", version_time(F.col("_metadata.file_path")))
    return stamped.where(F.col("snapshot_time").isNotNull())


def unstamped_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder whose path tells no version time."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    )
    return files.where(version_time(F.col("path")).isNull()).select(
        F.col("path").alias("source_file"), F.lit(None).cast("string").alias(CORRUPT),
        F.lit("no version time in the path").alias("reason"),
    )
