"""Sharding by rendezvous hashing (operator 8): native Spark expressions only.

Every shard draws a number for a record's key; the smallest draw over the
shard's weight wins. Draws depend on the key and the shard's number alone, so a
further shard takes rows into itself and moves nothing between the others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_DRAW_HEX = 13  # 52 bits, exact in a double
_ROWS_PER_BUCKET = 50_000
_COPIES_PER_ROW = 65_536


def _key(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def _draw(key: Column, shard: int) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, _DRAW_HEX)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**_DRAW_HEX))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key among ``len(weights)`` shards; shard i gets a share of weights[i].

    A null key counts as the empty text. Equal draws, which need equal hashes, go to the lower shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights have to be positive")
    text = _key(key)
    costs = [F.struct((-F.log(_draw(text, i)) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard"))
             for i, w in enumerate(weights)]
    return F.array_min(F.array(*costs))["shard"] if len(costs) > 1 else F.lit(0)


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """The rows with their shard, without a shuffle. A column of that name is replaced."""
    return df.withColumn(out, shard_of(F.col(key), weights))


def number_in_shards(df: DataFrame, shard: str, out: str = "slot", rows: int | None = None) -> DataFrame:
    """Rows numbered from 0 without gaps within each shard.

    The order is that of a hash of all columns. Equal rows are counted before
    the shuffle and numbered as one; each window holds one bucket of a shard,
    and the buckets' sizes, a few numbers for each 50,000 rows, give their
    offsets. ``rows`` is the row count where the caller has it.
    """
    columns = df.columns
    total = df.count() if rows is None else rows
    bits = max(0, math.ceil(math.log2(max(total, 1) / _ROWS_PER_BUCKET)))
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    packed = df.select(F.struct("*").alias("r"))
    counted = packed.groupBy("r").agg(F.count("*").alias("n"))
    counted = (
        counted.select("r.*", "r", "n").withColumn("place", place).select("r", "n", "place", F.col(shard).alias("s"))
        .withColumn("bucket", F.shiftright("place", 60 - bits))
    )
    order = W.partitionBy("s", "bucket").orderBy("place", "r")
    inside = counted.withColumn("before", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    sizes = counted.groupBy("s", "bucket").agg(F.sum("n").alias("size"))
    starts = sizes.withColumn(
        "start", F.sum("size").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        - F.col("size")
    ).select("s", "bucket", "start")
    placed = inside.join(starts.hint("shuffle_hash"), ["s", "bucket"])
    step = F.lit(_COPIES_PER_ROW).cast("long")
    parts = placed.select(
        "r", "n", (F.col("start") + F.col("before")).alias("first"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("skip"),
    )
    single = parts.where("n = 1").select("r.*", F.col("first").alias(out))
    many = parts.where("n > 1").repartition("first", "skip").select(
        "r.*",
        F.explode(F.sequence(F.col("first") + F.col("skip"),
                             F.col("first") + F.least(F.col("skip") + step, F.col("n")) - 1)).alias(out),
    )
    return single.unionByName(many)


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Write the rows as Parquet, one folder ``shard=i`` each."""
    assign_shards(df, key, weights).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Digest of the documents' shards under the law ``key``.

    Null text has size 1 and the checksum of the empty text. A null doc_id is
    the empty key. Repeated rows get slots of their own. Other columns are not read.
    """
    raw = F.col("text").cast("binary")
    sized = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), [1.0] * shards).cast("int").alias("shard"),
        shard_of(F.col("doc_id"), [1.0] * (shards + 1)).cast("int").alias("grown_shard"),
    )
    return number_in_shards(sized, "shard", rows=docs.count()).withColumn("slot", F.col("slot").cast("long"))
