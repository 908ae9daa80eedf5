"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.workspace import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``root``, the smallest id reachable, for every id of an edge.

    Alternates two steps until nothing changes: each vertex links its larger
    neighbours to the smallest one, then its smaller ones. The rounds grow with
    the logarithm of the ids; each writes its edges. Loops, repeated edges and
    edges with a null end are left out.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = written(e.where("u != v").distinct())  # beside a null, greatest and least are equal
    state = None
    while (now := e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != state:
        state = now
        e = written(_small_star(_large_star(e)))
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return written(e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots))


def _large_star(e: DataFrame) -> DataFrame:
    """Every vertex's larger neighbours, linked to the smallest of the vertex and its neighbours."""
    lows = written(e.groupBy("u").agg(F.min("v").alias("low")))  # so that the join can split a vertex of many edges
    both = e.select(F.col("v").alias("at"), F.col("u").alias("far"))
    # a vertex without smaller neighbours is the smallest itself, and its edges stay
    linked = both.join(lows.withColumnRenamed("u", "at"), "at", "left")
    far = linked.select(F.col("far").alias("u"), F.coalesce("low", "at").alias("v"))
    near = lows.select("u", F.col("low").alias("v"))
    return far.unionByName(near).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours, linked to the smallest of them."""
    lows = e.groupBy("u").agg(F.min("v").alias("low"))
    linked = e.join(lows, "u")
    moved = linked.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(lows.select("u", F.col("low").alias("v"))).distinct()
