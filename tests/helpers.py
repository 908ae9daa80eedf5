from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def frame(spark: SparkSession, ddl: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(spark: SparkSession, fn, inputs: list, kind: str = "string") -> list:
    """A column function applied to a list of inputs, in their order."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    out = df.select("i", fn(df["x"]).alias("y")).collect()
    return [r["y"] for r in sorted(out, key=lambda r: r["i"])]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
