"""Frames made from literals or ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def frame(spark: SparkSession, rows: list, fields: str | list | T.StructType) -> DataFrame:
    """Rows with a schema, DDL text, column names, or (name, type, nullable) tuples."""
    if isinstance(fields, list) and fields and isinstance(fields[0], tuple):
        fields = T.StructType([T.StructField(*f) for f in fields])
    return spark.createDataFrame(rows, fields)


def filler(length: Column | int) -> Column:
    """Text of a given length for items that need some weight."""
    return F.repeat(F.lit("x"), length if isinstance(length, Column) else F.lit(length))


def key_grid(spark: SparkSession, pks: int = 10, sks: int = 10, filler_length: int = 1000) -> DataFrame:
    """Items for every (pk, sk): one range split into two numbers, so no cross join is needed."""
    return spark.range(pks * sks).select(
        F.floor(F.col("id") / sks).cast("int").alias("pk"), (F.col("id") % sks).cast("int").alias("sk"),
        F.struct(filler(filler_length).alias("S")).alias("filler"),
    )
