"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of documents, split into lines first and then at every single space.
WORDS_SQL = """
    lines AS (SELECT unnest(string_split(text, E'\\n')) AS line FROM documents),
    words AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
              WHERE line = '' OR rtrim(line, ' ') <> '')"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""
    def add(build: Callable[[Tables], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


def cents(name: str) -> Column:
    """Money as whole cents: sums of whole numbers do not depend on row order."""
    return F.round(F.col(name) * 100).cast("bigint")


def as_ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)
