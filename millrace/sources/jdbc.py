"""JDBC table scans and writes. Spark pushes filters and column lists into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_options(url: str, table: str, partition_column: str | None = None, lower: object = None,
                 upper: object = None, partitions: int | None = None, fetch_size: int = 10_000,
                 **properties: str) -> dict[str, str]:
    """Reader options. A parallel scan needs all of column, bounds and partition count.

    The bounds only set the stride: rows outside them still land in the first or last partition.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    parallel = (partition_column, lower, upper, partitions)
    if any(p is not None for p in parallel):
        if any(p is None for p in parallel):
            raise ValueError("give partition_column, lower, upper and partitions together")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def read(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(url, table, **settings)).load()


def bounds(spark: SparkSession, url: str, table: str, column: str, **properties: str) -> tuple:
    """Smallest and largest value of a column, computed by the database."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = spark.read.format("jdbc").options(url=url, dbtable=query, **properties).load().first()
    return row[0], row[1]
