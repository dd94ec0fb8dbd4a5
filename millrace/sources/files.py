"""File scans: parquet, CSV, JSON, text, partitioned folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition values that a filter lists at most.
PRUNE_VALUES = 10_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, paths: str | Sequence[str], header: bool = True, separator: str = ",",
             schema: str | T.StructType | None = None, multiline: bool = False) -> DataFrame:
    """CSV with every column a string unless a schema is given; never an inference pass.

    ``multiline`` is for values that hold line breaks; a file is then read by one task.
    """
    reader = spark.read.options(header=header, sep=separator, multiLine=multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text([path] if isinstance(path, str) else list(path))


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType, per_line: bool = False,
                    file_bytes: int | None = None) -> DataFrame:
    """Records of files that each hold one top-level JSON array.

    A file in this form is parsed whole by one task, which holds it in memory; the read fails if a file has more than
    ``file_bytes``, if that is given. Where no record of a big file goes across lines, ``per_line`` reads the file as
    lines instead, so that it feeds many tasks. A line may hold any number of records; one that does not parse is an
    error.
    """
    if not per_line:
        if file_bytes is not None:
            sizes = spark.read.format("binaryFile").load(path).select(F.max("length"))  # the listing, not the contents
            largest = sizes.first()[0]
            if largest is not None and largest > file_bytes:
                raise ValueError(f"a file of {largest} bytes would be parsed by one task; the limit is {file_bytes}")
        return spark.read.schema(schema).option("multiLine", True).json(path)
    # Records are objects: brackets outside the first and last brace belong to the array around them.
    records = F.regexp_replace("value", r"^\s*\[?[\s,]*|[\s,]*\]?[\s,]*$", "")
    array = T.ArrayType(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    parsed = F.from_json(F.concat(F.lit("["), "records", F.lit("]")), array, {"mode": "FAILFAST"})
    return (spark.read.text(path).select(records.alias("records")).filter(F.col("records") != "")
            .select(F.inline(parsed)))


def read_partitions(spark: SparkSession, path: str, only: Column, fmt: str = "parquet",
                    schema: str | T.StructType | None = None) -> DataFrame:
    """Scan a partitioned folder; a filter on partition columns prunes whole directories."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).filter(only)


def read_pruned(spark: SparkSession, path: str, dimension: DataFrame, on: Sequence[str], fmt: str = "parquet",
                schema: str | T.StructType | None = None, how: str = "inner") -> DataFrame:
    """Scan a partitioned folder joined to a filtered dimension by partition columns: only the folders that the
    dimension names are read.

    A dimension below the session's broadcast limit is broadcast, and Spark prunes by its values while the query runs.
    Of a larger one the different partition values are looked up first; up to ``PRUNE_VALUES`` of them become a filter
    on the folders. With more nothing is pruned, and the join is right all the same.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("rows without a match may go only in an inner or semi join")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    fact, on = reader.load(path), list(on)
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(str(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit:
        return fact.join(F.broadcast(dimension), on, how)
    values = dimension.select(*on).distinct().limit(PRUNE_VALUES + 1).collect()
    if len(values) <= PRUNE_VALUES:
        for i, name in enumerate(on):
            fact = fact.where(F.col(name).isin(sorted({v[i] for v in values if v[i] is not None})))
    return fact.join(dimension, on, how)
