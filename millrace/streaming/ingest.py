"""Incremental file ingest: each run reads only what earlier runs have not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet",
              pattern: str | None = None, **options) -> DataFrame:
    """A stream over the files of a folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: tuple[str, ...] = (), **options) -> StreamingQuery:
    """Append everything that is new, then stop. ``checkpoint`` is the memory between runs."""
    query = (stream.writeStream.format(fmt).options(**options).option("path", path)
             .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query
