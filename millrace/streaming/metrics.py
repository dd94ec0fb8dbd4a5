"""Tumbling-window statistics over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import STATISTICS


def window_statistic(stream: DataFrame, ts: str, value: Column | str, by: Sequence[str], seconds: int,
                     stat: str, delay: str = "10 minutes", out: str = "value") -> DataFrame:
    """(period_start, facets, value) of each closed window.

    Rows later than ``delay`` are dropped; a window is sent once, when the watermark passes its end.
    """
    value = F.col(value) if isinstance(value, str) else value
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (timed.groupBy(F.window(ts, f"{seconds} seconds").alias("__w"), *by)
            .agg(STATISTICS[stat](value).alias(out))
            .select(F.col("__w.start").alias("period_start"), *by, out))
