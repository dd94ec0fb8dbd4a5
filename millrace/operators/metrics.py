"""Event and metric aggregates: rates, percentages, faceted means, Apdex, roll-ups."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import dimensions_match
from ..functions.scalar import tags_to_map


def _value(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact_mean(value: Column | str) -> Column:
    """Sum divided by count: with whole or decimal values the result ignores row order."""
    return F.sum(_value(value)).cast("double") / F.count(_value(value))


# The statistics a period or alarm may ask for.
STATISTICS = {
    "max": F.max,
    "min": F.min,
    "avg": exact_mean,
    "sum": F.sum,
    "count": F.count,
}


def event_rate(df: DataFrame, span_seconds: float, by: Sequence[str] = (), per_seconds: int = 60) -> DataFrame:
    """Events per ``per_seconds`` over a span of ``span_seconds``, overall or by facet."""
    rate = F.count("*") * F.lit(float(per_seconds)) / F.lit(float(span_seconds))
    return df.groupBy(*by).agg(F.count("*").alias("events"), rate.alias("rate"))


def percentage(df: DataFrame, predicate: Column, by: Sequence[str] = (), red_above: float | None = None) -> DataFrame:
    """Share of rows that meet a predicate, in percent, with an optional red flag; NULL where there are no rows."""
    share = F.try_divide(F.lit(100.0) * F.count_if(predicate), F.count("*"))
    out = df.groupBy(*by).agg(share.alias("pct"))
    return out if red_above is None else out.withColumn("red", F.col("pct") > F.lit(red_above))


def mean_by(df: DataFrame, value: Column | str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(exact_mean(value).alias("mean"), F.count("*").alias("events"))


def auto_width(start: datetime, end: datetime, buckets: int = 80) -> str:
    """A round bucket width that covers a range with about ``buckets`` buckets."""
    # Widths in seconds a chart may use.
    widths = (1, 5, 10, 30, 60, 300, 600, 1800, 3600, 7200, 21600, 43200, 86400, 604800)
    wanted = (end - start).total_seconds() / buckets
    width = next((w for w in widths if w >= wanted), math.ceil(wanted / 604800) * 604800)
    return f"{width} seconds"


def timeseries(df: DataFrame, ts: str, value: Column | str, by: Sequence[str], width: str,
               stat: str = "avg", out: str = "value") -> DataFrame:
    """A statistic per facet and tumbling bucket: (bucket_start, facets, value)."""
    return (df.groupBy(F.window(ts, width).alias("__w"), *by)
            .agg(STATISTICS[stat](_value(value)).alias(out))
            .select(F.col("__w.start").alias("bucket_start"), *by, out))


def apdex(df: DataFrame, duration: str, threshold: float, by: Sequence[str | Column] = ()) -> DataFrame:
    """Satisfied up to T, tolerating up to 4T: score = (satisfied + tolerating / 2) / all, NULL without durations."""
    satisfied = F.count_if(F.col(duration) <= threshold)
    tolerating = F.count_if((F.col(duration) > threshold) & (F.col(duration) <= 4 * threshold))
    return (df.groupBy(*by)
            .agg(satisfied.alias("satisfied"), tolerating.alias("tolerating"), F.count(duration).alias("samples"))
            .withColumn("apdex", F.try_divide(F.col("satisfied") + F.col("tolerating") / F.lit(2.0), F.col("samples"))))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows in an order that should end in a unique column."""
    return df.orderBy(*order).limit(k)


def scoped_series(points: DataFrame, metric: str, scope: dict[str, str], width: str, stat: str = "avg") -> DataFrame:
    """A statistic of one metric, limited to points with the given dimensions."""
    scoped = points.filter((F.col("metric_name") == metric) & dimensions_match("dimensions", scope))
    return timeseries(scoped, "ts", "value", [], width, stat)


def sum_then_mean(df: DataFrame, ts: str, value: Column | str, width: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum per bucket, then the mean of the buckets."""
    sums = timeseries(df, ts, value, by, width, "sum", "bucket_sum")
    return sums.groupBy(*by).agg(exact_mean("bucket_sum").alias("mean_of_sums"), F.count("*").alias("buckets"))


def period_statistic(df: DataFrame, ts: str, value: Column | str, by: Sequence[str], seconds: int,
                     stat: str) -> DataFrame:
    return timeseries(df, ts, value, by, f"{seconds} seconds", stat)


def tag_rollup(points: DataFrame, name: str, value: Column | str, tags: str, tag: str) -> DataFrame:
    """Sum, mean and count of tagged points per metric name and one tag's value."""
    tagged = points.withColumn(tag, F.try_element_at(tags_to_map(tags), F.lit(tag)))
    return tagged.groupBy(name, tag).agg(
        F.sum(_value(value)).alias("total"), exact_mean(value).alias("mean"), F.count("*").alias("points")
    )
