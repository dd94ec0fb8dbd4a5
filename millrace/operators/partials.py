"""Partial statistics per bucket of time: stored once, merged to any longer period, completed with empty buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket_start"
# Parts of a value that add up: number of rows, of values, their sum, least and greatest.
PARTS = ("rows", "n", "total", "least", "most")


def bucket_of(ts: Column | str, seconds: int) -> Column:
    """Start of the bucket of a time, counted from 1970 in UTC."""
    second = F.unix_seconds((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))
    return F.timestamp_seconds(second - F.pmod(second, F.lit(seconds)))


def partials(df: DataFrame, ts: str, by: Sequence[str], value: Column | str | None = None, seconds: int = 60,
             counts: Mapping[str, Column] | None = None) -> DataFrame:
    """(bucket_start, by, rows, n, total, least, most, counts) of rows that have a time.

    ``value`` gives the four middle columns (its nulls are counted in ``rows`` only); ``counts`` are numbers of rows
    that meet a condition. All of them add up, so tables of several runs can be merged.
    """
    value = F.col(value) if isinstance(value, str) else value
    parts = [F.count("*").alias("rows")]
    if value is not None:
        parts += [F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most")]
    parts += [F.count_if(condition).alias(name) for name, condition in (counts or {}).items()]
    timed = df.where(F.col(ts).isNotNull())
    return timed.groupBy(bucket_of(ts, seconds).alias(BUCKET), *by).agg(*parts)


def merged(stored: DataFrame, by: Sequence[str], seconds: int | None = None, buckets: bool = True) -> DataFrame:
    """Partials of any number of runs merged per facet and bucket, or without ``buckets`` per facet alone.

    ``seconds`` is the length of the merged buckets, a multiple of the stored one; without it that stays.
    """
    merge = {"total": F.sum, "least": F.min, "most": F.max}
    kept = [c for c in stored.columns if c != BUCKET and c not in by
            and (c in merge or stored.schema[c].dataType.simpleString() == "bigint")]
    parts = [merge.get(c, F.sum)(c).alias(c) for c in kept]
    start = [(F.col(BUCKET) if seconds is None else bucket_of(BUCKET, seconds)).alias(BUCKET)] if buckets else []
    return stored.groupBy(*start, *by).agg(*parts)


def statistic(stat: str) -> Column:
    """A statistic of merged partials."""
    found = {"max": F.col("most"), "min": F.col("least"), "sum": F.col("total"), "count": F.col("n"),
             "avg": F.col("total").cast("double") / F.col("n"), "rows": F.col("rows")}
    return found[stat]


def with_empty_buckets(series: DataFrame, by: Sequence[str], start: datetime, end: datetime, seconds: int) -> DataFrame:
    """A bucket for every facet and ``seconds`` from ``start`` to before ``end``: counts of rows are 0 where there were
    none, sums and extremes null. ``start`` must be a bucket's start."""
    last = F.timestamp_micros(F.unix_micros(F.lit(end).cast("timestamp")) - 1)
    every = F.sequence(F.lit(start).cast("timestamp"), last, F.expr(f"interval {seconds} seconds"))
    grid = (series.select(*by).distinct() if by else series.sparkSession.range(1).select()).select(
        *by, F.explode(every).alias(BUCKET))
    counts = [c for c in series.columns if c not in by and series.schema[c].dataType.simpleString() == "bigint"
              and c not in ("total", "least", "most")]
    keys = [BUCKET, *by]
    renamed = series.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [grid[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    full = grid.join(renamed, same, "left").select(*keys, *[c for c in series.columns if c not in keys])
    return full.fillna(0, counts)
