"""Distinct, counts and word count; all of them combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import space_tokens


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def lines(df: DataFrame, text: str) -> DataFrame:
    """One row per line of a text column, named ``value`` as in a text source."""
    return df.select(F.explode(F.split(text, "\n")).alias("value"))


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """(word, count) over all lines. A hot word is one partial row per task, not a hot task."""
    return (lines.select(F.explode(space_tokens(text)).alias("word"))
            .groupBy("word").agg(F.count("*").alias("count")))


def order_limit(df: DataFrame, *order, limit: int | None = None) -> DataFrame:
    """Sorted rows, or the first ``limit`` of them (a distributed top-k, not a global sort)."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
