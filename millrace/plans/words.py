"""Word count from text files to text files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.grouping import word_count
from ..sinks.files import write_pairs
from ..sources.files import read_text


def count_words(spark: SparkSession, source: str, target: str) -> None:
    write_pairs(word_count(read_text(spark, source)), target)
