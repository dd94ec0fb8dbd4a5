"""Numbered batches appended to one folder, each exactly once."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .swap import file_system, files_below, finish_swaps, staging, swap, write_text

MARKERS = "_batches"


def is_committed(spark: SparkSession, folder: str, number: int, writer: str = "batch") -> bool:
    fs, marker = file_system(spark, f"{folder.rstrip('/')}/{MARKERS}/{writer}-{number:012d}")
    return fs.exists(marker)


def append_batch(rows: DataFrame, folder: str, number: int, writer: str = "batch", fmt: str = "parquet",
                 partition_by: Sequence[str] = (), **options) -> bool:
    """Append a batch to a (partitioned) folder unless it is there; returns whether it was added.

    The rows are staged in a hidden folder. One swap renames the files into their partitions, together with a marker
    for (writer, number): if the marker is there the whole batch is, and a batch that is repeated adds nothing. A writer
    adds its batches in order and may repeat only the last one. The folder has the layout that one write of all rows
    would give it.
    """
    spark, folder = rows.sparkSession, folder.rstrip("/")
    if not re.fullmatch(r"[\w.-]+", writer):
        raise ValueError(f"{writer!r} cannot be part of a file name")
    finish_swaps(spark, folder)
    if is_committed(spark, folder, number, writer):
        return False
    with staging(spark, folder) as staged:
        rows.write.format(fmt).options(**options).partitionBy(*partition_by).save(f"{staged}/rows")
        fs, at = file_system(spark, f"{staged}/rows")
        root = fs.makeQualified(at).toString()
        put = {}
        for path in files_below(spark, f"{staged}/rows"):
            inner, name = path[len(root):].rsplit("/", 1)
            put[path] = f"{folder}{inner}/{writer}-{number:012d}-{name}"
        write_text(spark, f"{staged}/marker", str(len(put)))
        put[f"{staged}/marker"] = f"{folder}/{MARKERS}/{writer}-{number:012d}"
        swap(spark, folder, staged, put)
    # Only the last batch of a writer may come again.
    fs, older = file_system(spark, f"{folder}/{MARKERS}/{writer}-{number - 1:012d}")
    fs.delete(older, False)
    return True


def append_once(folder: str, writer: str = "run", **write) -> Callable[[DataFrame, int], None]:
    """A sink for numbered runs: ``append_batch`` to one folder."""
    def sink(rows: DataFrame, number: int) -> None:
        append_batch(rows, folder, number, writer, **write)

    return sink
