"""Log pipeline: filter, remap, parse, archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.logs import process, with_event_day
from ..sinks.files import write_archive


def archive(logs: DataFrame, path: str, wanted: Column | None = None) -> DataFrame:
    """Write the processed lines to the archive; returns the frame that was written."""
    rows = with_event_day(process(logs, wanted))
    write_archive(rows, path)
    return rows
