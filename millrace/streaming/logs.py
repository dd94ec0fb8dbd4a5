"""Continuous log pipeline into a gzip archive by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.logs import process, with_event_day
from ..sinks.batches import append_batch
from .partials import writer_of

DAYS = ("year", "month", "day")


def archive_logs(stream: DataFrame, path: str, checkpoint: str, wanted: Column | None = None) -> StreamingQuery:
    """Filter, remap, parse and archive all new lines, then stop.

    The archive has the layout of ``plans.logs.archive``: gzip JSON lines by year, month and day. The rows of a day are
    gathered before they are written, so that a run adds few files to it. The files of a batch are staged and renamed
    into their days together, and a batch that is repeated adds nothing.
    """
    writer = writer_of(checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch.hint("rebalance", *DAYS), path, number, writer, "json", DAYS, compression="gzip")

    query = (with_event_day(process(stream, wanted)).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
