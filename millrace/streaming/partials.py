"""Streams into tables of partial statistics: each run adds what is new, and late rows are kept."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.partials import BUCKET, bucket_of, merged, partials
from ..sinks.batches import append_batch
from ..sinks.swap import file_system, files_below, finish_swaps, read_text, staging, swap, write_text


def writer_of(checkpoint: str) -> str:
    """A name for a stream's batches in a folder: another checkpoint counts its batches anew."""
    return f"s{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}"


def append_partials(stream: DataFrame, folder: str, checkpoint: str, partial: Callable[[DataFrame], DataFrame]
                    ) -> StreamingQuery:
    """Append ``partial`` of everything that is new to a table, then stop. A batch that is repeated adds nothing."""
    writer = writer_of(checkpoint)
    query = (stream.writeStream.foreachBatch(lambda batch, n: append_batch(partial(batch), folder, n, writer) and None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _micros(mark: int | None) -> Column:
    return F.timestamp_micros(F.lit(mark).cast("long"))


class KeptWindows:
    """Windows of a stream that lose no row.

    A window closes when the newest time seen is ``delay`` past its end, as with a watermark. Rows of a window that was
    closed before their batch began, and rows without a time, go to an output of their own (``late_rows``) and, as
    partial statistics, to the same table as the others: the next look at a closed window has them.

    The folder holds ``partials``, ``late`` and, per batch, the mark that it left. The mark a batch is judged by is the
    one of the batch before, so a repeated batch does the same again.
    """

    def __init__(self, spark: SparkSession, folder: str, ts: str, by: Sequence[str], value: str, seconds: int,
                 delay: str = "10 minutes"):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ts, self.by, self.value, self.seconds = ts, list(by), value, seconds
        self.delay = int(pd.Timedelta(delay).total_seconds() * 1_000_000)

    def _marks(self) -> dict[int, int | None]:
        fs, at = file_system(self.spark, f"{self.folder}/marks")
        if not fs.exists(at):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        numbers = sorted(int(n) for n in names if n.isdigit())[-2:]
        return {n: json.loads(read_text(self.spark, f"{self.folder}/marks/{n:012d}"))["mark"] for n in numbers}

    def mark(self) -> datetime | None:
        """How far windows are closed."""
        marks = self._marks()
        last = marks[max(marks)] if marks else None
        return None if last is None else datetime.fromtimestamp(last / 1e6, timezone.utc)

    def add(self, batch: DataFrame, number: int) -> None:
        """Take over one micro-batch; only the last one may be repeated."""
        marks = self._marks()
        before = max((n for n in marks if n < number), default=None)
        mark = None if before is None else marks[before]
        closes = F.unix_micros(bucket_of(self.ts, self.seconds)) + self.seconds * 1_000_000
        late = F.col(self.ts).isNull() | F.coalesce(closes <= F.lit(mark).cast("long"), F.lit(False))
        append_batch(batch.where(late), f"{self.folder}/late", number)
        append_batch(partials(batch, self.ts, self.by, self.value, self.seconds), f"{self.folder}/partials", number)
        newest = batch.agg(F.unix_micros(F.max(F.col(self.ts).cast("timestamp")))).first()[0]
        if newest is not None:
            mark = max(newest - self.delay, newest - self.delay if mark is None else mark)
        name = f"{self.folder}/marks/{number:012d}"
        fs, at = file_system(self.spark, name)
        if not fs.exists(at):
            write_text(self.spark, name, json.dumps({"mark": mark}))

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take over everything that is new, then stop."""
        query = (stream.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return query

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/partials")

    def windows(self, closed: bool = True) -> DataFrame:
        """(bucket_start, by, rows, n, total, least, most) of the closed windows, or of all."""
        found = merged(self._stored(), self.by)
        marks = self._marks()
        if not closed:
            return found
        ends = F.unix_micros(BUCKET) + self.seconds * 1_000_000
        return found.where(ends <= F.lit(marks[max(marks)] if marks else None).cast("long"))

    def late_rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/late")

    def roll_up(self) -> None:
        """Merge the stored partials to one row per window and facet. Between batches only."""
        table = f"{self.folder}/partials"
        finish_swaps(self.spark, table)
        old = files_below(self.spark, table)
        rows = merged(self._stored(), self.by)
        with staging(self.spark, table) as staged:
            rows.write.parquet(f"{staged}/rows")
            new = files_below(self.spark, f"{staged}/rows")
            swap(self.spark, table, staged, {p: f"{table}/rolled-{p.rsplit('/', 1)[1]}" for p in new}, old)
