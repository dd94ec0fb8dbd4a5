"""Bookmarks for tables that grow by rows: each run hands out only rows that no committed run has had.

A bookmark is a folder per name. ``commits/<n>.json`` has the greatest state key that run ``n`` has seen, and
``ties-<n>`` the rows at that key, so that a row with the same key that comes later is told from those that were there.
``batch-<n>`` has the rows of the run that is under way. It is written first and only then handed to the sink, so a run
that broke between the sink's write and the commit is repeated with the same rows and the same number.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.swap import file_system, read_text, write_text


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


class Bookmark:
    """The memory of one source: ``keys`` are its state key, in order; they never shrink in rows that are new.

    Rows whose key is equal to the greatest one seen, or null, may come at any time. ``name`` tells several sources of
    one ``folder`` apart.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, keys: Sequence[str]):
        self.spark, self.keys = spark, list(keys)
        self.folder = f"{folder.rstrip('/')}/{name}"

    def committed(self) -> int:
        """Number of the last committed run, 0 before the first."""
        fs, at = file_system(self.spark, f"{self.folder}/commits")
        if not fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."], default=0)

    def mark(self) -> list[str | None] | None:
        """The greatest key that committed runs have seen, as texts; None before the first row."""
        n = self.committed()
        return json.loads(read_text(self.spark, f"{self.folder}/commits/{n:012d}.json"))["mark"] if n else None

    def _literals(self, table: DataFrame, mark: list[str | None]) -> list[Column]:
        return [F.lit(v).cast(table.schema[k].dataType) for k, v in zip(self.keys, mark)]

    def _no_key(self) -> Column:
        out = F.col(self.keys[0]).isNull()
        for k in self.keys[1:]:
            out |= F.col(k).isNull()
        return out

    def new_rows(self, table: DataFrame) -> DataFrame:
        """Rows of ``table`` that no committed run has had. The scan is filtered by the mark."""
        n, mark = self.committed(), self.mark()
        if not n:
            return table
        at = F.lit(True)
        beyond = F.lit(False)
        if mark is not None:
            for k, v in zip(self.keys, self._literals(table, mark)):
                beyond |= at & (F.col(k) > v)
                at &= F.col(k) == v
        else:
            at, beyond = F.lit(False), ~self._no_key()
        # Rows with the key of the mark, or without one: as many of each as there are more than were seen.
        seen = self.spark.read.schema(table.schema).parquet(f"{self.folder}/ties-{n:012d}")
        columns = [F.col(f"`{c}`") for c in table.columns]
        now = table.where(at | self._no_key()).groupBy(*columns).agg(F.count("*").alias("__now"))
        had = seen.groupBy(*columns).agg(F.count("*").alias("__had"))
        had = had.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(table.columns)], "__had")
        same = [now[f"`{c}`"].eqNullSafe(had[f"__{i}"]) for i, c in enumerate(table.columns)]
        more = (now.join(had, same, "left").withColumn("__more", F.col("__now") - F.coalesce("__had", F.lit(0)))
                .where("__more > 0"))
        late = more.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "__more")).alias("__i")).drop("__i")
        return table.where(beyond & ~self._no_key()).unionByName(late)

    def run(self, table: DataFrame, sink: Callable[[DataFrame, int], None]) -> int:
        """Hand the new rows and the number of the run to ``sink``, then commit; returns the number.

        Each row is handed out once if the sink, called again with the same number and rows, leaves what one call
        leaves; ``sinks.batches.append_once`` is such a sink. The mark moves only after the sink has returned. Nothing is committed
        for a run without new rows; the number of the last commit is returned.
        """
        n = self.committed() + 1
        batch = f"{self.folder}/batch-{n:012d}"
        if not _exists(self.spark, f"{batch}/_SUCCESS"):
            self.new_rows(table).write.mode("overwrite").parquet(batch)
        rows = self.spark.read.schema(table.schema).parquet(batch)
        if not rows.limit(1).count():
            _delete(self.spark, batch)
            return n - 1
        sink(rows, n)
        self._commit(table, rows, n)
        _delete(self.spark, batch)
        if n > 1:
            _delete(self.spark, f"{self.folder}/ties-{n - 1:012d}")
        return n

    def _commit(self, table: DataFrame, rows: DataFrame, n: int) -> None:
        key = F.struct(*[F.col(k) for k in self.keys])
        last = rows.where(~self._no_key()).agg(F.max(key).alias("k")).select(
            "k", *[F.col(f"k.`{k}`").cast("string").alias(f"s{i}") for i, k in enumerate(self.keys)]).first()
        old = self.mark()
        if last["k"] is None:
            mark = old
        elif old is None:
            mark = [last[f"s{i}"] for i in range(len(self.keys))]
        else:
            # Rows that tie with the old mark do not move it back.
            ahead = self.spark.range(1).select(
                (F.struct(*[F.lit(last[f"s{i}"]).cast(table.schema[k].dataType) for i, k in enumerate(self.keys)])
                 > F.struct(*self._literals(table, old))).alias("a")).first()["a"]
            mark = [last[f"s{i}"] for i in range(len(self.keys))] if ahead else old
        held = self._no_key()
        if mark is not None:
            at = F.lit(True)
            for k, v in zip(self.keys, self._literals(table, mark)):
                at &= F.col(k) == v
            held |= at
        ties = rows.where(held)
        if n > 1:
            ties = ties.unionByName(self.spark.read.schema(table.schema).parquet(f"{self.folder}/ties-{n - 1:012d}").where(held))
        ties.write.mode("overwrite").parquet(f"{self.folder}/ties-{n:012d}")
        write_text(self.spark, f"{self.folder}/commits/{n:012d}.json", json.dumps({"mark": mark}))
