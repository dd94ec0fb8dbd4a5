"""Running totals, dense ids and last writes that stay parallel when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

HOT_ROWS = 1 << 20
BLOCK_ROWS = 1 << 20


def running_total(df: DataFrame, key: str, seq: str, value: str, out: str = "running",
                  opening: DataFrame | None = None, hot_rows: int = HOT_ROWS,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sum of ``value`` per ``key`` up to each row, in ``seq`` order.

    ``seq`` is a whole number that is unique within a key, dense or sparse. A key of up to ``hot_rows`` rows is one
    window group. The rows of larger ones (the missing key may be one) are cut into range partitions of about
    ``block_rows`` rows and written to the shared folder; a block of a key is a group, which starts with a marker row
    that carries the sum of all earlier blocks. ``opening`` (key, opening) adds a starting value.

    The list of hot keys, at most ``rows / hot_rows`` long, and the sums per key and block are all that is gathered.
    """
    block, move, is_row = "__block", "__move", "__is_row"
    counts = stored(df.groupBy(F.col(key).alias("__hot")).agg(F.count("*").alias("__rows"))
                    .filter(F.col("__rows") > hot_rows), "hot-keys")
    many = counts.agg(F.sum("__rows")).first()[0]
    rows = df.withColumns({block: F.lit(0), move: F.col(value), is_row: F.lit(1)})
    starts = None if opening is None else opening.select(
        key, F.lit(0).alias(block), F.col("opening").alias(move), F.lit(0).alias(is_row))
    if not many:
        return _summed(rows, starts, key, seq, move, is_row, df.columns, out)

    def is_hot(side: DataFrame, how: str) -> DataFrame:
        return side.join(counts.select("__hot"), F.col(key).eqNullSafe(F.col("__hot")), how)

    parts = max(2, -(-many // block_rows))
    cut = stored(is_hot(rows, "left_semi").drop(block).repartitionByRange(parts, key, seq)
                 .withColumn(block, F.spark_partition_id() + 1), "running-blocks")
    sums = cut.groupBy(key, block).agg(F.sum(move).alias(move))
    if starts is not None:
        sums = sums.unionByName(is_hot(starts, "left_semi").drop(is_row))
        starts = is_hot(starts, "left_anti")
    earlier = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    markers = (sums.withColumn(move, F.sum(move).over(earlier)).filter((F.col(block) > 0) & F.col(move).isNotNull())
               .withColumn(is_row, F.lit(0)))
    small = _summed(is_hot(rows, "left_anti"), starts, key, seq, move, is_row, df.columns, out)
    return small.unionByName(_summed(cut, markers, key, seq, move, is_row, df.columns, out))


def _summed(rows: DataFrame, markers: DataFrame | None, key: str, seq: str, move: str, is_row: str,
            columns: Sequence[str], out: str) -> DataFrame:
    both = rows if markers is None else rows.unionByName(markers, allowMissingColumns=True)
    inside = (Window.partitionBy(key, "__block").orderBy(is_row, seq)
              .rowsBetween(Window.unboundedPreceding, 0))
    return (both.withColumn(out, F.sum(move).over(inside)).filter(F.col(is_row) == 1)
            .select(*[F.col(f"`{c}`") for c in columns], out))


def last_write(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Spark limits each group to its first row before the shuffle as well as after it, so a key that
    holds a third of all rows sends one row per task.
    """
    newest = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def dense_ids(df: DataFrame, order: Sequence[str | Column], start: int = 1, out: str = "id",
              partitions: int | None = None) -> DataFrame:
    """Gap-free ids from ``start`` in ``order``, without a one-partition window.

    Rows are range-partitioned, sorted and written; per-partition counts give each
    partition its first id. The counts are one row per partition, so they fit anywhere.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = stored(
        ranged.sortWithinPartitions(*order).withColumn("__mid", F.monotonically_increasing_id()), "dense-ids"
    )
    # monotonically_increasing_id is (partition number << 33) + row number in the partition.
    part = F.shiftright(F.col("__mid"), 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        "__part", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + F.lit(start)).alias("__first")
    )
    row_in_part = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("__part", part)
            .join(firsts, "__part")
            .withColumn(out, (F.col("__first") + row_in_part).cast("bigint"))
            .drop("__mid", "__part", "__first"))


def breached_in_row(df: DataFrame, keys: Sequence[str], time: str, breach: str, periods: int | Column,
                    out: str = "in_alarm") -> DataFrame:
    """True where the last ``periods`` observed periods all breached; a NULL breach is none.

    ``periods`` may be a column (one rule per key). Input is one row per key and period, so a group
    is as long as the time range, not as the raw data. A run is counted from the last row without a breach.
    """
    ordered = Window.partitionBy(*keys).orderBy(time)
    number = F.row_number().over(ordered)
    clear = F.when(~F.coalesce(F.col(breach), F.lit(False)), F.col("__row"))
    last_clear = F.max(clear).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    run = F.col("__row") - F.coalesce(last_clear, F.lit(0))
    return df.withColumn("__row", number).withColumn(out, run >= periods).drop("__row")


def state_changes(df: DataFrame, keys: Sequence[str], time: str, state: str) -> DataFrame:
    """Rows whose state differs from the key's previous one; the first state is a change."""
    previous = F.lag(state).over(Window.partitionBy(*keys).orderBy(time))
    return (df.withColumn("previous_state", previous)
            .filter(F.col("previous_state").isNull() | (F.col("previous_state") != F.col(state))))
