"""Threshold alarms over a stream: closed windows first, then the state of each alarm."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.alarms import Rule, breach, partial_statistics, ruled_statistics, watched_points
from ..operators.windows import last_write
from ..sinks.batches import append_batch
from ..sinks.swap import file_system


def rule_windows(points: DataFrame, rules: list[Rule], delay: str = "10 minutes") -> DataFrame:
    """(alarm, dimensions as JSON, period_start, value, op, threshold, periods) of closed windows.

    One windowed aggregate per period length, all in one query. Rows later than ``delay`` are dropped.
    """
    timed = points.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    closed = []
    for period in sorted({r.period for r in rules}):
        mine = watched_points(timed, [r for r in rules if r.period == period])
        grouped = (mine.groupBy(F.window("ts", f"{period} seconds").alias("__w"), "alarm", "__dims")
                   .agg(*partial_statistics()).withColumn("period_start", F.col("__w.start")))
        closed.append(ruled_statistics(grouped, rules))
    windows = reduce(DataFrame.unionByName, closed)
    return windows.withColumn("dimensions", F.to_json(F.map_from_entries("__dims"))).drop("__dims")


def with_rule(windows: DataFrame, op: str, threshold: float, periods: int) -> DataFrame:
    """The same rule for every window of a plain statistic."""
    return windows.withColumns({"op": F.lit(op), "threshold": F.lit(float(threshold)), "periods": F.lit(periods)})


def _judged(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    over = breach(F.col("value"), F.col("op"), F.col("threshold"))
    return windows.select(*keys, "period_start", F.col("value").cast("double").alias("value"), over.alias("breach"), "periods")


def alarm_states(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ALARM / OK for each closed window, and whether that is a change.

    ``windows`` streams (keys, period_start, value, op, threshold, periods) as an append sink wrote
    them. The state of a key is the number of breaches in a row at its end and its last alarm state; windows that never
    come leave it as it is. There is no watermark: a key may lag behind others by any time and keeps all of its windows.
    Every key that was ever seen keeps its state; ``AlarmStates`` lets those of idle keys go.
    """
    keys = list(keys)
    key_ddl = [f"`{k}` {windows.schema[k].dataType.simpleString()}" for k in keys]
    out_schema = ", ".join([*key_ddl, "period_start TIMESTAMP", "value DOUBLE", "state STRING", "changed BOOLEAN"])

    def step(key, frames, state):
        run, last = state.get if state.exists else (0, None)
        # The windows of one key that closed since the last batch: as many as periods have passed.
        rows = pd.concat(list(frames)).sort_values("period_start", ignore_index=True)
        number = np.arange(1, len(rows) + 1)
        clear = np.maximum.accumulate(np.where(rows["breach"], -run, number))
        runs = number - clear
        states = np.where(runs >= rows["periods"], "ALARM", "OK")
        state.update((int(runs[-1]), str(states[-1])))
        out = rows[[*keys, "period_start", "value"]].copy()
        out["state"], out["changed"] = states, states != np.append([last], states[:-1])
        yield out

    return _judged(windows, keys).groupBy(*keys).applyInPandasWithState(
        step, out_schema, "run LONG, last STRING", "append", "NoTimeout"
    )


class AlarmStates:
    """``alarm_states`` with a time to live: the state of each alarm is a row of a table in ``folder``.

    The state of a key that had no window for ``idle``, by the clock, goes; should the key come back it begins anew.
    Windows are never dropped, however far their key lags behind. Each batch joins its windows to the states that the
    batch before left, appends what it finds to ``states`` once, and writes the states anew: one row per live key.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], idle: str = "30 days",
                 clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.keys, self.clock = spark, folder.rstrip("/"), list(keys), clock
        self.idle = pd.Timedelta(idle).total_seconds()

    def _numbers(self) -> list[int]:
        fs, at = file_system(self.spark, f"{self.folder}/live")
        if not fs.exists(at):
            return []
        names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(at)]
        return sorted(int(n) for n, path in names if n.isdigit() and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")))

    def _live_path(self, number: int) -> str:
        return f"{self.folder}/live/{number:012d}"

    def live(self) -> DataFrame | None:
        """(keys, run, last, seen) of the keys that have a state; None before the first batch."""
        numbers = self._numbers()
        return self.spark.read.parquet(self._live_path(numbers[-1])) if numbers else None

    def add(self, windows: DataFrame, number: int) -> None:
        """Take over one batch of (keys, period_start, value, op, threshold, periods); only the last may be repeated."""
        now = self.clock()
        judged = _judged(windows, self.keys).persist()
        try:
            earlier = [n for n in self._numbers() if n < number]
            keys = ", ".join(f"`{k}` {judged.schema[k].dataType.simpleString()}" for k in self.keys)
            old = (self.spark.read.parquet(self._live_path(earlier[-1])) if earlier else
                   self.spark.createDataFrame([], f"{keys}, run LONG, last STRING, seen DOUBLE"))
            old = old.where(F.col("seen") >= now - self.idle)
            before = old.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.col("run").alias("__run"), F.col("last").alias("__last"))
            same = reduce(Column.__and__, (judged[k].eqNullSafe(before[f"__{k}"]) for k in self.keys))
            ordered = Window.partitionBy(*self.keys).orderBy("period_start")
            place = F.row_number().over(ordered)
            clear = F.max(F.when(~F.col("breach"), F.col("__n"))).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
            run = F.col("__n") - F.coalesce("__clear", -F.coalesce("__run", F.lit(0)))
            states = (judged.join(before, same, "left").withColumn("__n", place).withColumn("__clear", clear).withColumn("run", run)
                      .withColumn("state", F.when(F.col("run") >= F.col("periods"), "ALARM").otherwise("OK"))
                      .withColumn("changed", ~F.col("state").eqNullSafe(F.coalesce(F.lag("state").over(ordered), F.col("__last")))))
            append_batch(states.select(*self.keys, "period_start", "value", "state", "changed"), f"{self.folder}/states", number)
            newest = last_write(states, self.keys, ["period_start"]).select(
                *self.keys, F.col("run").cast("long").alias("run"), F.col("state").alias("last"), F.lit(now).alias("seen"))
            seen = newest.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
            kept = old.join(seen, reduce(Column.__and__, (old[k].eqNullSafe(seen[f"__{k}"]) for k in self.keys)), "left_anti")
            kept.unionByName(newest).write.mode("overwrite").parquet(self._live_path(number))
        finally:
            judged.unpersist()
        for n in earlier[:-1]:
            fs, gone = file_system(self.spark, self._live_path(n))
            fs.delete(gone, True)

    def run(self, windows: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take over every new window of a stream, then stop."""
        query = (windows.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return query
