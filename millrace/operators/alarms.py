"""Threshold alarms over metric points: rules are data, one pass evaluates all of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import breached_in_row, state_changes


@dataclass(frozen=True)
class Rule:
    alarm: str
    metric_name: str
    stat: str
    period: int
    op: str
    threshold: float
    periods: int


# Alarm, metric, statistic, period in seconds, comparison, threshold, periods in a row.
RULES = [
    Rule("cluster_status_is_red", "ClusterStatus.red", "max", 60, ">=", 1, 1),
    Rule("cluster_status_is_yellow", "ClusterStatus.yellow", "max", 60, ">=", 1, 1),
    Rule("cluster_free_storage_space_too_low", "FreeStorageSpace", "min", 60, "<=", 32768, 1),
    Rule("cluster_index_writes_blocked", "ClusterIndexWritesBlocked", "max", 300, ">=", 1, 1),
    Rule("node_count_too_low", "Nodes", "min", 86400, "<=", 3, 1),
    Rule("automated_snapshot_failure", "AutomatedSnapshotFailure", "max", 60, ">=", 1, 1),
    Rule("cpu_utilization_too_high", "CPUUtilization", "avg", 900, ">=", 80, 3),
    Rule("jvm_memory_pressure_too_high", "JVMMemoryPressure", "max", 900, ">=", 80, 1),
    Rule("disk_queue_depth_too_high", "DiskQueueDepth", "max", 900, ">=", 64, 1),
]

# Conditions that must hold in every minute of five. The first one looks at the green
# status although its name says red; it is kept as it is.
ALL_MINUTES_RULES = [
    Rule("Cluster status red", "ClusterStatus.green", "max", 60, "==", 1, 5),
    Rule("cluster_free_storage_space_too_low", "FreeStorageSpace", "min", 60, "<", 6000, 5),
]

# Fixed value: Apdex below this in every minute of five is critical.
APDEX_FLOOR = 0.75


def _struct(rule: Rule, *names: str) -> Column:
    return F.struct(*[F.lit(getattr(rule, n)).cast(_TYPES[n]).alias(n) for n in names])


_TYPES = {"alarm": "string", "period": "int", "stat": "string", "op": "string", "threshold": "double",
          "periods": "int"}


def rules_by_metric(rules: list[Rule]) -> Column:
    """Metric name to the alarms that watch it, as one literal: applying rules needs no join."""
    if len({r.alarm for r in rules}) != len(rules):
        raise ValueError("alarm names must differ")
    metrics: dict[str, list[Rule]] = {}
    for rule in rules:
        metrics.setdefault(rule.metric_name, []).append(rule)
    pairs = [x for name, found in metrics.items()
             for x in (F.lit(name), F.array(*[_struct(r, "alarm", "period") for r in found]))]
    return F.create_map(*pairs)


def rule_of(alarm: Column, rules: list[Rule]) -> Column:
    """The statistic, comparison, threshold and number of periods of an alarm."""
    return F.create_map(*[x for r in rules for x in (F.lit(r.alarm), _struct(r, "stat", "op", "threshold", "periods"))
                          ])[alarm]


def breach(value: Column, op: Column, threshold: Column) -> Column:
    """Whether a value is on the wrong side; a NULL value is not."""
    over = (F.when(op == ">=", value >= threshold).when(op == "<=", value <= threshold)
            .when(op == ">", value > threshold).when(op == "<", value < threshold)
            .when(op == "==", value == threshold))
    return F.coalesce(over, F.lit(False))


def watched_points(points: DataFrame, rules: list[Rule]) -> DataFrame:
    """(ts, value, __dims, alarm, period): one row per point and rule that looks at its metric.

    Points are (ts, metric_name, value, dimensions map). Those of other metrics are filtered out in
    the scan. ``__dims`` holds the dimensions as sorted entries, so that their order does not matter.
    """
    watched = points.filter(F.col("metric_name").isin(sorted({r.metric_name for r in rules})))
    fitting = F.try_element_at(rules_by_metric(rules), F.col("metric_name"))
    return watched.select("ts", "value", F.array_sort(F.map_entries("dimensions")).alias("__dims"), F.inline(fitting))


def partial_statistics() -> list[Column]:
    """All statistics a rule may ask for; the rule's own is picked after the aggregate."""
    return [F.max("value").alias("__max"), F.min("value").alias("__min"), F.sum("value").alias("__sum"),
            F.count("value").alias("__n")]


def ruled_statistics(grouped: DataFrame, rules: list[Rule]) -> DataFrame:
    """Attach the rule of each alarm to its groups and pick the statistic it asks for."""
    ruled = grouped.withColumn("__rule", rule_of(F.col("alarm"), rules))
    stat = F.col("__rule.stat")
    value = (F.when(stat == "max", F.col("__max")).when(stat == "min", F.col("__min"))
             .when(stat == "sum", F.col("__sum")).otherwise(F.col("__sum") / F.col("__n")))
    return ruled.select("alarm", "__dims", "period_start", value.alias("value"),
                        "__rule.op", "__rule.threshold", "__rule.periods")


def period_values(points: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistic of each rule, dimension set and period: one shuffle for all rules."""
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    bucket = F.timestamp_seconds(second - F.pmod(second, F.col("period")))
    grouped = (watched_points(points, rules).groupBy("alarm", "__dims", bucket.alias("period_start"))
               .agg(*partial_statistics()))
    return ruled_statistics(grouped, rules)


def evaluate(points: DataFrame, rules: list[Rule], changes_only: bool = False) -> DataFrame:
    """ALARM / OK per rule, dimension set and observed period.

    Periods without points are not evaluated: the state stays as it was, which is what rules that
    ignore missing data ask for, and the choice made here for the others. ``changes_only`` keeps
    the rows where the state differs from the one before, and adds ``previous_state``.
    """
    values = period_values(points, rules)
    checked = values.withColumn("breach", breach(F.col("value"), F.col("op"), F.col("threshold")))
    keys = ["alarm", "__dims"]
    runs = breached_in_row(checked, keys, "period_start", "breach", F.col("periods"))
    states = runs.withColumn("state", F.when(F.col("in_alarm"), "ALARM").otherwise("OK"))
    added = []
    if changes_only:
        states, added = state_changes(states, keys, "period_start", "state"), ["previous_state"]
    return states.select("alarm", F.map_from_entries("__dims").alias("dimensions"), "period_start", "value", "state",
                         *added)


def evaluate_series(series: DataFrame, keys: list[str], time: str, value: str, op: str, threshold: float,
                    periods: int) -> DataFrame:
    """The same test for one rule on a series that is already one row per key and period."""
    checked = series.withColumn("breach", breach(F.col(value), F.lit(op), F.lit(float(threshold))))
    runs = breached_in_row(checked, keys, time, "breach", periods)
    return (runs.withColumn("state", F.when(F.col("in_alarm"), "ALARM").otherwise("OK"))
            .drop("breach", "in_alarm"))
