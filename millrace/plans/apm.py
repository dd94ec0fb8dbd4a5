"""Dashboard of an application: every panel as a frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.alarms import APDEX_FLOOR, evaluate_series
from ..operators.metrics import apdex, auto_width, event_rate, mean_by, percentage, timeseries, top_k
from ..operators.partials import BUCKET, merged, partials, statistic

# Fixed value: an error share above this many percent is red.
ERROR_RED = 2.5


def dashboard(transactions: DataFrame, start: datetime, end: datetime, threshold: float) -> dict[str, DataFrame]:
    """Panels over transactions (ts, appName, name, host, duration, error) between two times."""
    span = (end - start).total_seconds()
    inside = transactions.filter((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    return {
        "requests_per_minute": event_rate(inside, span),
        "error_rate": percentage(inside, F.col("error"), red_above=ERROR_RED),
        "average_duration_by_app": mean_by(inside, "duration", ["appName"]),
        "average_duration": timeseries(inside, "ts", "duration", ["appName"], auto_width(start, end)),
        "apdex_top5_by_host": top_k(apdex(inside, "duration", threshold, ["host"]), 5,
                                    F.col("apdex").desc(), F.col("host")),
        "requests_per_minute_by_name": event_rate(inside, span, ["name"]),
    }


def apdex_alarm(transactions: DataFrame, threshold: float, floor: float = APDEX_FLOOR, minutes: int = 5) -> DataFrame:
    """ALARM where the score of an application was below the floor in every one of the last minutes."""
    minute = F.date_trunc("minute", "ts").alias("minute")
    scores = apdex(transactions, "duration", threshold, ["appName", minute])
    return evaluate_series(scores, ["appName"], "minute", "apdex", "<", floor, minutes)


FACETS = ("appName", "name", "host")


def transaction_minutes(transactions: DataFrame, threshold: float) -> DataFrame:
    """What all panels need of transactions, by minute and facets. Tables of several runs are appended to each other."""
    duration = F.col("duration")
    return partials(transactions, "ts", FACETS, "duration", 60, {
        "errors": F.col("error"), "satisfied": duration <= threshold,
        "tolerating": (duration > threshold) & (duration <= 4 * threshold)})


def _score() -> Column:
    return F.try_divide(F.col("satisfied") + F.col("tolerating") / F.lit(2.0), F.col("n"))


def period_series(minutes: DataFrame, by: Sequence[str], seconds: int, stat: str = "avg") -> DataFrame:
    """(bucket_start, facets, value) for periods of whole minutes, such as 60 to 86400 seconds, from the minute table."""
    if seconds % 60:
        raise ValueError("a period is a number of whole minutes")
    return merged(minutes, by, seconds).select(BUCKET, *by, statistic(stat).alias("value"))


def dashboard_of_minutes(minutes: DataFrame, start: datetime, end: datetime) -> dict[str, DataFrame]:
    """The panels of ``dashboard`` from the minute table; both times must be whole minutes."""
    if any(t.second or t.microsecond for t in (start, end)):
        raise ValueError("the minute table answers for whole minutes")
    span = (end - start).total_seconds()
    inside = minutes.filter((F.col(BUCKET) >= F.lit(start)) & (F.col(BUCKET) < F.lit(end)))
    rate = [F.col("rows").alias("events"), (F.col("rows") * F.lit(60.0) / F.lit(span)).alias("rate")]
    share = F.try_divide(F.lit(100.0) * F.col("errors"), F.col("rows"))
    whole = merged(inside, [], buckets=False).na.fill(0)
    hosts = merged(inside, ["host"], buckets=False)
    return {
        "requests_per_minute": whole.select(*rate),
        "error_rate": whole.select(share.alias("pct")).withColumn("red", F.col("pct") > F.lit(ERROR_RED)),
        "average_duration_by_app": merged(inside, ["appName"], buckets=False).select(
            "appName", statistic("avg").alias("mean"), F.col("rows").alias("events")),
        "average_duration": period_series(inside, ["appName"], int(auto_width(start, end).split()[0])),
        "apdex_top5_by_host": top_k(hosts.select("host", "satisfied", "tolerating", F.col("n").alias("samples"),
                                                 _score().alias("apdex")), 5, F.col("apdex").desc(), F.col("host")),
        "requests_per_minute_by_name": merged(inside, ["name"], buckets=False).select("name", *rate),
    }


def apdex_alarm_of_minutes(minutes: DataFrame, floor: float = APDEX_FLOOR, periods: int = 5) -> DataFrame:
    """``apdex_alarm`` from the minute table."""
    scores = merged(minutes, ["appName"]).select(
        "appName", F.col(BUCKET).alias("minute"), "satisfied", "tolerating", F.col("n").alias("samples"), _score().alias("apdex"))
    return evaluate_series(scores, ["appName"], "minute", "apdex", "<", floor, periods)
