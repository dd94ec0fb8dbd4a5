"""Structured Streaming over the events file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources.catalog import is_folder
from millrace.streaming import alarms, ingest, logs, metrics

from .metrics import HOURLY_RULES, LOGS_SQL, STATES_SQL, log_lines, measured
from .registry import Tables, as_ntz, query


def event_stream(t: Tables) -> DataFrame:
    """The events as a stream, whether the table is one file or a folder of parts."""
    path = f"{t.folder}/events.parquet"
    if is_folder(t.spark, path):
        return ingest.new_files(t.spark, path, t.events.schema)
    return ingest.new_files(t.spark, t.folder, t.events.schema, pattern="events.parquet")


def closed_windows(t: Tables) -> str:
    """Run the window stream once; returns the folder of closed windows."""
    folder = scratch_path(t.spark, "windows")
    stats = metrics.window_statistic(event_stream(t), "ts", "value", ["event_type"], 3600, "max")
    ingest.run_available(stats, f"{folder}/rows", f"{folder}/progress")
    return f"{folder}/rows"


WINDOWS_SQL = """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS period_start, event_type, max(value) AS value FROM events GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 1 HOUR, min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@query(WINDOWS_SQL)
def stream_window(t):
    return t.spark.read.parquet(closed_windows(t)).withColumn("period_start", as_ntz("period_start"))


@query(f"""
    WITH s AS (
      SELECT *, CASE WHEN value >= 60 AND coalesce(lag(value, 1) OVER w >= 60, false)
                      AND coalesce(lag(value, 2) OVER w >= 60, false) THEN 'ALARM' ELSE 'OK' END AS state
      FROM ({WINDOWS_SQL}) WINDOW w AS (PARTITION BY event_type ORDER BY period_start))
    SELECT event_type, period_start, value, state,
           coalesce(state <> lag(state) OVER (PARTITION BY event_type ORDER BY period_start), true) AS changed FROM s""")
def stream_alarm(t):
    folder = scratch_path(t.spark, "alarms")
    windows = ingest.new_files(t.spark, closed_windows(t), "period_start TIMESTAMP, event_type STRING, value DOUBLE")
    states = alarms.alarm_states(alarms.with_rule(windows, ">=", 60, 3), ["event_type"])
    ingest.run_available(states, f"{folder}/rows", f"{folder}/progress")
    return t.spark.read.parquet(f"{folder}/rows").withColumn("period_start", as_ntz("period_start"))


@query(f"""
    WITH open AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
    SELECT alarm, '{{"type":"' || event_type || '"}}' AS dimensions, period_start, value, state FROM ({STATES_SQL}), open
    WHERE period_start + CASE alarm WHEN 'high_value' THEN INTERVAL 1 HOUR ELSE INTERVAL 15 MINUTE END <= mark""")
def stream_alarm_rules(t):
    folder = scratch_path(t.spark, "rules")
    stream = event_stream(t).select("ts", F.lit("value").alias("metric_name"), measured().alias("value"),
                                    F.create_map(F.lit("type"), F.col("event_type")).alias("dimensions"))
    closed = alarms.rule_windows(stream, HOURLY_RULES)
    ingest.run_available(closed, f"{folder}/windows", f"{folder}/windows-progress")
    windows = ingest.new_files(t.spark, f"{folder}/windows", closed.schema)
    ingest.run_available(alarms.alarm_states(windows, ["alarm", "dimensions"]), f"{folder}/states",
                         f"{folder}/states-progress")
    return (t.spark.read.parquet(f"{folder}/states").withColumn("period_start", as_ntz("period_start"))
            .drop("changed"))


@query("SELECT event_id, event_type, value FROM events")
def bookmark_ingest(t):
    """Two runs over a growing folder; the second one reads only what is new."""
    folder = scratch_path(t.spark, "bookmark")
    events = t.events.select("event_id", "event_type", "value")
    late = F.col("event_type").isin("click", "view")
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(f"{folder}/in")
        ingest.run_available(ingest.new_files(t.spark, f"{folder}/in", events.schema), f"{folder}/out",
                             f"{folder}/progress")
    return t.spark.read.parquet(f"{folder}/out")


@query(f"""SELECT event_id, service AS "dd.service", source, "timestamp", level, message FROM ({LOGS_SQL})
           WHERE service = 'python-app' OR source = 'lambda'""")
def stream_logs(t):
    folder = scratch_path(t.spark, "logs")
    lines = log_lines(t)
    lines.write.json(f"{folder}/in")
    stream = ingest.new_files(t.spark, f"{folder}/in", lines.schema, "json")
    logs.archive_logs(stream, f"{folder}/out", f"{folder}/progress")
    schema = "event_id BIGINT, `dd.service` STRING, source STRING, timestamp STRING, level STRING, message STRING"
    return t.spark.read.schema(schema).json(f"{folder}/out").select(
        "event_id", "`dd.service`", "source", "timestamp", "level", "message")
