"""Rates, means, Apdex, alarms and log lines over the events table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import alarms, logs, metrics
from millrace.plans import alarms as alarm_jobs
from millrace.plans import apm

from .registry import Tables, as_ntz, cents, query

SPAN = 30 * 86400


@query(f"""SELECT event_type, CAST(count(*) AS BIGINT) AS events, count(*) * 60.0::DOUBLE / {SPAN}.0::DOUBLE AS rate
           FROM events GROUP BY event_type""")
def rate_per_minute(t):
    return metrics.event_rate(t.events, SPAN, ["event_type"])


@query(f"SELECT CAST(count(*) AS BIGINT) AS events, count(*) * 60.0::DOUBLE / {SPAN}.0::DOUBLE AS rate FROM events")
def rate_overall(t):
    return metrics.event_rate(t.events, SPAN)


@query("""SELECT pct, pct > 2.5 AS red FROM (
            SELECT 100.0::DOUBLE * count(*) FILTER (event_type = 'error') / count(*) AS pct FROM events)""")
def error_pct(t):
    return metrics.percentage(t.events, F.col("event_type") == "error", red_above=2.5)


MEAN = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*)"


@query(f"SELECT event_type, {MEAN} AS mean, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY event_type")
def avg_by_facet(t):
    return metrics.mean_by(t.events, cents("value"), ["event_type"])


@query(f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, event_type, {MEAN} AS value
           FROM events GROUP BY 1, 2""")
def avg_timeseries(t):
    series = metrics.timeseries(t.events, "ts", cents("value"), ["event_type"], "1 hour")
    return series.withColumn("bucket_start", as_ntz("bucket_start"))


def apdex_sql(table: str, duration: str, by: str, threshold: int) -> str:
    return f"""
        SELECT {by}, satisfied, tolerating, samples, (satisfied + tolerating / 2.0::DOUBLE) / samples AS apdex FROM (
          SELECT {by}, CAST(count(*) FILTER ({duration} <= {threshold}) AS BIGINT) AS satisfied,
                 CAST(count(*) FILTER ({duration} > {threshold} AND {duration} <= {4 * threshold}) AS BIGINT) AS tolerating,
                 CAST(count(*) AS BIGINT) AS samples FROM {table} GROUP BY {by})"""


@query(apdex_sql("events", "value", "user_id", 50))
def apdex_by_user(t):
    return metrics.apdex(t.events, "value", 50, ["user_id"])


@query(apdex_sql("lineitem", "l_quantity", "l_suppkey", 10) + " ORDER BY apdex DESC, l_suppkey LIMIT 5")
def apdex_top5(t):
    scores = metrics.apdex(t.lineitem, "l_quantity", 10, ["l_suppkey"])
    return metrics.top_k(scores, 5, F.col("apdex").desc(), F.col("l_suppkey"))


def points(t: Tables) -> DataFrame:
    """Events as metric points with a service dimension."""
    service = F.when(F.col("value") < 35, "python-app").otherwise("web")
    return t.events.select("ts", F.lit("system.load.1").alias("metric_name"), cents("value").alias("value"),
                           F.create_map(F.lit("service"), service, F.lit("kind"), F.col("event_type")).alias("dimensions"))


@query(f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, {MEAN} AS value FROM events
           WHERE value < 35 GROUP BY 1""")
def scoped_series(t):
    series = metrics.scoped_series(points(t), "system.load.1", {"service": "python-app"}, "1 hour")
    return series.withColumn("bucket_start", as_ntz("bucket_start"))


@query("""SELECT CAST(sum(s) AS DOUBLE) / count(*) AS mean_of_sums, CAST(count(*) AS BIGINT) AS buckets FROM (
            SELECT time_bucket(INTERVAL 1 HOUR, ts) AS b, sum(CAST(round(value * 100) AS BIGINT)) AS s FROM events
            WHERE event_type = 'purchase' GROUP BY 1)""")
def sum_then_avg(t):
    return metrics.sum_then_mean(t.events.filter(F.col("event_type") == "purchase"), "ts", cents("value"), "1 hour")


@query("""SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket_start, event_type, min(value) AS value
          FROM events GROUP BY 1, 2""")
def period_statistic(t):
    series = metrics.period_statistic(t.events, "ts", "value", ["event_type"], 900, "min")
    return series.withColumn("bucket_start", as_ntz("bucket_start"))


@query(f"""SELECT 'order_value' AS name, event_type AS kind,
                  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total, {MEAN} AS mean,
                  CAST(count(*) AS BIGINT) AS points FROM events GROUP BY event_type""")
def tag_rollup(t):
    tags = F.array(F.lit("env:prod"), F.concat(F.lit("kind:"), "event_type"))
    tagged = t.events.select(F.lit("order_value").alias("name"), cents("value").alias("cents"), tags.alias("tags"))
    return metrics.tag_rollup(tagged, "name", "cents", "tags", "kind")


HOURLY_RULES = [alarms.Rule("high_value", "value", "max", 3600, ">=", 60, 3),
                alarms.Rule("low_value", "value", "min", 900, "<=", 1, 1)]


def measured():
    """The events' values, some of them missing."""
    return F.when(F.col("user_id") % 4 != 0, F.col("value"))


MEASURED_SQL = "(SELECT ts, event_type, CASE WHEN user_id % 4 <> 0 THEN value END AS value FROM events)"


def event_points(t: Tables) -> DataFrame:
    return t.events.select("ts", F.lit("value").alias("metric_name"), measured().alias("value"),
                           F.create_map(F.lit("type"), F.col("event_type")).alias("dimensions"))


STATES_SQL = f"""
    WITH v AS (
      SELECT 'high_value' AS alarm, event_type, time_bucket(INTERVAL 1 HOUR, ts) AS period_start, max(value) AS value,
             coalesce(max(value) >= 60, false) AS b, 3 AS n FROM {MEASURED_SQL} GROUP BY 2, 3
      UNION ALL
      SELECT 'low_value', event_type, time_bucket(INTERVAL 15 MINUTE, ts), min(value), coalesce(min(value) <= 1, false), 1
      FROM {MEASURED_SQL} GROUP BY 2, 3),
    s AS (
      SELECT *, CASE WHEN n = 1 THEN b
                     ELSE b AND coalesce(lag(b, 1) OVER w, false) AND coalesce(lag(b, 2) OVER w, false) END AS hit
      FROM v WINDOW w AS (PARTITION BY alarm, event_type ORDER BY period_start))
    SELECT alarm, event_type, period_start, value, CASE WHEN hit THEN 'ALARM' ELSE 'OK' END AS state FROM s"""


@query(STATES_SQL)
def alarm_states(t):
    states = alarms.evaluate(event_points(t), HOURLY_RULES)
    return states.select("alarm", F.col("dimensions")["type"].alias("event_type"), as_ntz("period_start"), "value",
                         "state")


@query(f"""
    SELECT alarm, event_type, period_start, value, state, previous_state FROM (
      SELECT *, lag(state) OVER (PARTITION BY alarm, event_type ORDER BY period_start) AS previous_state
      FROM ({STATES_SQL}))
    WHERE previous_state IS NULL OR previous_state <> state""")
def alarm_changes(t):
    changes = alarms.evaluate(event_points(t), HOURLY_RULES, changes_only=True)
    return changes.select("alarm", F.col("dimensions")["type"].alias("event_type"), as_ntz("period_start"), "value",
                          "state", "previous_state")


@query("""
    WITH a AS (
      SELECT event_type, date_trunc('hour', ts) AS hour,
             (count(*) FILTER (value <= 30) + count(*) FILTER (value > 30 AND value <= 120) / 2.0::DOUBLE) / count(*) AS apdex
      FROM events GROUP BY 1, 2)
    SELECT event_type, hour, apdex, CASE WHEN apdex < 0.75 AND coalesce(lag(apdex, 1) OVER w < 0.75, false)
             THEN 'ALARM' ELSE 'OK' END AS state
    FROM a WINDOW w AS (PARTITION BY event_type ORDER BY hour)""")
def apdex_alarm(t):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    scores = metrics.apdex(t.events, "value", 30, ["event_type", hour])
    states = alarms.evaluate_series(scores, ["event_type"], "hour", "apdex", "<", 0.75, 2)
    return states.select("event_type", "hour", "apdex", "state")


def log_lines(t: Tables) -> DataFrame:
    """Events as log lines; sign-ups are lines of another layout."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss,SSS", "yyyy-MM-dd'T'HHmm", "yyyy-MM-dd HHmmss'+0000'")
    stamp = F.coalesce(*[F.when(F.col("event_id") % 4 == i, F.date_format("ts", f)) for i, f in enumerate(forms)])
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    line = F.when(F.col("event_type") == "signup", F.concat(F.lit("signup "), "user_id")).otherwise(
        F.concat(stamp, F.lit(" "), level, F.lit(" user "), "user_id", F.lit(" "), "props"))
    return t.events.select(
        "event_id", F.when(F.col("value") < 35, "python-app").otherwise("web").alias("service"),
        F.when(F.col("event_type") == "view", "lambda").otherwise("host").alias("source"), line.alias("line"))


LOGS_SQL = """
    SELECT event_id, CASE WHEN value < 35 THEN 'python-app' ELSE 'web' END AS service,
           CASE WHEN event_type = 'view' THEN 'lambda' ELSE 'host' END AS source,
           CASE WHEN event_type <> 'signup' THEN CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
             WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S,%g') WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H%M')
             ELSE strftime(ts, '%Y-%m-%d %H%M%S+0000') END END AS "timestamp",
           CASE WHEN event_type <> 'signup' THEN CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END END AS level,
           CASE WHEN event_type <> 'signup' THEN 'user ' || user_id || ' ' || props END AS message
    FROM events"""


@query(LOGS_SQL)
def grok_extract(t):
    return logs.parse_lines(log_lines(t)).drop("line")


@query(f"""SELECT event_id, service AS "dd.service", source, "timestamp", level, message FROM ({LOGS_SQL})
           WHERE service = 'python-app' OR source = 'lambda'""")
def log_pipeline(t):
    return logs.process(log_lines(t)).drop("line")


@query(f"SELECT event_id, message FROM ({LOGS_SQL}) WHERE service = 'python-app' AND level = 'ERROR'")
def log_search(t):
    return logs.parse_lines(log_lines(t)).filter(logs.error_logs()).select("event_id", "message")


@query("""SELECT CAST(NULL AS DOUBLE) AS pct, CAST(NULL AS BOOLEAN) AS red FROM events WHERE value < -1e9
          UNION ALL SELECT NULL, NULL FROM (SELECT count(*) FROM events)""")
def error_pct_of_nothing(t):
    """A span without events has no share of errors."""
    return metrics.percentage(t.events.filter("value < -1e9"), F.col("event_type") == "error", red_above=2.5)


@query(f"""
    SELECT event_type, satisfied, tolerating, samples,
           CASE WHEN samples > 0 THEN (satisfied + tolerating / 2.0::DOUBLE) / samples END AS apdex FROM (
      SELECT event_type, CAST(count(*) FILTER (v <= 50) AS BIGINT) AS satisfied,
             CAST(count(*) FILTER (v > 50 AND v <= 200) AS BIGINT) AS tolerating, CAST(count(v) AS BIGINT) AS samples
      FROM (SELECT event_type, CASE WHEN event_type <> 'purchase' AND user_id % 4 <> 0 THEN value END AS v FROM events)
      GROUP BY event_type)""")
def apdex_missing(t):
    """Purchases have no durations at all."""
    durations = t.events.select("event_type", F.when(F.col("event_type") != "purchase", measured()).alias("v"))
    return metrics.apdex(durations, "v", 50, ["event_type"])


# Alarm, metric number, statistic, seconds, comparison, threshold, periods.
SHIPPED_SQL = """(VALUES
    ('cluster_status_is_red', 0, 'max', 60, '>=', 1, 1), ('cluster_status_is_yellow', 1, 'max', 60, '>=', 1, 1),
    ('cluster_free_storage_space_too_low', 2, 'min', 60, '<=', 32768, 1),
    ('cluster_index_writes_blocked', 3, 'max', 300, '>=', 1, 1), ('node_count_too_low', 4, 'min', 86400, '<=', 3, 1),
    ('automated_snapshot_failure', 5, 'max', 60, '>=', 1, 1), ('cpu_utilization_too_high', 6, 'avg', 900, '>=', 80, 3),
    ('jvm_memory_pressure_too_high', 7, 'max', 900, '>=', 80, 1), ('disk_queue_depth_too_high', 8, 'max', 900, '>=', 64, 1)
    ) AS rules(alarm, metric, stat, period, op, threshold, periods)"""
METRICS = ["ClusterStatus.red", "ClusterStatus.yellow", "FreeStorageSpace", "ClusterIndexWritesBlocked", "Nodes",
           "AutomatedSnapshotFailure", "CPUUtilization", "JVMMemoryPressure", "DiskQueueDepth"]
# Whole numbers: averages do not depend on the order of rows. Storage is in other units than the rest.
READING_SQL = "CASE WHEN user_id % 9 = 2 THEN 1000 ELSE 1 END * CAST(floor(value) AS BIGINT)"
RUN_SQL = """
    SELECT alarm, dim, period_start, value, CASE WHEN hits >= periods THEN 'ALARM' ELSE 'OK' END AS state FROM (
      SELECT *, CASE WHEN periods = 1 THEN b::INT
                     WHEN periods = 3 THEN sum(b::INT) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                     ELSE sum(b::INT) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS hits
      FROM v WINDOW w AS (PARTITION BY alarm, dim ORDER BY period_start))"""


@query(f"""
    WITH g AS (
      SELECT alarm, event_type AS dim, to_timestamp(floor(epoch(ts))::BIGINT // period * period)::TIMESTAMP AS period_start,
             any_value(op) AS op, any_value(threshold) AS threshold, any_value(periods) AS periods,
             CASE any_value(stat) WHEN 'max' THEN max(x)::DOUBLE WHEN 'min' THEN min(x)::DOUBLE ELSE sum(x)::DOUBLE / count(x) END AS value
      FROM (SELECT ts, event_type, user_id % 9 AS m, {READING_SQL} AS x FROM events) JOIN {SHIPPED_SQL} ON m = metric
      GROUP BY ALL),
    v AS (SELECT *, CASE op WHEN '>=' THEN value >= threshold ELSE value <= threshold END AS b FROM g),
    s AS ({RUN_SQL})
    SELECT alarm, dim, period_start, value, state, before AS previous_state FROM (
      SELECT *, lag(state) OVER (PARTITION BY alarm, dim ORDER BY period_start) AS before FROM s)
    WHERE before IS NULL OR before <> state""")
def shipped_alarms(t):
    """The nine rules as they are shipped, over events as readings of their metrics."""
    names = F.array(*[F.lit(m) for m in METRICS])
    points = t.events.select("ts", F.get(names, (F.col("user_id") % 9).cast("int")).alias("metric_name"),
                             F.expr(READING_SQL).cast("double").alias("value"),
                             F.create_map(F.lit("type"), F.col("event_type")).alias("dimensions"))
    changes = alarm_jobs.alarm_changes(points)
    return changes.select("alarm", F.col("dimensions")["type"].alias("dim"), as_ntz("period_start"), "value", "state",
                          "previous_state")


@query(f"""
    WITH v AS (
      SELECT CASE WHEN event_type = 'error' THEN 'Cluster status red' ELSE 'cluster_free_storage_space_too_low' END AS alarm,
             event_type AS dim, date_trunc('minute', ts) AS period_start, 5 AS periods,
             CASE WHEN event_type = 'error' THEN max(x) ELSE min(x) END AS value,
             CASE WHEN event_type = 'error' THEN max(x) = 1 ELSE min(x) < 6000 END AS b
      FROM (SELECT ts, event_type, CASE WHEN event_type = 'error' THEN least(floor(value), 1) ELSE floor(value) * 150 END AS x
            FROM events WHERE user_id % 3 <> 0) GROUP BY event_type, 3)
    {RUN_SQL}""")
def domain_conditions(t):
    """The two conditions that must hold in each of five minutes, for domains with the word in their name."""
    error = F.col("event_type") == "error"
    points = t.events.select(
        "ts", F.when(error, "ClusterStatus.green").otherwise("FreeStorageSpace").alias("metric_name"),
        F.when(error, F.least(F.floor("value"), F.lit(1))).otherwise(F.floor("value") * 150).cast("double").alias("value"),
        F.create_map(F.lit("type"), F.col("event_type")).alias("dimensions"),
        F.when(F.col("user_id") % 3 != 0, "new-audience-1").otherwise("other").alias("domain_name"))
    states = alarm_jobs.domain_alarms(points)
    return states.select("alarm", F.col("dimensions")["type"].alias("dim"), as_ntz("period_start"), "value", "state")


START, END = datetime(2024, 1, 3), datetime(2024, 1, 28, 12)
TRANSACTIONS_SQL = """(SELECT ts, event_type AS "appName", 'page' || user_id % 5 AS name, 'h' || user_id % 40 AS host,
    CAST(round(value * 100) AS BIGINT) AS duration, event_type = 'error' AS error FROM events
    WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-28 12:00:00')"""
PANEL_SECONDS = (END - START).total_seconds()


def transactions(t: Tables) -> DataFrame:
    return t.events.select("ts", F.col("event_type").alias("appName"), F.concat(F.lit("page"), F.col("user_id") % 5).alias("name"),
                           F.concat(F.lit("h"), F.col("user_id") % 40).alias("host"), cents("value").alias("duration"),
                           (F.col("event_type") == "error").alias("error"))


def panel(t: Tables, name: str) -> DataFrame:
    return apm.dashboard(transactions(t), START, END, 3000)[name]


@query(f"""SELECT CAST(count(*) AS BIGINT) AS events, count(*) * 60.0::DOUBLE / {PANEL_SECONDS}::DOUBLE AS rate
           FROM {TRANSACTIONS_SQL}""")
def panel_requests(t):
    return panel(t, "requests_per_minute")


@query(f"""SELECT pct, pct > 2.5 AS red FROM (
             SELECT 100.0::DOUBLE * count(*) FILTER (error) / count(*) AS pct FROM {TRANSACTIONS_SQL})""")
def panel_errors(t):
    return panel(t, "error_rate")


@query(f"""SELECT "appName", CAST(sum(duration) AS DOUBLE) / count(*) AS mean, CAST(count(*) AS BIGINT) AS events
           FROM {TRANSACTIONS_SQL} GROUP BY 1""")
def panel_durations(t):
    return panel(t, "average_duration_by_app")


@query(f"""SELECT to_timestamp(floor(epoch(ts))::BIGINT // 43200 * 43200)::TIMESTAMP AS bucket_start, "appName",
                  CAST(sum(duration) AS DOUBLE) / count(*) AS value FROM {TRANSACTIONS_SQL} GROUP BY 1, 2""")
def panel_duration_series(t):
    """The bucket width follows from the span: 25.5 days in about 80 buckets give half a day."""
    return panel(t, "average_duration").withColumn("bucket_start", as_ntz("bucket_start"))


@query(apdex_sql(TRANSACTIONS_SQL, "duration", "host", 3000) + " ORDER BY apdex DESC, host LIMIT 5")
def panel_apdex(t):
    return panel(t, "apdex_top5_by_host")


@query(f"""SELECT name, CAST(count(*) AS BIGINT) AS events, count(*) * 60.0::DOUBLE / {PANEL_SECONDS}::DOUBLE AS rate
           FROM {TRANSACTIONS_SQL} GROUP BY 1""")
def panel_requests_by_name(t):
    return panel(t, "requests_per_minute_by_name")


@query(f"""
    WITH a AS (
      SELECT "appName", date_trunc('minute', ts) AS minute, CAST(count(*) FILTER (duration <= 3000) AS BIGINT) AS satisfied,
             CAST(count(*) FILTER (duration > 3000 AND duration <= 12000) AS BIGINT) AS tolerating,
             CAST(count(*) AS BIGINT) AS samples FROM {TRANSACTIONS_SQL} GROUP BY 1, 2),
    b AS (SELECT *, (satisfied + tolerating / 2.0::DOUBLE) / samples AS apdex FROM a)
    SELECT *, CASE WHEN sum((apdex < 0.75)::INT) OVER (PARTITION BY "appName" ORDER BY minute
                                                      ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) >= 5
                   THEN 'ALARM' ELSE 'OK' END AS state FROM b""")
def apdex_five_minutes(t):
    inside = transactions(t).filter((F.col("ts") >= F.lit(START)) & (F.col("ts") < F.lit(END)))
    return apm.apdex_alarm(inside, 3000).withColumn("minute", as_ntz("minute"))
