from datetime import datetime, timedelta

import pytest

from millrace.operators import alarms, logs, metrics
from millrace.plans import alarms as alarm_jobs
from millrace.plans import apm

START = datetime(2024, 1, 1)


def transactions(spark):
    rows = [(START + timedelta(seconds=30 * i), "shop", f"t{i % 2}", f"h{i % 7}", 0.1 * i, i % 10 == 0)
            for i in range(40)]
    return spark.createDataFrame(rows, "ts TIMESTAMP, appName STRING, name STRING, host STRING, duration DOUBLE, error BOOLEAN")


def test_dashboard(spark):
    panels = apm.dashboard(transactions(spark), START, START + timedelta(minutes=20), 0.5)
    assert panels["requests_per_minute"].first()["rate"] == 2.0
    assert tuple(panels["error_rate"].first()) == (10.0, True)
    assert panels["average_duration_by_app"].first()["mean"] == pytest.approx(1.95)
    assert panels["average_duration"].count() == 40
    assert len(panels["apdex_top5_by_host"].collect()) == 5
    assert {r["name"]: r["rate"] for r in panels["requests_per_minute_by_name"].collect()} == {"t0": 1.0, "t1": 1.0}


def test_apdex_limits(spark):
    df = spark.createDataFrame([(0.5,), (0.51,), (2.0,), (2.01,)], "duration DOUBLE")
    row = metrics.apdex(df, "duration", 0.5).first()
    assert (row["satisfied"], row["tolerating"], row["samples"], row["apdex"]) == (1, 2, 4, 0.5)


def test_apdex_alarm_needs_all_five_minutes(spark):
    slow = [9.0] * 5 + [0.1] + [9.0] * 4
    rows = [(START + timedelta(minutes=i), "shop", "t", "h", d, False) for i, d in enumerate(slow)]
    df = spark.createDataFrame(rows, transactions(spark).schema)
    states = apm.apdex_alarm(df, 0.5).orderBy("minute").collect()
    assert [r["state"] for r in states] == ["OK"] * 4 + ["ALARM"] + ["OK"] * 5


def test_auto_width():
    assert metrics.auto_width(START, START + timedelta(hours=1)) == "60 seconds"
    assert metrics.auto_width(START, START + timedelta(days=3650)) == f"{604800 * 7} seconds"


def point(minute, name, value, dims):
    return (START + timedelta(minutes=minute), name, float(value), dims)


SCHEMA = "ts TIMESTAMP, metric_name STRING, value DOUBLE, dimensions MAP<STRING, STRING>"


def test_rules(spark):
    a, b = {"DomainName": "a", "ClientId": "1"}, {"ClientId": "1", "DomainName": "b"}
    cpu = [point(15 * i, "CPUUtilization", v, a) for i, v in enumerate([90, 90, 90, 10, 90, 90])]
    red = [point(0, "ClusterStatus.red", 0, a), point(1, "ClusterStatus.red", 1, a), point(9, "ClusterStatus.red", 0, a)]
    storage = [point(0, "FreeStorageSpace", 32768, b), point(1, "FreeStorageSpace", 40000, b), point(1, "Other", 1, b)]
    points = spark.createDataFrame(cpu + red + storage, SCHEMA)
    states = alarms.evaluate(points, alarms.RULES).collect()
    by_alarm = {}
    for r in sorted(states, key=lambda r: r["period_start"]):
        by_alarm.setdefault((r["alarm"], r["dimensions"]["DomainName"]), []).append(r["state"])
    assert by_alarm == {
        ("cpu_utilization_too_high", "a"): ["OK", "OK", "ALARM", "OK", "OK", "OK"],
        ("cluster_status_is_red", "a"): ["OK", "ALARM", "OK"],
        ("cluster_free_storage_space_too_low", "b"): ["ALARM", "OK"],
    }
    changes = alarm_jobs.alarm_changes(points).filter("alarm = 'cpu_utilization_too_high'").orderBy("period_start")
    assert [(r["previous_state"], r["state"]) for r in changes.collect()] == [
        (None, "OK"), ("OK", "ALARM"), ("ALARM", "OK")]


def test_alarm_names_must_differ():
    with pytest.raises(ValueError):
        alarms.rules_by_metric([alarms.RULES[0], alarms.RULES[0]])


def test_dimension_order_does_not_split_a_series(spark):
    points = spark.createDataFrame([point(0, "Nodes", 5, {"x": "1", "y": "2"}), point(1, "Nodes", 2, {"y": "2", "x": "1"})],
                                   SCHEMA)
    assert [r["value"] for r in alarms.period_values(points, alarms.RULES).collect()] == [2.0]


def test_domain_conditions(spark):
    rows = [(*point(i, "FreeStorageSpace", 5999, {"d": "x"}), "my-audience-1") for i in range(5)]
    rows += [(*point(i, "FreeStorageSpace", 1, {"d": "y"}), "other") for i in range(5)]
    points = spark.createDataFrame(rows, SCHEMA + ", domain_name STRING")
    states = alarm_jobs.domain_alarms(points).orderBy("period_start").collect()
    assert [r["state"] for r in states] == ["OK"] * 4 + ["ALARM"]


def test_tag_rollup(spark):
    df = spark.createDataFrame([("myapp.order_value", 42.99, ["env:prod", "service:my-lambda"]),
                                ("myapp.order_value", 7.01, ["env:dev"])], "name STRING, value DOUBLE, tags ARRAY<STRING>")
    out = {r["env"]: (r["total"], r["points"]) for r in metrics.tag_rollup(df, "name", "value", "tags", "env").collect()}
    assert out == {"prod": (42.99, 1), "dev": (7.01, 1)}


def test_log_pipeline(spark, rows):
    df = spark.createDataFrame([("python-app", "host", "2024-01-02 03:04:05,6 ERROR broke"), ("web", "lambda", "free text"),
                                ("web", "host", "2024-01-02T03:04:05Z INFO ok")],
                               "service STRING, source STRING, line STRING")
    out = logs.process(df)
    assert rows(out.select("`dd.service`", "level", "message")) == [
        ("python-app", "ERROR", "broke"), ("web", None, None)]
    assert rows(logs.parse_lines(df).filter(logs.error_logs()).select("message")) == [("broke",)]
