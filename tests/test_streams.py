"""Streams that lose nothing: late rows, lagging keys, repeated batches, minute tables."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import partials as P
from millrace.plans import apm
from millrace.plans import logs as log_jobs
from millrace.sinks import files as sinks
from millrace.sources.files import read_pruned
from millrace.streaming import alarms, ingest, logs
from millrace.streaming.partials import KeptWindows, append_partials

START = datetime(2024, 1, 1)


def events(spark, minutes, key="a"):
    rows = [(START + timedelta(minutes=m) if m is not None else None, key, v) for m, v in minutes]
    return spark.createDataFrame(rows, "ts timestamp, k string, v long")


def as_rows(df):
    return sorted((r["bucket_start"].minute + 60 * r["bucket_start"].hour, r["rows"], r["n"], r["total"], r["least"], r["most"])
                  for r in df.collect())


def test_late_rows_are_kept_and_merged(spark, tmp_path):
    kept = KeptWindows(spark, str(tmp_path / "w"), "ts", ["k"], "v", 600, delay="0 seconds")
    kept.add(events(spark, [(1, 5), (2, 7), (25, 1)]), 0)
    assert as_rows(kept.windows()) == [(0, 2, 2, 12, 5, 7)] and kept.late_rows().count() == 0
    # Late for the first window, in time for the one that is open, without a time, without a value.
    kept.add(events(spark, [(3, 100), (26, 2), (None, 9), (8, None), (41, 0)]), 1)
    assert kept.late_rows().count() == 3
    assert as_rows(kept.windows()) == [(0, 4, 3, 112, 5, 100), (20, 2, 2, 3, 1, 2)]
    before = as_rows(kept.windows(closed=False))
    # The last batch once more: nothing is added, and its mark stays.
    mark = kept.mark()
    kept.add(events(spark, [(3, 100), (26, 2), (None, 9), (8, None), (41, 0)]), 1)
    assert as_rows(kept.windows(closed=False)) == before and kept.late_rows().count() == 3 and kept.mark() == mark
    kept.roll_up()
    assert as_rows(kept.windows(closed=False)) == before
    kept.add(events(spark, [(0, 1)]), 2)
    assert as_rows(kept.windows())[0] == (0, 5, 4, 113, 1, 100)


def test_a_batch_that_broke_is_judged_by_the_same_mark(spark, tmp_path, monkeypatch):
    """It broke after its rows were added and before its mark was written."""
    from millrace.streaming import partials as module

    kept = KeptWindows(spark, str(tmp_path / "w"), "ts", ["k"], "v", 600, delay="0 seconds")
    kept.add(events(spark, [(1, 5), (15, 1)]), 0)
    batch = events(spark, [(2, 6), (55, 1)])
    monkeypatch.setattr(module, "write_text", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.add(batch, 1)
    monkeypatch.undo()
    kept.add(batch, 1)
    assert kept.late_rows().count() == 1
    assert as_rows(kept.windows()) == [(0, 2, 2, 11, 5, 6), (10, 1, 1, 1, 1, 1)]


def test_windows_of_a_stream_equal_those_of_all_rows(spark, tmp_path):
    rows = spark.range(3000).select((F.lit(START) + F.make_dt_interval(mins=F.pmod(F.xxhash64("id"), F.lit(900)))).alias("ts"),
                                    (F.col("id") % 3).cast("string").alias("k"), "id")
    rows = rows.withColumnRenamed("id", "v")
    kept = KeptWindows(spark, str(tmp_path / "w"), "ts", ["k"], "v", 3600)
    for part in range(3):
        rows.where(f"v % 3 = {part}").write.mode("append").parquet(str(tmp_path / "in"))
        kept.run(ingest.new_files(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "progress"))
    want = P.partials(rows, "ts", ["k"], "v", 3600).select("bucket_start", "k", "rows", "n", "total", "least", "most")
    assert sorted(kept.windows(closed=False).collect()) == sorted(want.collect())


def windows(spark, key, minutes_and_values):
    rows = [(START + timedelta(minutes=m), key, float(v)) for m, v in minutes_and_values]
    return spark.createDataFrame(rows, "period_start timestamp, host string, value double")


def test_a_key_that_lags_keeps_its_windows(spark, tmp_path):
    source, schema, day = str(tmp_path / "in"), "period_start TIMESTAMP, host STRING, value DOUBLE", 1440
    table = alarms.AlarmStates(spark, str(tmp_path / "table"), ["host"])

    def run(rows):
        rows.write.mode("append").parquet(source)
        stream = alarms.with_rule(ingest.new_files(spark, source, schema), ">=", 80, 2)
        ingest.run_available(alarms.alarm_states(stream, ["host"]), str(tmp_path / "out"), str(tmp_path / "progress"))
        table.run(stream, str(tmp_path / "table-progress"))

    run(windows(spark, "ahead", [(60 * day, 90), (60 * day + 1, 90)]))
    # 60 days behind, over two runs: every window is judged and the run of breaches goes on.
    run(windows(spark, "behind", [(0, 10), (1, 90)]))
    run(windows(spark, "behind", [(2, 95), (3, 1)]))
    for states in (str(tmp_path / "out"), str(tmp_path / "table" / "states")):
        got = spark.read.parquet(states).where("host = 'behind'").orderBy("period_start").collect()
        assert [(r["state"], r["changed"]) for r in got] == [("OK", True), ("OK", False), ("ALARM", True), ("OK", True)]
    assert sorted((r["host"], r["run"], r["last"]) for r in table.live().collect()) == [("ahead", 2, "ALARM"), ("behind", 0, "OK")]


def test_the_state_of_an_idle_key_goes(spark, tmp_path):
    now = [1000.0]
    table = alarms.AlarmStates(spark, str(tmp_path), ["host"], "100 seconds", clock=lambda: now[0])
    ruled = lambda *a: alarms.with_rule(windows(spark, *a), ">=", 80, 2)
    table.add(ruled("old", [(0, 90)]).unionByName(ruled(None, [(0, 90)])), 0)
    now[0] += 60
    table.add(ruled("new", [(0, 90)]).unionByName(ruled(None, [(1, 90)])), 1)
    table.add(ruled("new", [(0, 90)]).unionByName(ruled(None, [(1, 90)])), 1)  # repeated
    assert sorted(str(r["host"]) for r in table.live().collect()) == ["None", "new", "old"]
    now[0] += 60
    table.add(ruled("new", [(1, 90)]), 2)
    assert sorted(str(r["host"]) for r in table.live().collect()) == ["None", "new"]
    table.add(ruled("old", [(1, 90)]), 3)  # begins anew: one breach, where it would have been the second
    states = {(str(r["host"]), r["period_start"].minute): (r["state"], r["changed"]) for r in spark.read.parquet(f"{tmp_path}/states").collect()}
    assert states == {("old", 0): ("OK", True), ("None", 0): ("OK", True), ("new", 0): ("OK", True), ("None", 1): ("ALARM", True),
                      ("new", 1): ("ALARM", True), ("old", 1): ("OK", True)}


def lines(spark, ids):
    return spark.createDataFrame([(f"2024-01-{1 + i % 3:02d}T00:00:00Z INFO m{i}", "python-app", "lambda") for i in ids],
                                 "line string, service string, source string")


def test_the_archive_of_a_stream_has_the_layout_of_the_batch_job(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = lines(spark, range(30))
    log_jobs.archive(rows, str(tmp_path / "batch"))
    for part in (range(0, 12), range(12, 30)):
        lines(spark, part).write.mode("append").json(source)
        logs.archive_logs(ingest.new_files(spark, source, rows.schema, "json"), out, str(tmp_path / "progress"))
    folders = lambda p: sorted({str(f.parent.relative_to(p)) for f in Path(p).rglob("*.json.gz")})
    assert folders(out) == folders(tmp_path / "batch") == [f"year=2024/month=01/day=0{d}" for d in (1, 2, 3)]
    # The commit of the last batch is lost with the driver: the stream repeats it and adds nothing.
    commits = sorted((tmp_path / "progress" / "commits").iterdir())
    for gone in (commits[-1], commits[-1].parent / f".{commits[-1].name}.crc"):
        gone.unlink(missing_ok=True)
    logs.archive_logs(ingest.new_files(spark, source, rows.schema, "json"), out, str(tmp_path / "progress"))
    assert spark.read.json(out).count() == 30


def transactions(spark, n=4000):
    return spark.range(n).select(
        (F.lit(START) + F.make_dt_interval(secs=F.pmod(F.xxhash64("id"), F.lit(4 * 3600)).cast("decimal(18,6)"))).alias("ts"),
        F.concat(F.lit("app"), F.col("id") % 2).alias("appName"), F.concat(F.lit("p"), F.col("id") % 3).alias("name"),
        F.concat(F.lit("h"), F.col("id") % 11).alias("host"),
        F.when(F.col("id") % 17 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000))).alias("duration"), (F.col("id") % 29 == 0).alias("error"))


def test_panels_of_the_minute_table_are_those_of_the_events(spark, tmp_path):
    rows, table = transactions(spark), str(tmp_path / "minutes")
    counts = []
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("ts", "host"), F.lit(2)) == part).write.mode("append").parquet(str(tmp_path / "in"))
        run = append_partials(ingest.new_files(spark, str(tmp_path / "in"), rows.schema), table, str(tmp_path / "progress"),
                              lambda batch: apm.transaction_minutes(batch, 2000))
        counts.append(sum(p["numInputRows"] for p in run.recentProgress))
    assert sum(counts) == 4000 and all(counts)
    minutes, end = spark.read.parquet(table), START + timedelta(hours=3)
    want = apm.dashboard(rows, START, end, 2000)
    got = apm.dashboard_of_minutes(minutes, START, end)
    assert got.keys() == want.keys()
    for name in want:
        assert got[name].columns == want[name].columns
        assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].collect())), name
    alarm = apm.apdex_alarm(rows, 2000).select("appName", "minute", "apdex", "state")
    assert sorted(apm.apdex_alarm_of_minutes(minutes).select(*alarm.columns).collect(), key=str) == sorted(alarm.collect(), key=str)
    with pytest.raises(ValueError):
        apm.dashboard_of_minutes(minutes, START + timedelta(seconds=30), end)
    with pytest.raises(ValueError):
        apm.period_series(minutes, ["host"], 90)


def test_empty_buckets_have_counts_of_zero(spark):
    series = P.partials(events(spark, [(1, 5), (31, 6)]), "ts", ["k"], "v", 600)
    full = P.with_empty_buckets(series, ["k"], START, START + timedelta(minutes=40), 600).orderBy("bucket_start").collect()
    assert [(r["rows"], r["n"], r["total"], r["most"]) for r in full] == [(1, 1, 5, 5), (0, 0, None, None), (0, 0, None, None), (1, 1, 6, 6)]
    nothing = P.with_empty_buckets(series.limit(0).drop("k"), [], START, START + timedelta(minutes=20), 600)
    assert [r["rows"] for r in nothing.collect()] == [0, 0]


@pytest.mark.parametrize("limit", ["10485760", "3000"])
def test_a_join_prunes_the_folders(spark, tmp_path, limit):
    """The files of all other days are not parquet any more: reading one of them would fail."""
    rows = spark.range(40000).select("id", F.uuid().alias("u"), (F.col("id") % 20).cast("int").alias("day"))
    sinks.write_parquet(rows.repartition(1), str(tmp_path / "t"), partition_by=("day",))
    wide = spark.range(20).select(F.col("id").cast("int").alias("day"), (F.col("id") % 10).alias("kind"), F.lit("x" * 2000).alias("note"))
    wide.withColumn("note", F.concat("note", F.uuid())).write.parquet(str(tmp_path / "d"))
    for path in (tmp_path / "t").rglob("*.parquet"):
        if path.parent.name not in ("day=3", "day=13"):
            path.write_bytes(b"gone")
            (path.parent / f".{path.name}.crc").unlink()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        out = read_pruned(spark, str(tmp_path / "t"), spark.read.parquet(str(tmp_path / "d")).where("kind = 3"), ["day"],
                          schema=rows.schema)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert limit == "3000" or "dynamicpruning" in plan
        assert len(out.collect()) == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
