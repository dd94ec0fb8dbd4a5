import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.plans import logs as log_jobs
from millrace.plans.words import count_words
from millrace.sinks import files as sinks
from millrace.sinks.items import put_items
from millrace.sources import catalog, files, generate, jdbc
from millrace.streaming import alarms, ingest, metrics


def test_single_file_is_named_whole_and_alone(spark, tmp_path):
    target = tmp_path / "out" / "list.csv"
    target.parent.mkdir()
    (target.parent / "aaa-older.csv").write_text("stale")
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, 'a "b"\nc').otherwise("").alias("t"),
                                 F.lit(None).cast("string").alias("n")).repartition(5)
    assert sinks.write_single_file(df, str(target)) == str(target)
    assert sorted(p.name for p in target.parent.iterdir() if not p.name.startswith(".")) == ["aaa-older.csv", "list.csv"]
    back = spark.read.options(header=True, multiLine=True).csv(str(target))
    assert back.count() == 100 and back.filter("t = 'a \"b\"\nc'").count() == 50
    sinks.write_single_file(spark.range(3), str(target))
    assert target.read_text().splitlines()[0] == "id" and len(target.read_text().splitlines()) == 4


def test_single_file_is_one_file_at_any_size_and_in_order(spark, tmp_path):
    target = tmp_path / "big.csv"
    rows = spark.range(300000, numPartitions=7).selectExpr("299999 - id AS id", "repeat('y', 300) AS t")
    sinks.write_single_file(rows.repartitionByRange(9, "id").sortWithinPartitions("id"), str(target))
    assert target.is_file() and target.stat().st_size > 64 << 20
    with target.open() as lines:
        assert next(lines) == "id,t\n"
        assert [int(line.split(",")[0]) for line in lines] == list(range(300000))
    assert not list(tmp_path.glob(".staging-*")) and not list(tmp_path.glob("*.old-*"))
    with pytest.raises(ValueError):
        sinks.write_single_file(rows, str(target), "parquet")


def test_single_file_survives_a_failed_write(spark, tmp_path):
    target = tmp_path / "list.csv"
    sinks.write_single_file(spark.range(3), str(target))
    before = target.read_text()
    with pytest.raises(Exception, match="wrong"):
        sinks.write_single_file(spark.range(3).selectExpr("CAST(raise_error('wrong') AS INT) AS id"), str(target))
    assert target.read_text() == before and not list(tmp_path.glob(".staging-*"))


def test_write_parts(spark, tmp_path):
    sinks.write_parts(spark.range(1000, numPartitions=4), str(tmp_path / "parts"))
    assert len(list((tmp_path / "parts").glob("part-*"))) == 4
    assert files.read_csv(spark, str(tmp_path / "parts")).count() == 1000


def test_compact(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id * 2 AS d").repartition(20).write.option("header", True).csv(str(tmp_path / "in"))
    (tmp_path / "in" / "notes.txt").write_text("not data")
    schema = "id BIGINT, d BIGINT"
    n = sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), "csv", "part-*.csv", schema=schema, header=True)
    assert n == 20 and len(list((tmp_path / "out").glob("part-*"))) == 1
    assert files.read_csv(spark, str(tmp_path / "out")).selectExpr("sum(id)").first()[0] == 499500
    many = sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "out4"), "csv", "part-*.csv", target_bytes=2500,
                         schema=schema, header=True)
    assert many == 20 and 1 < len(list((tmp_path / "out4").glob("part-*"))) < 20
    with pytest.raises(FileNotFoundError):
        sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "x"), "csv", "none-*", schema=schema)
    with pytest.raises(ValueError):
        sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "x"), "csv")


@pytest.mark.parametrize("older_first", [True, False])
def test_compact_keeps_columns_that_only_some_files_have(spark, tmp_path, older_first):
    frames = [spark.range(5), spark.range(5, 9).withColumn("extra", F.lit("x"))]
    for df in frames if older_first else reversed(frames):
        df.write.mode("append").parquet(str(tmp_path / "in"))
    sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), "parquet")
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(out.columns) == ["extra", "id"] and out.count() == 9 and out.filter("extra = 'x'").count() == 4


@pytest.mark.parametrize("text", ['[{"a":1},{"a":2}]', '[ {"a":1}, {"a":2} ]', '[\n{"a":1},\n{"a":2}\n]\n', '[{"a":1}\n,{"a":2}]',
                                  '\n [\t{"a":1},{"a":2},\n]'])
def test_json_arrays_lose_no_record(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    rows = files.read_json_array(spark, str(tmp_path / "a.json"), "a INT", per_line=True)
    assert sorted(r["a"] for r in rows.collect()) == [1, 2]


def test_json_array_line_that_does_not_parse(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a":1},\nbroken\n]')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.read_json_array(spark, str(tmp_path / "a.json"), "a INT", per_line=True).collect()


def test_repeated_table_names_are_an_error(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "orders.parquet"))
    (tmp_path / "orders.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="orders"):
        catalog.discover(spark, str(tmp_path))


def test_csv_sources(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"id|v\n1|{name}\n")
    df = files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], separator="|")
    assert dict(df.dtypes) == {"id": "string", "v": "string"} and df.count() == 2
    typed = files.read_csv(spark, str(tmp_path / "a.csv"), separator="|", schema="id INT, v STRING")
    assert typed.first()["id"] == 1


def test_word_count_job(spark, tmp_path):
    (tmp_path / "in.txt").write_text("to be or\n\nnot to be")
    count_words(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == ["(,1)", "(be,2)", "(not,1)", "(or,1)", "(to,2)"]


def test_log_days_of_all_accepted_times(spark):
    from millrace.operators.logs import parse_lines, with_event_day

    times = ["2024-01-02 03:04:05,6", "2024-01-02T0304", "2024-01-02 030405.25", "2024-01-02T03:04Z", "2024-01-02T01:04:05+0200",
             "2024-01-02 03:04:05-03:00"]
    df = spark.createDataFrame([(f"{t} INFO x",) for t in times], "line STRING")
    days = [(r["year"], r["month"], r["day"]) for r in with_event_day(parse_lines(df)).collect()]
    assert days == [("2024", "01", "02")] * 4 + [("2024", "01", "01"), ("2024", "01", "02")]


def test_log_archive(spark, tmp_path):
    lines = [("python-app", "host", f"2024-01-0{d}T10:00:00Z INFO n{i}") for d in (1, 2) for i in range(5)]
    df = spark.createDataFrame(lines + [("other", "host", "x")], "service STRING, source STRING, line STRING")
    log_jobs.archive(df, str(tmp_path / "logs"))
    found = sorted((tmp_path / "logs").glob("year=2024/month=01/day=*/*.json.gz"))
    assert {p.parent.name for p in found} == {"day=01", "day=02"}
    with gzip.open(found[0], "rt") as handle:
        assert json.loads(handle.readline())["dd.service"] == "python-app"
    one = files.read_partitions(spark, str(tmp_path / "logs"), F.col("day") == 2, "json")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().toString()


def test_put_items_is_repeatable(spark, tmp_path):
    folder = str(tmp_path)

    def put(batch):
        for item in batch:
            name = Path(folder) / f"{item['pk']}-{item['sk']}.json"
            name.write_text(json.dumps(item["filler"]["S"][:1] + str(len(item["filler"]["S"]))))

    grid = generate.key_grid(spark)
    assert grid.count() == 100
    put_items(grid, put, ["pk", "sk"])
    put_items(grid, put, ["pk", "sk"])
    assert len(list(tmp_path.iterdir())) == 100 and (tmp_path / "3-4.json").read_text() == '"x1000"'
    newer = grid.limit(1).selectExpr("pk", "sk", "named_struct('S', 'yy') AS filler", "2 AS at")
    both = grid.selectExpr("*", "1 AS at").union(newer)
    put_items(both, put, ["pk", "sk"], order=["at"])
    assert sum(p.read_text() == '"y2"' for p in tmp_path.iterdir()) == 1


def test_catalog(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "dw_one.parquet"))
    spark.range(4).write.json(str(tmp_path / "dw_two.json"))
    spark.range(5).write.parquet(str(tmp_path / "other.parquet"))
    found = catalog.discover(spark, str(tmp_path), "dw_*")
    assert {k: v["format"] for k, v in found.items()} == {"dw_one": "parquet", "dw_two": "json"}
    catalog.register(spark, found, prefix="cat_")
    assert catalog.show_tables(spark, "cat_*") == ["cat_dw_one", "cat_dw_two"]
    assert catalog.query(spark, "SELECT DISTINCT id FROM cat_dw_two LIMIT 15").count() == 4
    assert catalog.query(spark, "SELECT count(*) FROM {t}", t=spark.range(9)).first()[0] == 9
    spark.range(7).write.mode("overwrite").parquet(str(tmp_path / "dw_one.parquet"))
    catalog.refresh(spark, table="cat_dw_one", path=str(tmp_path / "dw_one.parquet"))
    assert spark.table("cat_dw_one").count() == 7
    catalog.use(spark, "default")


def test_persistent_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "one.parquet"))
    (tmp_path / "two.csv").write_text("id,v\n1,a\n")
    found = catalog.discover(spark, str(tmp_path))
    found["two"] |= {"schema": "id INT, v STRING", "options": {"header": "true"}}
    names = catalog.register(spark, found, prefix="kept_", persist=True)
    try:
        assert sorted(names) == ["kept_one", "kept_two"]
        assert sorted(catalog.register(spark, found, prefix="kept_", persist=True)) == sorted(names)
        assert spark.table("kept_one").count() == 3 and tuple(spark.table("kept_two").first()) == (1, "a")
        assert not any(t.isTemporary for t in spark.catalog.listTables() if t.name.startswith("kept_"))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name in ("left_side", "right_side"):
        sinks.write_bucketed(spark.range(1000).withColumn(f"{name}_v", F.col("id") * 2), name, str(tmp_path / name),
                             ("id",), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_side").join(spark.table("right_side"), "id")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("left_side", "right_side"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_literal_frames(spark):
    df = generate.frame(spark, [(8, "bat"), (64, "mouse")], [("number", generate.T.IntegerType(), True),
                                                            ("word", generate.T.StringType(), True)])
    assert df.schema.simpleString() == "struct<number:int,word:string>"
    assert generate.frame(spark, [(8, "bat")], ["number", "word"]).columns == ["number", "word"]


def test_jdbc_options():
    plain = jdbc.scan_options("jdbc:x", "dw.t", user="u")
    assert plain["dbtable"] == "dw.t" and plain["user"] == "u" and "partitionColumn" not in plain
    split = jdbc.scan_options("jdbc:x", "dw.t", "id", 0, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["numPartitions"]) == ("id", "0", "8")
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "dw.t", "id")


def test_bookmarks(spark, tmp_path):
    source, out, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    counts = []
    for rows in (5, 0, 3):
        if rows:
            spark.range(rows).write.mode("append").parquet(source)
        ingest.run_available(ingest.new_files(spark, source, "id BIGINT"), out, memory)
        counts.append(spark.read.parquet(out).count())
    assert counts == [5, 5, 8]


def test_streaming_alarm_keeps_state_between_runs(spark, tmp_path):
    source, windows, states = (str(tmp_path / n) for n in ("in", "w", "s"))

    def run(minutes_and_values):
        rows = ", ".join(f"(timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, {m}), 'a', {v}D)"
                         for m, v in minutes_and_values)
        spark.sql(f"SELECT * FROM VALUES {rows} AS t(ts, host, value)").write.mode("append").parquet(source)
        stream = ingest.new_files(spark, source, "ts TIMESTAMP, host STRING, value DOUBLE")
        stats = metrics.window_statistic(stream, "ts", "value", ["host"], 60, "max", delay="0 seconds")
        ingest.run_available(stats, windows, f"{tmp_path}/wm")
        closed = ingest.new_files(spark, windows, spark.read.parquet(windows).schema)
        ingest.run_available(alarms.alarm_states(alarms.with_rule(closed, ">=", 80, 3), ["host"]), states, f"{tmp_path}/sm")
        got = spark.read.parquet(states).orderBy("period_start").collect()
        return [(r["state"], r["changed"]) for r in got]

    # The newest minute stays open until a later point arrives.
    assert run([(0, 90), (1, 90), (2, 10)]) == [("OK", True), ("OK", False)]
    # The late point of minute 0 is dropped. Minute 2 got a higher value before it closed; 4 and 5 never came.
    assert run([(0, 999), (2, 95), (3, 10), (6, 1)]) == [("OK", True), ("OK", False), ("ALARM", True), ("OK", True)]


def test_shared_folder(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_shared_folder_is_configured_or_below_the_warehouse():
    class Stub:
        def __init__(self, **conf):
            self.settings = conf
            self.conf = self.sparkContext = self

        def get(self, name, default=None):
            return self.settings.get(name, default)

        def getCheckpointDir(self):
            return None

    assert session.shared_dir(Stub(**{"spark.checkpoint.dir": "hdfs://x/tmp/"})) == "hdfs://x/tmp"
    assert session.shared_dir(Stub(**{"spark.sql.warehouse.dir": "hdfs://x/wh"})) == "hdfs://x/wh/millrace-scratch"


def test_scratch_data_goes_with_its_owner(spark):
    with session.scratch(spark):
        df = session.stored(spark.range(5), "owned")
        folder = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert df.count() == 5 and Path(folder).is_dir()
    assert not Path(folder).exists()


def test_sizes_follow_the_data():
    small = session.sizes(shuffle_bytes=1 << 30, scan_bytes=1 << 30)
    large = session.sizes(shuffle_bytes=20 << 40, scan_bytes=100 << 40)
    parts, scan = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    assert (small[parts], large[parts]) == ("200", str((20 << 40) // (128 << 20)))
    assert small[scan] == str(128 << 20) and (128 << 20) < int(large[scan]) <= 1 << 30
    assert session.sizes() == {}


def test_parts_beyond_five_digits_stay_in_order():
    names = [f"/t/part-{n:05d}-x-c000.csv" for n in (0, 9, 99999, 100000, 100001, 1000000)]
    assert sorted(reversed(names), key=sinks.part_order) == names and sorted(names) != names


def test_a_json_array_above_the_named_size_is_refused(spark, tmp_path):
    (tmp_path / "small.json").write_text('[{"a": 1},\n {"a": 2}]')
    read = lambda limit: files.read_json_array(spark, str(tmp_path), "a INT", file_bytes=limit).count()
    assert read(None) == read(1000) == 2
    (tmp_path / "large.json").write_text("[" + ", ".join('{"a": 3}' for _ in range(200)) + "]")
    with pytest.raises(ValueError, match="one task"):
        read(1000)
    assert files.read_json_array(spark, str(tmp_path), "a INT", per_line=True, file_bytes=10).count() == 202
