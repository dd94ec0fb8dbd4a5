"""Stored tables that grow or change in part, and sources whose shape is found in the data."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.partials import merged, partials, statistic, with_empty_buckets
from millrace.operators.shaping import resolve_choice
from millrace.plans import apm
from millrace.session import scratch_path, stored
from millrace.sinks import files, rewrites
from millrace.sinks.batches import append_once
from millrace.sinks.swap import files_below
from millrace.sources import bookmarks, discovery
from millrace.sources.files import read_pruned
from millrace.streaming import logs
from millrace.streaming.ingest import new_files
from millrace.streaming.partials import KeptWindows, append_partials

from .metrics import END, LOGS_SQL, PANEL_SECONDS, START, TRANSACTIONS_SQL, apdex_sql, log_lines, transactions
from .registry import as_ntz, cents, query


def _mixed_lines(t) -> str:
    """Events as JSON lines in which ``k`` is a number, a text or an object and ``value`` sometimes has no point."""
    path = scratch_path(t.spark, "mixed")
    n = F.get_json_object("props", "$.k")
    k = F.expr("event_id % 3")
    text = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"k":'),
        F.when(k == 0, n).when(k == 1, F.concat(F.lit('"k'), n, F.lit('"'))).otherwise(F.concat(F.lit('{"n":'), n, F.lit("}"))),
        F.lit(',"value":'), F.when(F.expr("event_id % 5 = 0"), F.lit("7")).otherwise(F.col("value").cast("decimal(18,2)").cast("string")),
        F.when(F.expr("event_id % 4 = 0"), F.concat(F.lit(',"tags":["'), "event_type", F.lit('"]'))).otherwise(""), F.lit("}"))
    t.events.select(text).write.text(path)
    return path


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k_long,
                 CASE event_id % 3 WHEN 1 THEN 'k' || json_extract_string(props, '$.k')
                                   WHEN 2 THEN '{"n":' || json_extract_string(props, '$.k') || '}' END AS k_string,
                 CASE WHEN event_id % 5 = 0 THEN 7.0 ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) END AS value,
                 CASE WHEN event_id % 4 = 0 THEN event_type END AS tag FROM events""")
def choice_columns(t):
    """JSON lines without a schema: the field of several types becomes a choice, and the choice columns of its own."""
    rows = discovery.read_json_lines(t.spark, _mixed_lines(t))
    return resolve_choice(rows, choice="make_cols").select("event_id", "k_long", "k_string", "value",
                                                           F.col("tags")[0].alias("tag"))


@query("""WITH e AS (SELECT *, event_id % 3 AS k FROM events)
    SELECT path, type, CAST(n AS BIGINT) AS "rows" FROM (
      SELECT '' AS path, 'OBJECT' AS type, count(*) AS n FROM e UNION ALL
      SELECT 'event_id', 'BIGINT', count(*) FROM e UNION ALL
      SELECT 'k', CASE k WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' ELSE 'OBJECT' END, count(*) FROM e GROUP BY k UNION ALL
      SELECT 'k.n', 'BIGINT', count(*) FROM e WHERE k = 2 UNION ALL
      SELECT 'value', CASE WHEN event_id % 5 = 0 THEN 'BIGINT' ELSE 'DOUBLE' END, count(*)
      FROM e GROUP BY ALL UNION ALL
      SELECT 'tags', 'ARRAY', count(*) FROM e WHERE event_id % 4 = 0 UNION ALL
      SELECT 'tags.[]', 'STRING', count(*) FROM e WHERE event_id % 4 = 0) WHERE n > 0""")
def choice_types(t):
    """How many records have a value of a type, for every field of the same lines: one scan, one aggregate."""
    types = discovery.field_types(t.spark.read.text(_mixed_lines(t)))
    return types.select(F.array_join("path", ".").alias("path"), "type", "rows")


@query("""SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders""")
def selective_compaction(t):
    """A partitioned folder of one large and many small files per status: the large ones stay as they are."""
    path = scratch_path(t.spark, "mostly-small")
    orders = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    late = F.col("o_orderkey") % 10 == 0
    orders.where(~late).repartition(1).write.partitionBy("o_orderstatus").parquet(path)
    large = set(files_below(t.spark, path))
    orders.where(late).repartition(6).write.mode("append").partitionBy("o_orderstatus").parquet(path)
    sizes = {r["path"]: r["bytes"] for r in rewrites._listing(t.spark, path, "*.parquet").collect()}
    small = max(b for p, b in sizes.items() if p.replace("file:///", "file:/") not in large)
    out = rewrites.compact_small(t.spark, path, small_bytes=small, target_bytes=64 << 20)
    left = set(files_below(t.spark, path))
    big = {p for p in large if sizes.get(p.replace("file:/", "file:///", 1) if "://" not in p else p, 0) > small}
    assert out["merged"] > out["written"] and big <= left and len(left) == out["kept"] + out["written"]
    return t.spark.read.parquet(path).select(*orders.columns)


CHANGED = """SELECT o_orderkey + {shift} AS o_orderkey, -o_totalprice AS o_totalprice, o_orderstatus FROM orders
             WHERE o_orderkey BETWEEN (SELECT max(o_orderkey) * 0.9 FROM orders) AND (SELECT max(o_orderkey) FROM orders)"""


@query(f"""WITH stage AS ({CHANGED.format(shift='(SELECT CAST(max(o_orderkey) * 0.05 AS BIGINT) FROM orders)')})
    SELECT * FROM stage UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM stage s WHERE s.o_orderkey = o.o_orderkey)""")
def merged_table(t):
    """Staged orders, some of them new, merged into a stored table: files below the staged keys are not touched."""
    path = scratch_path(t.spark, "orders-table")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.repartitionByRange(10, "o_orderkey").write.parquet(path)
    most = orders.agg(F.max("o_orderkey")).first()[0]
    stage = (orders.where(F.col("o_orderkey").between(F.lit(most) * 0.9, F.lit(most)))
             .select((F.col("o_orderkey") + round(most * 0.05)).alias("o_orderkey"), (-F.col("o_totalprice")).alias("o_totalprice"),
                     "o_orderstatus"))
    before = set(files_below(t.spark, path))
    out = rewrites.merge_into(t.spark, path, stage, ["o_orderkey"])
    assert out["rewritten"] <= 2 and len(before & set(files_below(t.spark, path))) == out["kept"] >= 8
    return t.spark.read.parquet(path)


@query("""SELECT o_orderkey, o_orderdate, o_totalprice, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS INT) AS part,
                 CAST(1 AS BIGINT) AS copies FROM orders""")
def bookmarked_orders(t):
    """Orders that arrive in three parts, with ties of the state key across them; the second run breaks between the
    sink's write and the commit. Each order is taken over once."""
    source, out = scratch_path(t.spark, "growing"), scratch_path(t.spark, "taken")
    mark = bookmarks.Bookmark(t.spark, scratch_path(t.spark, "marks"), "orders", ["at"])
    sink = append_once(out)
    orders = t.orders.select("o_orderkey", as_ntz("o_orderdate"), "o_totalprice")
    # The state key only grows with the part, but parts share the keys at their border.
    rows = orders.select("*", F.expr("IF(o_orderkey % 3 = 0, 1, 2)").alias("part"),
                         F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 6 + o_orderkey % 2 - IF(o_orderkey % 7 = 0, 1, 0) END").alias("at"))

    def breaks(batch, number):
        sink(batch, number)
        raise ConnectionError("lost before the commit")

    def grown(part):
        part.write.mode("append").parquet(source)
        return t.spark.read.schema(rows.schema).parquet(source)

    mark.run(grown(rows.where("part = 1")), sink)
    try:
        mark.run(grown(rows.where("part = 2 AND o_orderkey % 2 = 0")), breaks)
    except ConnectionError:
        pass
    table = grown(rows.where("part = 2 AND o_orderkey % 2 = 1"))
    mark.run(table, sink)  # the broken run once more, with the rows it had
    mark.run(table, sink)
    taken = t.spark.read.schema(rows.schema).parquet(out)
    return (taken.groupBy("o_orderkey", "o_orderdate", "o_totalprice", "part").agg(F.count("*").alias("copies")))


def minute_table(t):
    """Transactions by minute, appended by two runs; the second one reads only what is new."""
    folder = scratch_path(t.spark, "minutes")
    rows = transactions(t)
    late = F.col("ts") >= F.expr("timestamp_ntz'2024-01-12 07:30:30'")
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(f"{folder}/in")
        run = append_partials(new_files(t.spark, f"{folder}/in", rows.schema), f"{folder}/minutes", f"{folder}/progress",
                              lambda batch: apm.transaction_minutes(batch, 3000))
        assert sum(p["numInputRows"] for p in run.recentProgress) == part.count()
    return t.spark.read.parquet(f"{folder}/minutes")


def minute_panels(t):
    return apm.dashboard_of_minutes(minute_table(t), START, END)


@query(f"""
    SELECT 'requests' AS panel, '' AS facet, CAST(count(*) AS BIGINT) AS events, count(*) * 60.0::DOUBLE / {PANEL_SECONDS}::DOUBLE AS value
    FROM {TRANSACTIONS_SQL} UNION ALL
    SELECT 'errors', CAST(100.0 * count(*) FILTER (error) / count(*) > 2.5 AS VARCHAR), NULL,
           100.0::DOUBLE * count(*) FILTER (error) / count(*) FROM {TRANSACTIONS_SQL} UNION ALL
    SELECT 'durations', "appName", count(*), CAST(sum(duration) AS DOUBLE) / count(*) FROM {TRANSACTIONS_SQL} GROUP BY 2 UNION ALL
    SELECT 'names', name, count(*), count(*) * 60.0::DOUBLE / {PANEL_SECONDS}::DOUBLE FROM {TRANSACTIONS_SQL} GROUP BY 2""")
def panels_of_minutes(t):
    """The panels without a time axis, from the minute table."""
    panels = minute_panels(t)
    none = F.lit(None).cast("long").alias("events")
    return (panels["requests_per_minute"].select(F.lit("requests").alias("panel"), F.lit("").alias("facet"), "events", F.col("rate").alias("value"))
            .unionAll(panels["error_rate"].select(F.lit("errors"), F.col("red").cast("string"), none, "pct"))
            .unionAll(panels["average_duration_by_app"].select(F.lit("durations"), "appName", "events", "mean"))
            .unionAll(panels["requests_per_minute_by_name"].select(F.lit("names"), "name", "events", "rate")))


PERIODS = (60, 300, 900, 3600, 86400)


@query(" UNION ALL ".join(f"""
    SELECT {p} AS period, to_timestamp(floor(epoch(ts))::BIGINT // {p} * {p})::TIMESTAMP AS bucket_start, "appName",
           CAST(sum(duration) AS DOUBLE) / count(*) AS mean, CAST(max(duration) AS BIGINT) AS most, CAST(count(*) AS BIGINT) AS n
    FROM {TRANSACTIONS_SQL} GROUP BY ALL""" for p in PERIODS))
def periods_of_minutes(t):
    """One minute table for all periods from a minute to a day."""
    minutes = stored(minute_table(t).where((F.col("bucket_start") >= F.lit(START)) & (F.col("bucket_start") < F.lit(END))), "minutes")
    out = [merged(minutes, ["appName"], p).select(F.lit(p).alias("period"), as_ntz("bucket_start"), "appName",
                                                  statistic("avg").alias("mean"), "most", "n") for p in PERIODS]
    return reduce(DataFrame.unionAll, out)


@query(apdex_sql(TRANSACTIONS_SQL, "duration", "host", 3000) + " ORDER BY apdex DESC, host LIMIT 5")
def apdex_of_minutes(t):
    return minute_panels(t)["apdex_top5_by_host"]


@query("""
    WITH e AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, event_type, count(*) AS n FROM events
               WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06' GROUP BY 1, 2),
    g AS (SELECT DISTINCT event_type, unnest(range(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-06', INTERVAL 1 HOUR)) AS bucket_start FROM e)
    SELECT bucket_start, event_type, CAST(coalesce(n, 0) AS BIGINT) AS "rows" FROM g LEFT JOIN e USING (bucket_start, event_type)""")
def empty_buckets(t):
    """Every hour of three days for every type, also those without an event."""
    first, last = datetime(2024, 1, 3), datetime(2024, 1, 6)
    inside = t.events.where((F.col("ts") >= F.lit(first)) & (F.col("ts") < F.lit(last)))
    counts = partials(inside, "ts", ["event_type"], seconds=3600)
    return with_empty_buckets(counts, ["event_type"], first, last, 3600).withColumn("bucket_start", as_ntz("bucket_start"))


@query("""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, event_type, CAST(count(*) AS BIGINT) AS "rows",
           CAST(sum(round(value * 100)) AS BIGINT) AS total, CAST(min(round(value * 100)) AS BIGINT) AS least,
           CAST(max(round(value * 100)) AS BIGINT) AS most FROM events GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 1 HOUR, min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def late_windows(t):
    """Events in two micro-batches, most of the second behind the mark: no window loses a row."""
    folder = scratch_path(t.spark, "kept")
    rows = t.events.select("ts", "event_type", cents("value").alias("value"))
    kept = KeptWindows(t.spark, folder, "ts", ["event_type"], "value", 3600)
    second = F.expr("pmod(hash(ts), 5) = 0")
    for part in (rows.where(~second), rows.where(second)):
        part.write.mode("append").parquet(f"{folder}/in")
        kept.run(new_files(t.spark, f"{folder}/in", rows.schema), f"{folder}/progress")
    assert kept.late_rows().limit(1).count()
    return kept.windows().select(as_ntz("bucket_start"), "event_type", "rows", "total", "least", "most")


@query(f"""SELECT event_id, service AS "dd.service", source, "timestamp", level, message,
                  substr("timestamp", 1, 4) AS year, substr("timestamp", 6, 2) AS month, substr("timestamp", 9, 2) AS day
           FROM ({LOGS_SQL}) WHERE service = 'python-app' OR source = 'lambda'""")
def stream_archive(t):
    """The stream's archive in two runs, read by the batch reader with its days as columns."""
    folder = scratch_path(t.spark, "stream-archive")
    lines = log_lines(t)
    for part in (lines.where("event_id % 2 = 0"), lines.where("event_id % 2 = 1")):
        part.write.mode("append").json(f"{folder}/in")
        logs.archive_logs(new_files(t.spark, f"{folder}/in", lines.schema, "json"), f"{folder}/out", f"{folder}/progress")
    schema = ("event_id BIGINT, `dd.service` STRING, source STRING, timestamp STRING, level STRING, message STRING, "
              "year STRING, month STRING, day STRING")
    return t.spark.read.schema(schema).json(f"{folder}/out")


@query("""SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day, dayname(ts) AS name FROM events WHERE dayname(ts) = 'Sunday'""")
def pruned_by_join(t):
    """Events by day joined to the days that are Sundays: the other days' folders are not read."""
    path = scratch_path(t.spark, "pruned-days")
    days = t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    files.write_parquet(days.hint("rebalance", "day"), path, partition_by=("day",))
    calendar = stored(days.select("day").distinct().withColumn("name", F.date_format(F.to_date("day"), "EEEE")), "calendar")
    return read_pruned(t.spark, path, calendar.where("name = 'Sunday'"), ["day"], schema=days.schema)
