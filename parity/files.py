"""Sinks read back, and sources over what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.shaping import relationalize
from millrace.plans.logs import archive
from millrace.plans.words import count_words
from millrace.session import scratch_path
from millrace.sinks import files as sinks
from millrace.sinks import items
from millrace.sources import catalog
from millrace.sources import files as sources

from .metrics import LOGS_SQL, log_lines
from .registry import WORDS_SQL, as_ntz, query


NOTE = """CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'say "' || o_orderpriority || '",' || {line_feed} || 'then |' ELSE o_orderpriority END"""
NOTE_SQL = NOTE.format(line_feed="chr(10)")


@query(f"SELECT o_orderkey, o_totalprice, o_orderdate, {NOTE_SQL} AS note FROM orders")
def csv_roundtrip(t):
    """Numbers, times, quotes, separators, line breaks and missing texts."""
    path = scratch_path(t.spark, "csv")
    orders = t.orders.select("o_orderkey", "o_totalprice", as_ntz("o_orderdate"),
                             F.expr(NOTE.format(line_feed="chr(10)")).alias("note"))
    sinks.write_csv(orders, path, separator="|")
    return sources.read_csv(t.spark, [path], separator="|", schema=orders.schema, multiline=True)


SUPPLIERS = "s_suppkey, s_name || chr(10) || '\"' AS s_name, s_nationkey, s_acctbal"


@query(f"""SELECT *, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS line
           FROM (SELECT {SUPPLIERS} FROM supplier)""")
def single_file(t):
    """A sorted frame in several tasks gives one sorted file."""
    path = f"{scratch_path(t.spark, 'single')}/suppliers.csv"
    rows = t.supplier.select("s_suppkey", F.concat("s_name", F.lit('\n"')).alias("s_name"), "s_nationkey", "s_acctbal")
    ordered = rows.repartitionByRange(5, F.desc("s_acctbal"), "s_suppkey").sortWithinPartitions(F.desc("s_acctbal"), "s_suppkey")
    written = sinks.write_single_file(ordered, path)
    back = sources.read_csv(t.spark, written, schema=rows.schema, multiline=True)
    return back.withColumn("line", F.monotonically_increasing_id())


@query(f"""WITH {WORDS_SQL}
    SELECT '(' || word || ',' || count(*) || ')' AS value FROM words GROUP BY word""")
def text_pairs(t):
    """Documents written as text files, counted by the word-count job, and its output read back."""
    folder = scratch_path(t.spark, "pairs")
    t.documents.select("text").write.text(f"{folder}/in")
    count_words(t.spark, f"{folder}/in", f"{folder}/out")
    return sources.read_text(t.spark, f"{folder}/out")


@query("""SELECT * EXCLUDE (o_totalprice), CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS o_totalprice
          FROM orders""")
def compact_files(t):
    """Small files of two schemas; the older ones lack a column."""
    small, large = scratch_path(t.spark, "small"), scratch_path(t.spark, "large")
    old = F.col("o_orderkey") % 3 == 0
    t.orders.filter(old).drop("o_totalprice").repartition(8).write.parquet(small)
    t.orders.filter(~old).repartition(16).write.mode("append").parquet(small)
    sinks.compact(t.spark, small, large, "parquet", pattern="part-*", target_bytes=64 << 20)
    return t.spark.read.parquet(large)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def item_puts(t):
    """Every supplier put in two commits, the second with two writes per key; a put that fails leaves all as it was."""
    path = scratch_path(t.spark, "items")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    items.create_items(path, rows.schema, ["s_suppkey"], buckets=8)
    items.put(t.supplier.select("s_suppkey", F.lit("old").alias("s_name"), F.lit(0.0).alias("s_acctbal")), path)
    older = t.supplier.select("s_suppkey", F.lit("older").alias("s_name"), F.lit(0.0).alias("s_acctbal"), F.lit(1).alias("at"))
    items.put(older.unionByName(rows.withColumn("at", F.lit(2))), path, order=["at"])
    broken = rows.withColumn("s_name", F.when(F.col("s_suppkey") == 7, F.raise_error(F.lit("no such name"))).otherwise("x"))
    try:
        items.put(broken, path)
    except Exception as error:  # noqa: BLE001
        assert "no such name" in str(error)
    else:
        raise AssertionError("a put that fails must not pass")
    return items.read_items(t.spark, path)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def refreshed_orders(t):
    """A registered folder that another job rewrites, read again after a refresh."""
    path = scratch_path(t.spark, "refresh")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    orders.filter("o_orderstatus = 'F'").write.parquet(path)
    catalog.register(t.spark, {"orders": {"path": path, "format": "parquet"}}, prefix="rewritten_")
    before = t.spark.table("rewritten_orders").count()
    orders.write.mode("overwrite").parquet(path)
    catalog.refresh(t.spark, table="rewritten_orders", path=path)
    assert t.spark.table("rewritten_orders").count() > before
    return t.spark.table("rewritten_orders")


@query(f"""SELECT event_id, service AS "dd.service", source, "timestamp", level, message,
                  substr("timestamp", 1, 4) AS year, substr("timestamp", 6, 2) AS month, substr("timestamp", 9, 2) AS day
           FROM ({LOGS_SQL}) WHERE service = 'python-app' OR source = 'lambda'""")
def archive_roundtrip(t):
    """All processed lines, those of another layout in the partition without a day."""
    path = scratch_path(t.spark, "archive")
    rows = archive(log_lines(t), path)
    return t.spark.read.schema(rows.schema).json(path).drop("line")


@query("""SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events
          WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""")
def partition_prune(t):
    path = scratch_path(t.spark, "by-day")
    days = t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sinks.write_parquet(days.hint("rebalance", "day"), path, partition_by=("day",))
    return sources.read_partitions(t.spark, path, F.col("day").between("2024-01-08", "2024-01-14"),
                                   schema=days.schema)


@query("""SELECT mode, event_id, user_id, json_extract_string(props, '$.k') AS k FROM events, (VALUES ('file'), ('line')) m(mode)""")
def json_array(t):
    """Files that each hold one array, over several lines with several elements each, read whole and line by line."""
    path = scratch_path(t.spark, "json-array")
    record = F.struct("event_id", "user_id", F.from_json("props", "k STRING").alias("props"))
    # Up to 500 elements per file, a line break after every third.
    arrays = t.events.groupBy(F.expr("event_id div 500").alias("file")).agg(F.collect_list(record).alias("rows"))
    pieces = F.transform("rows", lambda row, i: F.concat(F.to_json(row), F.when(i % 3 == 2, "\n").otherwise("")))
    text = F.concat(F.lit("["), F.array_join(pieces, ","), F.lit("]"))
    arrays.select("file", text.alias("value")).repartition("file").write.partitionBy("file").text(path)
    schema = "event_id BIGINT, user_id BIGINT, props STRUCT<k: STRING>"
    whole = sources.read_json_array(t.spark, f"{path}/*", schema).withColumn("mode", F.lit("file"))
    lines = sources.read_json_array(t.spark, f"{path}/*", schema, per_line=True).withColumn("mode", F.lit("line"))
    return whole.unionByName(lines).select("mode", "event_id", "user_id", "props.k")


@query("""SELECT r_name, CAST(count(*) AS BIGINT) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def registered_sql(t):
    found = catalog.discover(t.spark, t.folder, "*n*", "parquet")
    found["customer"] = {"path": f"{t.folder}/customer.parquet", "format": "parquet"}
    catalog.register(t.spark, found, prefix="found_")
    assert "found_customer" in catalog.show_tables(t.spark, "found_*")
    return catalog.query(t.spark, """
        SELECT r_name, count(*) AS customers FROM found_customer JOIN found_nation ON c_nationkey = n_nationkey
        JOIN found_region ON n_regionkey = r_regionkey GROUP BY r_name""")


@query("""SELECT doc_id AS id, CAST(i AS INT) AS "index", words[i + 1] AS val FROM (
            SELECT doc_id, words, unnest(range(len(words))) AS i FROM (
              SELECT doc_id, string_split(source || '/' || lang, '/') AS words FROM documents))""")
def relationalized_tables(t):
    """All tables of a relationalized root are written; the child table is read back."""
    folder = scratch_path(t.spark, "tables")
    nested = t.documents.select("doc_id", F.struct("n_chars", "lang").alias("about"),
                                F.split(F.concat_ws("/", "source", "lang"), "/").alias("path"))
    sinks.write_tables(relationalize(nested, "docs", key="doc_id"), folder)
    return t.spark.read.parquet(f"{folder}/docs_path")
