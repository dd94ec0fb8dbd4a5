"""Sources whose shape or new rows are found in the data: choice columns, bookmarks."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shaping import resolve_choice
from millrace.sinks.batches import append_batch, append_once, is_committed
from millrace.sources import bookmarks, discovery

LINES = ['{"id":1,"a":5,"b":{"x":1.5,"y":[1,2]},"w d":true}', '{"id":2,"a":"five","b":{"x":2,"y":["q"]},"e,f: <g>":1}',
         '{"id":3,"a":null,"b":7}', '{"id":4.25,"z":[],"n":null,"DECIMAL(3,2)":1.25}', "not json", "", "  ",
         '{"q`t":[{"k":1},{"k":"s"}]}', '{"id":5,"big":12345678901234567890123,"e":1e300}', '{"o":{"p":1}}', '{"o":{"r":"s"}}']


def test_types_of_fields_are_merged(spark):
    types = discovery.field_types(spark.createDataFrame([(line,) for line in LINES] + [(None,)], "value string"))
    counts = {(tuple(r["path"]), r["type"]): r["rows"] for r in types.collect()}
    assert counts[(), "OBJECT"] == 8 and counts[(), "MALFORMED"] == 1
    assert counts[("a",), "BIGINT"] == counts[("a",), "STRING"] == counts[("a",), "VOID"] == 1
    schema = discovery.discovered_schema(types)
    variant = T.VariantType()
    assert schema == T.StructType([
        T.StructField("DECIMAL(3,2)", T.DoubleType()), T.StructField("a", variant), T.StructField("b", variant),
        T.StructField("big", T.DoubleType()), T.StructField("e", T.DoubleType()), T.StructField("e,f: <g>", T.LongType()),
        T.StructField("id", T.DoubleType()), T.StructField("n", T.StringType()),
        T.StructField("o", T.StructType([T.StructField("p", T.LongType()), T.StructField("r", T.StringType())])),
        T.StructField("q`t", T.ArrayType(T.StructType([T.StructField("k", variant)]))),
        T.StructField("w d", T.BooleanType()), T.StructField("z", T.ArrayType(T.StringType()))])
    mixed = {r["path"]: r["types"] for r in discovery.choices(types).collect()}
    assert mixed == {"a": ["BIGINT", "STRING"], "b": ["BIGINT", "OBJECT"], "b.y[]": ["BIGINT", "STRING"], "q`t[].k": ["VARIANT"]}


def test_partial_states_merge_to_the_same_schema(spark):
    """The aggregate of parts, added up, is that of all lines, in whatever order."""
    lines = [line for line in LINES if line.startswith("{")]
    whole = discovery.merge_types([f for line in lines for f in fields(spark, [line])])
    for seed in range(3):
        random.Random(seed).shuffle(lines)
        parts = fields(spark, lines[:3]) + fields(spark, lines[3:])
        assert discovery.merge_types(parts) == whole


def fields(spark, lines):
    types = discovery.field_types(spark.createDataFrame([(line,) for line in lines], "value string"))
    return [(tuple(r["path"]), r["type"]) for r in types.collect()]


def test_records_are_read_with_the_schema_found(spark, tmp_path):
    spark.createDataFrame([(line,) for line in LINES], "value string").repartition(3).write.text(str(tmp_path / "in"))
    rows = discovery.read_json_lines(spark, str(tmp_path / "in"))
    assert rows.count() == 9
    settled = resolve_choice(rows.where("a IS NOT NULL"), choice="make_cols").where("a_long IS NOT NULL OR a_string IS NOT NULL")
    assert sorted((r["a_long"] or 0, r["a_string"] or "") for r in settled.select("a_long", "a_string").collect()) == [(0, "five"), (5, "")]
    with pytest.raises(ValueError):
        discovery.discovered_schema(discovery.field_types(spark.createDataFrame([("[1]",), ("3",)], "value string")))


def test_one_scan_and_counts_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame([(line,) for line in LINES], "value string").write.text(str(tmp_path / "in"))
    plan = discovery.field_types(spark.read.text(str(tmp_path / "in")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert "partial_count" in plan[plan.rindex("Exchange"):]


def grown(spark, path, rows, ddl="k int, j string, v int"):
    spark.createDataFrame(rows, ddl).write.mode("append").parquet(path)
    return spark.read.schema(ddl).parquet(path)


def collected(spark, out):
    return sorted((tuple(r) for r in spark.read.parquet(out).select("k", "j", "v").collect()),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


def test_each_row_is_handed_out_once(spark, tmp_path):
    """Growing rows, ties at the mark that come later, repeated rows, rows without a key, and a run that breaks."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    mark = bookmarks.Bookmark(spark, str(tmp_path / "marks"), "orders", ["k", "j"])
    sink = append_once(out)
    every = []

    def grow(rows):
        every.extend(rows)
        return grown(spark, source, rows)

    assert mark.run(grow([(1, "a", 1), (2, "b", 2), (2, "b", 2), (None, "x", 3)]), sink) == 1
    assert mark.mark() == ["2", "b"]
    # One more of an equal row, a tie with other values, a further row without a key, a greater second key.
    assert mark.run(grow([(2, "b", 2), (2, "b", 9), (None, "x", 3), (3, None, 4), (2, "c", 5), (10, "a", 6)]), sink) == 2
    assert mark.mark() == ["10", "a"]

    def breaks(rows, number):
        sink(rows, number)
        raise RuntimeError("between write and commit")

    table = grow([(10, "a", 7), (11, "", 8)])
    with pytest.raises(RuntimeError):
        mark.run(table, breaks)
    assert mark.committed() == 2 and mark.mark() == ["10", "a"]
    # The table grows before the run is repeated: the repeated run has the old rows, the next one the new.
    table = grow([(11, "", 8), (12, "z", 0)])
    assert mark.run(table, sink) == 3
    assert mark.run(table, sink) == 4
    assert mark.run(table, sink) == 4  # nothing new
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert collected(spark, out) == sorted(every, key=key)


def test_a_run_of_ties_only_keeps_the_mark(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    mark = bookmarks.Bookmark(spark, str(tmp_path / "marks"), "t", ["k"])
    sink = append_once(out)
    total = []
    for rows in ([(None, "a", 1)], [(5, "a", 1)], [(5, "b", 1)], [(5, "a", 1), (None, "a", 1)], [(6, "c", 1)]):
        total += rows
        mark.run(grown(spark, source, rows), sink)
    assert mark.mark() == ["6"] and len(collected(spark, out)) == len(total)


def test_sources_of_one_folder_have_marks_of_their_own(spark, tmp_path):
    table = grown(spark, str(tmp_path / "in"), [(1, "a", 1)])
    first, second = (bookmarks.Bookmark(spark, str(tmp_path / "marks"), n, ["k"]) for n in ("a", "b"))
    assert first.run(table, append_once(str(tmp_path / "a"))) == 1
    assert second.committed() == 0 and second.new_rows(table).count() == 1 and first.new_rows(table).count() == 0


def test_the_scan_is_filtered_by_the_mark(spark, tmp_path):
    source = str(tmp_path / "in")
    mark = bookmarks.Bookmark(spark, str(tmp_path / "marks"), "t", ["k"])
    mark.run(grown(spark, source, [(i, "a", 1) for i in range(10)]), append_once(str(tmp_path / "out")))
    plan = mark.new_rows(spark.read.parquet(source))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,9)" in plan and "EqualTo(k,9)" in plan


def test_times_survive_as_marks(spark, tmp_path):
    rows = spark.range(5).select(F.expr("timestamp'2024-01-01 00:00:00.123456' + make_dt_interval(0, 0, 0, id)").alias("ts"), "id")
    mark = bookmarks.Bookmark(spark, str(tmp_path / "marks"), "t", ["ts"])
    mark.run(rows, append_once(str(tmp_path / "out")))
    assert mark.new_rows(rows).count() == 0 and json.loads(json.dumps(mark.mark())) == ["2024-01-01 00:00:04.123456"]


def test_a_batch_is_added_once_and_in_the_layout_of_one_write(spark, tmp_path):
    out, plain = str(tmp_path / "out"), str(tmp_path / "plain")
    rows = spark.range(40).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("day"))
    rows.write.partitionBy("day").json(plain)
    assert append_batch(rows.where("id < 20"), out, 0, "w", "json", ["day"], compression="gzip")
    assert append_batch(rows.where("id >= 20"), out, 1, "w", "json", ["day"], compression="gzip")
    assert not append_batch(rows.where("id >= 20"), out, 1, "w", "json", ["day"], compression="gzip")
    assert append_batch(rows.limit(0), out, 2, "w", "json", ["day"])
    assert append_batch(rows.where("id < 0"), out, 0, "other", "json", ["day"])
    assert is_committed(spark, out, 2, "w") and not is_committed(spark, out, 3, "w")
    layout = lambda p: sorted(x.name for x in p.iterdir() if "=" in x.name)
    assert layout(tmp_path / "out") == layout(tmp_path / "plain") == ["day=d0", "day=d1", "day=d2"]
    assert sorted(spark.read.json(out).collect()) == sorted(rows.collect())
    with pytest.raises(ValueError):
        append_batch(rows, out, 3, "a/b")


def test_a_batch_whose_swap_was_decided_is_not_added_again(spark, tmp_path, monkeypatch):
    """The driver dies in the middle of the renames; the repeated batch ends them and adds nothing."""
    from millrace.sinks import swap as swaps

    out, rows = str(tmp_path / "out"), spark.range(30).repartition(3)
    whole = swaps._apply
    monkeypatch.setattr(swaps, "_apply", lambda s, f, put, drop: (whole(s, f, dict(list(put.items())[:1]), []), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        append_batch(rows, out, 5)
    monkeypatch.setattr(swaps, "_apply", whole)
    assert not append_batch(rows, out, 5)
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == list(range(30))
