"""Tables that are changed in part: compaction, merges, puts with commits, and the swap below them."""

import json
import os
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.sinks import items, rewrites
from millrace.sinks import swap as swaps


def files(folder) -> dict[str, tuple[int, float]]:
    return {str(p.relative_to(folder)): (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(folder).rglob("*.parquet")
            if not any(x.startswith((".", "_")) for x in p.relative_to(folder).parts)}


def test_compaction_leaves_large_files_alone(spark, tmp_path):
    folder = str(tmp_path / "t")
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    big.coalesce(2).write.parquet(folder)
    small = spark.range(200_000, 200_100).select("id", F.lit("x").alias("h"), F.lit(1.5).alias("more"))
    small.repartition(12).write.mode("append").parquet(folder)
    before = files(folder)
    large = {n: v for n, v in before.items() if v[0] > 100_000}
    assert len(large) == 2
    out = rewrites.compact_small(spark, folder, small_bytes=100_000)
    after = files(folder)
    assert out == {"kept": 2, "merged": len(before) - 2, "written": 1} and len(after) == 3
    assert all(after[n] == v for n, v in large.items())
    back = spark.read.option("mergeSchema", True).parquet(folder)
    assert back.count() == 200_100 and back.where("more = 1.5").count() == 100
    # Nothing is left to do, and nothing hidden is left over.
    assert rewrites.compact_small(spark, folder, small_bytes=100_000) == {"kept": 3, "merged": 0, "written": 0}
    assert not [p for p in os.listdir(folder) if p.startswith(".staging")] and files(folder) == after


def test_compaction_packs_each_partition_folder_by_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    rows.repartition(7).write.partitionBy("day").parquet(folder)
    sizes = [v[0] for v in files(folder).values()]
    assert len(sizes) == 21
    out = rewrites.compact_small(spark, folder, target_bytes=3 * max(sizes))
    assert out["kept"] + out["merged"] == 21 and 6 <= out["written"] + out["kept"] <= 9
    assert {n.split("/")[0] for n in files(folder)} == {"day=0", "day=1", "day=2"}
    back = spark.read.parquet(folder)
    assert back.count() == 3000 and back.where("id % 3 <> day").count() == 0


def test_compaction_of_csv_keeps_one_header_per_file(spark, tmp_path):
    folder = str(tmp_path / "c")
    spark.range(50).select("id", F.lit('a,"b"').alias("t")).repartition(6).write.option("header", True).csv(folder)
    with pytest.raises(ValueError):
        rewrites.compact_small(spark, folder, "csv", header=True)
    out = rewrites.compact_small(spark, folder, "csv", schema="id BIGINT, t STRING", pattern="part-*", header=True)
    assert out["written"] == 1 and out["kept"] == 0
    back = spark.read.schema("id BIGINT, t STRING").option("header", True).csv(folder)
    assert back.count() == 50 and back.where("t = 'a,\"b\"'").count() == 50


def test_bins_are_full_but_not_over(spark):
    listing = spark.createDataFrame([(f"/t/{d}/f{i:03d}", 10) for d in "ab" for i in range(25)] + [("/t/c/one", 10)],
                                    "path string, bytes long")
    bins = {r["bin"]: r["n"] for r in rewrites.packed(listing, 100).groupBy("bin").agg(F.count("*").alias("n")).collect()}
    assert sorted(bins.values()) == [5, 5, 10, 10, 10, 10] and not any("/c" in b for b in bins)


def merged(spark, folder, stage, keys, **more):
    want = stage.unionByName(spark.read.parquet(folder).join(stage, keys, "left_anti")).collect()
    out = rewrites.merge_into(spark, folder, stage, keys, **more)
    got = spark.read.parquet(folder).select(*stage.columns).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return out


def test_merge_rewrites_only_files_with_a_staged_key(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(8000).select("id", (F.col("id") % 5).alias("k"), F.lit("old").alias("v"))
    rows.repartitionByRange(8, "id").write.parquet(folder)
    before = files(folder)
    stage = spark.range(1000).select((F.col("id") + 2500).alias("id"), ((F.col("id") + 2500) % 5).alias("k"), F.lit("new").alias("v"))
    out = merged(spark, folder, stage, ["id", "k"])
    same = {n for n, v in files(folder).items() if before.get(n) == v}
    assert out["rewritten"] == 2 and out["kept"] == 6 and len(same) == 6
    # New keys alone rewrite nothing; a stage without rows changes nothing.
    fresh = spark.range(9000, 9100).select("id", F.lit(1).cast("long").alias("k"), F.lit("n").alias("v"))
    assert merged(spark, folder, fresh, ["id", "k"])["rewritten"] == 0
    now = files(folder)
    rewrites.merge_into(spark, folder, fresh.limit(0), ["id", "k"])
    assert all(files(folder)[n] == v for n, v in now.items())


def test_merge_with_null_and_repeated_keys(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id int, v string").repartition(3).write.parquet(folder)
    stage = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (5, "w")], "id int, v string")
    merged(spark, folder, stage, ["id"])
    merged(spark, folder, spark.createDataFrame([(None, "q")], "id int, v string"), ["id"])


def test_merge_into_partitions_moves_a_row_to_its_new_one(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(90).select("id", F.lit("old").alias("v"), (F.col("id") % 3).cast("int").alias("day")).write.partitionBy("day").parquet(folder)
    before = files(folder)
    stage = spark.createDataFrame([(3, "new", 1), (6, "new", 7)], "id long, v string, day int")  # both were of day 0
    merged(spark, folder, stage, ["id"], partition_by=["day"])
    after = files(folder)
    assert all(after[n] == v for n, v in before.items() if "day=1" in n or "day=2" in n)
    assert spark.read.parquet(folder).where("day = 7").count() == 1


def test_merge_into_a_folder_without_files(spark, tmp_path):
    folder = str(tmp_path / "new")
    assert rewrites.merge_into(spark, folder, spark.range(5).toDF("id"), ["id"])["rewritten"] == 0
    assert spark.read.parquet(folder).count() == 5


def test_a_swap_that_was_decided_is_ended_later(spark, tmp_path, monkeypatch):
    """The driver dies after the first move: the journal is there, the rest is done by the next one."""
    folder = tmp_path / "t"
    folder.mkdir()
    for name in ("old1", "old2"):
        (folder / name).write_text(name)
    whole = swaps._apply

    def half(spark, folder, put, drop):
        whole(spark, folder, dict(list(put.items())[:1]), [])
        raise RuntimeError("driver died")

    monkeypatch.setattr(swaps, "_apply", half)
    with pytest.raises(RuntimeError), swaps.staging(spark, str(folder)) as staged:
        Path(staged).mkdir()
        for name in ("new1", "new2"):
            (Path(staged) / name).write_text(name)
        swaps.swap(spark, str(folder), staged, {f"{staged}/new1": f"{folder}/a", f"{staged}/new2": f"{folder}/b"},
                   [f"{folder}/old1", f"{folder}/old2"])
    monkeypatch.setattr(swaps, "_apply", whole)
    assert swaps.finish_swaps(spark, str(folder)) == 1
    assert sorted(p.name for p in folder.iterdir() if p.is_file() and not p.name.startswith(".")) == ["a", "b"]
    assert (folder / "a").read_text() == "new1" and swaps.finish_swaps(spark, str(folder)) == 0
    assert not Path(staged).exists()


def test_staged_files_go_if_nothing_was_decided(spark, tmp_path):
    with pytest.raises(ValueError), swaps.staging(spark, str(tmp_path)) as staged:
        Path(staged).mkdir()
        raise ValueError
    assert not Path(staged).exists() and swaps.finish_swaps(spark, str(tmp_path)) == 0


def test_files_below_skips_what_spark_skips(spark, tmp_path):
    for name in ("a/x.parquet", "a/_x.parquet", "_b/y.parquet", ".c/z.parquet", "w.parquet"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1")
    assert [p.rsplit("/", 1)[1] for p in swaps.files_below(spark, str(tmp_path))] == ["x.parquet", "w.parquet"]


@pytest.fixture(name="table")
def item_table(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = spark.range(100).select((F.col("id") % 10).alias("pk"), F.floor(F.col("id") / 10).alias("sk"),
                                   F.lit("x" * 10).alias("filler"))
    items.create_items(path, rows.schema, ["pk", "sk"], buckets=4)
    items.put(rows, path)
    return path, rows


def test_puts_replace_the_items_of_their_keys(spark, table):
    path, rows = table
    items.put(rows.where("pk < 2").withColumn("filler", F.lit("new")), path)
    items.put(spark.createDataFrame([(None, 1, "n"), (77, 1, "m")], rows.schema), path)
    items.put(spark.createDataFrame([(None, 1, "again")], rows.schema), path)
    got = items.read_items(spark, path)
    assert got.count() == 102 and got.where("filler = 'new'").count() == 20
    assert [r["filler"] for r in got.where("pk IS NULL").collect()] == ["again"]
    wanted = spark.createDataFrame([(None, 1), (1, 3), (500, 0)], "pk long, sk long")
    assert sorted(r["filler"] for r in items.get_items(spark, path, wanted).collect()) == ["again", "new"]


def test_the_last_of_several_writes_counts(spark, table):
    path, rows = table
    twice = rows.withColumn("at", F.lit(1)).unionByName(rows.withColumn("filler", F.lit("late")).withColumn("at", F.lit(2)))
    items.put(twice, path, order=["at"])
    assert items.read_items(spark, path).where("filler = 'late'").count() == 100


def test_a_put_that_fails_leaves_the_items_and_no_files(spark, table):
    path, rows = table
    before = sorted(os.listdir(f"{path}/data"))
    broken = rows.withColumn("filler", F.when(F.col("pk") == 9, F.raise_error(F.lit("broken"))).otherwise("y"))
    with pytest.raises(Exception, match="broken"):
        items.put(broken, path)
    assert len(items.commits(path)) == 1 and sorted(os.listdir(f"{path}/data")) == before
    assert items.read_items(spark, path).where("filler <> 'xxxxxxxxxx'").count() == 0


def test_a_task_that_runs_twice_changes_nothing(spark, table):
    """Both attempts stage files; the message of one of them is committed."""
    path, rows = table
    writer = items.ItemWriter(path, [])
    batch = pa.record_batch({"pk": [1, 2], "sk": [0, 0], "filler": ["a", "b"], items.BUCKET: pa.array([0, 3], pa.int32())})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))
    assert len(lost.files) == len(kept.files) == 2 and lost.files != kept.files
    writer.commit([kept, None])
    got = items.read_items(spark, path)
    assert got.count() == 100 and got.where("filler IN ('a', 'b')").count() == 2


def test_look_ups_read_the_files_of_their_buckets(spark, table):
    path, _ = table
    wanted = spark.createDataFrame([(3, 3)], "pk long, sk long")
    assert len(items.get_items(spark, path, wanted).inputFiles()) < len(items.read_items(spark, path).inputFiles()) + 1
    bucket = wanted.select(items._bucket(["pk", "sk"], 4)).first()[0]
    read = [f.rsplit("/", 1)[1].split("-")[1] for f in items._read(spark, path, {bucket}).inputFiles()]
    assert set(read) == {f"{bucket:05d}"}


def test_compacted_items_are_the_same(spark, table):
    path, rows = table
    for i in range(3):
        items.put(rows.where(F.col("pk") == i).withColumn("filler", F.lit(f"v{i}")), path)
    before = sorted(items.read_items(spark, path).collect())
    items.compact_items(spark, path)
    assert len(items.commits(path)) == 1 and sorted(items.read_items(spark, path).collect()) == before
    assert len(os.listdir(f"{path}/commits")) == 1
    named = {f[0] for c in Path(f"{path}/commits").glob("*.json") for f in json.loads(c.read_text())["files"]}
    assert {n for n in os.listdir(f"{path}/data") if not n.startswith(".")} == named
    items.put(rows.limit(1), path)
    assert items.read_items(spark, path).count() == 100


def test_item_tables_are_made_once(spark, table):
    path, rows = table
    with pytest.raises(FileExistsError):
        items.create_items(path, rows.schema, ["pk"])
    with pytest.raises(FileNotFoundError):
        items.put(rows, path + "-other")
