import math
import struct
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from millrace.llm import sharding

from .helpers import DOCUMENTS, documents, same


def spark_hash(*values) -> int:
    """Spark's xxhash64 over strings and longs."""
    seed = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def plain_shard(tree, key, path="") -> int:
    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node

    draws = [(-math.log(((spark_hash(f"{path}/{n}", key) >> 11) + 1) / 2**53) / weight(c), i, n, c)
             for i, (n, c) in enumerate(tree.items())]
    _, _, name, child = min(draws)
    return plain_shard(child, key, f"{path}/{name}") if isinstance(child, dict) else name


def test_agrees_with_plain_version(spark):
    rows = documents()
    tree = sharding.even_topology(16)
    grown = sharding.with_region(tree, "grown", {16: 1.0})
    got = sharding.shard_documents(spark.createDataFrame(rows, DOCUMENTS), tree, grown)
    want = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), "key", plain_shard(tree, r[0]),
             plain_shard(grown, r[0])) for r in rows]
    same(got.drop("slot").select("doc_id", "size", "text_crc32", "law", "shard", "grown_shard").collect(), want)
    for shard, slots in got.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots))), shard


def test_movement_stays_in_the_changed_subtree(spark):
    tree = {"a": {"r1": {0: 1.0, 1: 1.0}, "r2": {2: 2.0}}, "b": {"r3": {3: 1.0}, "r4": {4: 1.0, 5: 2.0}}}
    heavier = {"a": {"r1": {0: 1.0, 1: 3.0}, "r2": {2: 2.0}}, "b": tree["b"]}
    key = F.col("id")
    moved = (spark.range(20000).select(sharding.shard_of(tree, key).alias("old"), sharding.shard_of(heavier, key).alias("new"))
             .groupBy("old", "new").count().collect())
    counts = Counter()
    for old, new, n in moved:
        counts[old] += n
        if old != new:
            assert new in (0, 1, 2)  # only into region a, whose weight grew
            if old in (0, 2):
                assert new == 1 or old == 2 and new in (0, 1)
    total = 8.0
    for shard, weight in ((0, 1), (1, 1), (2, 2), (3, 1), (4, 1), (5, 2)):
        assert abs(counts[shard] / 20000 - weight / total) < 0.02


def test_one_more_shard_takes_rows_only_into_itself(spark):
    tree = sharding.even_topology(16)
    grown = sharding.with_region(tree, "grown", {16: 1.0})
    rows = spark.range(30000).select(sharding.shard_of(tree, F.col("id")).alias("a"), sharding.shard_of(grown, F.col("id")).alias("b"))
    moved = rows.where("a <> b")
    assert moved.where("b <> 16").count() == 0
    assert abs(moved.count() / 30000 - 1 / 17) < 0.01


def test_slots_over_many_blocks_and_empty_tables(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("int").alias("shard"), F.col("id"))
    for shard, slots in sharding.with_slots(df, "shard", ["id"], block_rows=100).groupBy("shard").agg(
            F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots)))
    empty = spark.createDataFrame([], DOCUMENTS)
    tree = sharding.even_topology(2)
    assert sharding.shard_documents(empty, tree, tree).count() == 0
