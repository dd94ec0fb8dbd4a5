"""Sharding by a weighted hash tree: regions hold racks, racks hold shards.

A row descends the tree. At each node every child draws ``-ln(u) / weight`` with ``u`` a uniform hash of the row's key
and the child's name, and the smallest draw wins, so a child gets rows in proportion to its weight and changes of one
child's weight move rows only into or out of that child. All of it is column expressions: no row is shuffled to be
assigned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .registry import query, table

# region -> rack -> shard -> weight
Topology = dict[str, dict[str, dict[int, float]]]

# Rows of one shard that are numbered together.
BLOCK_ROWS = 16384


def even_topology(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> Topology:
    """Shards 0, 1, 2, ... of weight 1, filled rack by rack."""
    tree: Topology = {}
    for shard in range(shards):
        rack = shard // shards_per_rack
        tree.setdefault(f"region{rack // racks_per_region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def with_region(tree: Topology, name: str, shards: dict[int, float]) -> Topology:
    """The tree with one more region. Only rows that the new region draws move, and all of them move into it."""
    if name in tree:
        raise ValueError(f"region {name} exists")
    return {**tree, name: {f"{name}-rack": dict(shards)}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: list[Column], name: str, weight: float) -> Column:
    # 53 hash bits in (0, 1]: the logarithm is finite.
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), *key), 11)
    return -F.log((bits + 1).cast("double") / F.lit(float(1 << 53))) / F.lit(weight)


def _descend(node: dict, key: list[Column], path: str) -> Column:
    children = {name: child for name, child in node.items() if _weight(child) > 0}
    if not children:
        raise ValueError(f"nothing under {path or 'the tree'} has a weight")

    def below(name) -> Column:
        child = children[name]
        return _descend(child, key, f"{path}/{name}") if isinstance(child, dict) else F.lit(int(name))

    names = list(children)
    if len(names) == 1:
        return below(names[0])
    draws = [F.struct(_draw(key, f"{path}/{n}", _weight(children[n])).alias("d"), F.lit(i).alias("i"))
             for i, n in enumerate(names)]
    winner = F.least(*draws)["i"]
    out = F
    for i, name in enumerate(names):
        out = out.when(winner == i, below(name))
    return out


def shard_of(tree: Topology, *key: Column) -> Column:
    """The shard (int) of a key. A null key is a key like any other."""
    return _descend(tree, list(key), "").cast("int")


def with_slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot",
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the rows of every shard from 0 without gaps, without gathering a shard in one task.

    Hash blocks of a shard are numbered on their own; the rows of the blocks before are added. Rows that agree in all
    ``order`` columns are interchangeable.
    """
    rows = df.count()
    blocks = max(1, math.ceil(rows / block_rows))
    cut = df.withColumn("__block", F.pmod(F.xxhash64(F.lit("block"), *order), F.lit(blocks)).cast("int"))
    before = W.Window.partitionBy(shard).orderBy("__block").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = (cut.groupBy(shard, "__block").count()
              .select(shard, "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before")))
    within = W.Window.partitionBy(shard, "__block").orderBy(*order)
    return (cut.withColumn("__row", F.row_number().over(within)).join(starts, [shard, "__block"])
            .withColumn(slot, F.col("__row") - 1 + F.col("__before")).drop("__row", "__block", "__before"))


def shard_documents(docs: DataFrame, tree: Topology, grown: Topology) -> DataFrame:
    """Shard of each document in ``tree`` and in ``grown``, under the law ``key``: doc_id and tree alone decide.

    Null and empty texts have one byte of size and checksum 0. A null doc_id is one key. Repeated rows each get a slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(tree, F.col("doc_id")).alias("shard"), shard_of(grown, F.col("doc_id")).alias("grown_shard"))
    return with_slots(sized, "shard", ["doc_id", "text_crc32", "size"])


@query()
def op2_hash_tree_sharding(spark: SparkSession, folder: str) -> DataFrame:
    tree = even_topology(16)
    out = shard_documents(table(spark, folder, "documents"), tree, with_region(tree, "grown", {16: 1.0}))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
