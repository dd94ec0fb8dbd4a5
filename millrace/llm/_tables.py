"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of undirected ``links`` (u, v): label is the least node that links reach.

    Large-star and small-star in turn: each pulls neighbours to the least node in sight, so long chains halve and
    stars stay. Minima are taken before the shuffle, and a node with very many links only ever has them joined.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select("v", "m").where("v <> m")
                 .union(down).toDF("u", "v").distinct())
        edges = stored(small, "links")
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
