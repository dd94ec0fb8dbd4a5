"""Nearest neighbours by collision counting.

Every vector is projected onto a few dozen random lines; the projections of a block of vectors are kept as one sorted
array per line. A query opens a window around its own projection on every line and counts in how many windows a vector
lies. Windows grow in steps (virtual rehashing: only entries that a step adds are read), and vectors that reach the
threshold of collisions are verified by their exact distance. The search ends when ``k`` verified vectors are closer
than the radius that the windows stand for: any other vector as close would have passed the threshold.

Blocks of vectors meet blocks of queries; each pair is one task's work, and the blocks' best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import _text as T
from .registry import query, table

LINES = 64
# A window's width in units of the radius, and the share of windows a candidate lies in. A vector at the radius lies in
# 82 % of them, one at twice the radius in half.
WIDTH = 2.72
SHARE = 0.68
GROWTH = 1.3
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024
# Queries counted at a time.
AT_ONCE = 32
SEED = 20240611
FOUND = "query_id long, vec_id long, score double"


def usable(vector: str = "embedding") -> Column:
    """Vectors with components that are all finite and not all zero."""
    x = F.col(vector)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & sound & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Lines:
    """Sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, lines: int = LINES):
        self.vectors = vectors
        directions = np.random.Generator(np.random.PCG64(SEED)).standard_normal((vectors.shape[1], lines))
        self.directions = directions
        projected = vectors.astype(np.float64) @ directions
        self.rows = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, self.rows, axis=0).T.copy()
        self.rows = self.rows.T.copy()

    def distances(self, query_: np.ndarray, rows: np.ndarray) -> np.ndarray:
        gap = self.vectors[rows].astype(np.float64) - query_.astype(np.float64)
        return np.sqrt((gap * gap).sum(axis=1))

    def search(self, queries: np.ndarray, k: int, skip: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, distances) of verified vectors per query, all that may be among its ``k`` nearest. ``skip`` is, per
        query and vector, whether the vector takes no part."""
        n, lines = len(self.vectors), len(self.sorted)
        centre = (queries.astype(np.float64) @ self.directions).T
        some = np.linspace(0, n - 1, min(n, 128)).astype(np.int64)
        radius = np.array([max(1e-9, 0.3 * np.min(d[d > 0], initial=np.inf)) for d in
                           (self.distances(q, some) for q in queries)])
        radius[~np.isfinite(radius)] = 1e-9
        counts = np.zeros((len(queries), n), np.uint8)
        lo = np.stack([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)])
        hi = lo.copy()
        rows = [np.zeros(0, np.int64)] * len(queries)
        dist = [np.zeros(0)] * len(queries)
        want = np.minimum(k, (~skip).sum(axis=1))
        verified = skip.copy()
        open_ = np.flatnonzero(want > 0)
        need = max(1, int(np.ceil(SHARE * lines)))
        while len(open_):
            half = radius[open_] * (WIDTH / 2)
            for j in range(lines):
                new_lo = np.searchsorted(self.sorted[j], centre[j, open_] - half, "left")
                new_hi = np.searchsorted(self.sorted[j], centre[j, open_] + half, "right")
                for a, b in ((new_lo, lo[j, open_]), (hi[j, open_], new_hi)):
                    size = np.maximum(b - a, 0)
                    counts[np.repeat(open_, size), self.rows[j][T.ranges(a, size)]] += 1
                lo[j, open_], hi[j, open_] = np.minimum(new_lo, lo[j, open_]), np.maximum(new_hi, hi[j, open_])
            still = []
            for q in open_.tolist():
                new = np.flatnonzero((counts[q] >= need) & ~verified[q])
                verified[q, new] = True
                rows[q] = np.concatenate([rows[q], new])
                dist[q] = np.concatenate([dist[q], self.distances(queries[q], new)])
                enough = (dist[q] <= radius[q]).sum() >= want[q]
                if not enough and not verified[q].all():
                    still.append(q)
            radius *= GROWTH
            open_ = np.array(still, np.int64)
        return list(zip(rows, dist))


def _block(k: int):
    def run(left, right):
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            ids, names = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            lines, queries = Lines(_matrix(left["embedding"])), _matrix(right["embedding"])
            for at in range(0, len(names), AT_ONCE):
                part = names[at:at + AT_ONCE]
                found = lines.search(queries[at:at + AT_ONCE], k, part[:, None] == ids[None, :])
                for name, (rows, dist) in zip(part.tolist(), found):
                    best = np.lexsort((ids[rows], dist))[:k]
                    out["query_id"].append(np.full(len(best), name))
                    out["vec_id"].append(ids[rows[best]])
                    out["score"].append(dist[best])
        return pa.table({name: pa.array(np.concatenate([np.zeros(0, kind), *out[name]]), type_) for name, kind, type_ in
                         (("query_id", np.int64, pa.int64()), ("vec_id", np.int64, pa.int64()),
                          ("score", np.float64, pa.float64()))})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block_vectors: int = BLOCK_VECTORS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query by Euclidean distance, in
    double precision on the given vectors; ties go to the smaller vec_id.

    Both sides are (vec_id, embedding). Vectors that are null, zero, or hold a null or non-finite component, and rows
    without vec_id, take no part. A query is compared with vectors of its own length, and with none of its own vec_id;
    rows of one vec_id are one query (the least vector). Repeated vectors are found one by one.
    """
    sound = [df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
             .where(usable() & F.col("vec_id").isNotNull()).withColumn("dim", F.size("embedding"))
             for df in (vectors, queries)]
    asked = sound[1].groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select(
        F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("dim"))
    n_blocks = max(1, -(-sound[0].count() // block_vectors))
    n_parts = max(1, -(-asked.count() // block_queries))

    def block(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = sound[0].withColumn("block", block("vec_id", n_blocks)).withColumn("part", every(n_parts))
    right = asked.withColumn("part", block("query_id", n_parts)).withColumn("block", every(n_blocks))
    keys = ["block", "part", "dim"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block(k), FOUND)
    rank = F.row_number().over(W.Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query()
def op7_collision_counting_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
