import numpy as np
import pytest

from millrace.llm import neighbours


def plain(ids, vectors, queries, k):
    out = {}
    for q in queries:
        own = vectors[ids == q][0].astype(np.float64)
        d = np.sqrt(((vectors.astype(np.float64) - own) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


@pytest.mark.parametrize("kind", ["normal", "clusters", "copies"])
def test_recall(spark, kind):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32)
    if kind == "clusters":
        vectors = vectors * 0.2 + np.repeat(rng.standard_normal((30, 24)), 50, axis=0).astype(np.float32)
    if kind == "copies":
        vectors[200:700] = vectors[0]
    ids = np.arange(1500)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>")
    rows = neighbours.nearest(df, df.where("vec_id % 50 = 0"), block_vectors=400, block_queries=16).collect()
    want = plain(ids, vectors, ids[::50], 10)
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want) and set(got) == set(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0])) and all(i != q for i, _ in found)
        exact = {int(i): s for i, s in zip(ids, np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(axis=1)))}
        assert all(s == pytest.approx(exact[i], rel=1e-12, abs=1e-12) for i, s in found)


def test_unusable_vectors_few_candidates_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0, 1.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, rank string, score int")
    got = neighbours.nearest(df, df.where("vec_id IN (0, 2, 3, 9)"))
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, 1.0), (0, 2, 8, 1.0)]
    assert neighbours.nearest(df.limit(0), df).count() == 0
