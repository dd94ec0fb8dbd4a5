import hashlib
import math

import pytest

from millrace.llm import mixing

from .helpers import DOCUMENTS, SPACE, documents, same


def plain_targets(sizes: dict, weights, share, epochs) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, rest = {}, share * sum(sizes.values()), set(names)
    while rest:
        total = sum(weight[s] for s in rest)
        full = [s for s in rest if left * weight[s] / total > epochs * sizes[s] + 1e-9]
        if not full:
            return target | {s: left * weight[s] / total for s in rest}
        for s in full:
            target[s] = float(epochs * sizes[s])
            rest.discard(s)
        left -= sum(target[s] for s in full)
    return target


@pytest.mark.parametrize("share,range_rows", [(1.5, 8), (0.4, 1000), (1.9, 8), (2.0, 3)])
def test_agrees_with_plain_version(spark, share, range_rows):
    rows = documents()
    got = mixing.mix(spark.createDataFrame(rows, DOCUMENTS), share=share, range_rows=range_rows).collect()
    docs = [(r[0], r[3], len(SPACE.findall(r[1] or ""))) for r in rows]
    sizes: dict = {}
    for _, source, n in docs:
        sizes[source] = sizes.get(source, 0) + n
    targets = plain_targets(sizes, mixing.WEIGHTS, share, 2)
    want, taken = [], {}
    for source, size in sizes.items():
        budget, at = math.floor(targets[source] + 1e-9), 0
        whole = budget // size if size else 0
        own = sorted((d for d in docs if d[1] == source),
                     key=lambda d: (hashlib.md5(str("" if d[0] is None else d[0]).encode()).hexdigest(), d[0] or 0, d[2]))
        for d in own:
            part = min(d[2], max(0, budget - whole * size - at))
            at += d[2]
            want.append((d[0], source, d[2], size, whole * d[2] + part))
    same([(r.doc_id, r.source, r.size, r.source_size, r.taken) for r in got], want)
    for r in got:
        assert r.target == pytest.approx(targets[r.source]) and r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, n in taken.items():
        assert n == math.floor(targets[source] + 1e-9)


def test_texts_of_the_mix(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    words: dict = {}
    for r in out.collect():
        words[r.source] = words.get(r.source, 0) + len(SPACE.findall(r.text))
    for r in mixing.mix(docs).select("source", "target").distinct().collect():
        assert words.get(r.source, 0) == math.floor(r.target)


def test_reruns_agree_and_empty_tables(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    again = docs.repartition(7)
    same(mixing.mix(docs).collect(), mixing.mix(again).collect())
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.apply_mix(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(nothing).collect()] == [0, 0]


def test_no_python_runs(spark):
    plan = mixing.mix(spark.createDataFrame(documents(), DOCUMENTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
