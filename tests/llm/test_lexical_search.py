import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import lexical_search as L

from .helpers import ALNUM, DOCUMENTS, documents, lower, same

ITEMS = "item_id string, text string, doc_id long, score string"


def plain(docs: list[tuple], items: list[tuple], top: int = 20) -> list[tuple]:
    """(item_id, rank, score, doc_id) where documents with equal scores and ids are interchangeable."""
    counts = [(r[0], Counter(ALNUM.findall(lower(r[1] or "")))) for r in docs]
    sizes = [sum(c.values()) for _, c in counts]
    N, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item in items:
        scored = []
        for (doc_id, c), n in zip(counts, sizes):
            score = 0
            for term, k in Counter(ALNUM.findall(lower(item[1] or ""))).items():
                if c[term]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + 25 * n * N // total
                    score += k * w * (10**9 * c[term] // (1000 * c[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item[0], i, s[3], -s[0]) for i, s in enumerate(scored[:top], 1)]
    return out


def items(rows: list[tuple]) -> list[tuple]:
    texts = [r[1] for r in rows if r[1]]
    out = [(f"i{i}", " ".join(t.split()[3:30]) or t) for i, t in enumerate(texts[:25])]
    # Repeats, unknown words, no words, a null id, one id twice.
    out += [("rep", "edit1 edit1 edit1 one ONE"), ("none", "nosuchword"), ("empty", ""), ("null", None), ("punct", "!?"),
            (None, texts[4]), ("twice", texts[5]), ("twice", texts[6])]
    return [(*i, 7, "x") for i in out]


@pytest.mark.parametrize("top, cell, seeds, pairs", [(20, 16, 32, 1 << 18), (3, 2, 1, 1 << 18), (5, 4, 2, 150), (1, 1, 1, 1 << 18)])
def test_agrees_with_plain_version(spark, top, cell, seeds, pairs):
    """Nulls, ties, repeated rows, clashing columns; cells and batches much smaller than the table."""
    rows = documents(n=50)
    asked = items(rows)
    got = L.search(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(asked, ITEMS), top, cell, seeds, pairs)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    same(got.collect(), plain(rows, asked, top))


def test_empty_tables(spark):
    rows = documents(n=5)
    docs, asked = spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(items(rows), ITEMS)
    assert L.search(docs.limit(0), asked).collect() == []
    assert L.search(docs, asked.limit(0)).collect() == []
    assert L.search(docs, asked.where("text IS NULL")).collect() == []
    assert L.search(docs.where("text IS NULL"), asked).collect() == []


def test_many_copies_and_equal_scores(spark):
    """A group of copies is cut into cells like other documents; the smallest ids are named."""
    rows = [(i, "common words of a copy", "en", "s", 1, 0, None, None) for i in range(900)]
    rows += [(1000 + i, f"common rare{i} words", "en", "s", 1, 0, None, None) for i in range(60)]
    asked = [("a", "common copy", 0, ""), ("b", "rare7 words", 0, "")]
    got = L.search(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(asked, ITEMS))
    same(got.collect(), plain(rows, asked))


def test_a_very_long_document(spark):
    rows = documents(n=20) + [(5000, "alpha beta gamma " * 100_000 + "delta", "en", "s", 1, 0, None, None)]
    asked = [("a", "delta gamma", 0, ""), ("b", rows[0][1] or "one", 0, "")]
    got = L.search(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(asked, ITEMS))
    same(got.collect(), plain(rows, asked))


def test_cells_of_low_bounds_are_skipped(spark, monkeypatch):
    """The second pass looks at few pairs of query and cell, and their bounds hold for every document."""
    rows = [(i, f"w{i % 40} w{i % 41} w{i % 43} common", "en", "s", 1, 0, None, None) for i in range(3000)]
    asked = [(str(i), f"w{i} w{i} common", 0, "") for i in range(30)]
    seen, plain_score = [], L._score

    def counted(blocks, pairs, lookup, cell_rows):
        seen.append((pairs.count(), pairs.select("cell").distinct().count(), blocks.select("cell").distinct().count()))
        return plain_score(blocks, pairs, lookup, cell_rows)

    monkeypatch.setattr(L, "_score", counted)
    got = L.search(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(asked, ITEMS), 5)
    same(got.collect(), plain(rows, asked, 5))
    cells = seen[-1][2]
    assert cells >= 3000 / 16 and seen[-1][0] < 0.6 * 30 * cells


def test_blocks_hold_the_greatest_impact(spark):
    rows = documents(n=30)
    docs = spark.createDataFrame(rows, DOCUMENTS).select("doc_id", "text")
    import numpy as np
    terms = L.term_counts(docs, "doc_id").select(F.explode("terms").alias("t")).distinct().collect()
    vocabulary = np.unique(np.array([r["t"] for r in terms], np.int64).view(np.uint64))
    forward = L.term_counts(docs, "doc_id", vocabulary).withColumn("tie", F.monotonically_increasing_id()).where("n > 0")
    n, words = forward.agg(F.count("*"), F.sum("n")).first()
    blocks = L._blocks(L._similar(forward, vocabulary, np.ones(len(vocabulary), np.int64), n, words), len(vocabulary), 4)
    found = blocks.where("term >= 0").collect()
    assert all(r["top"] == max(r["bases"]) and len(r["slots"]) == len(set(r["slots"])) <= 4 for r in found)
    assert sum(len(r["slots"]) for r in found) == forward.select(F.explode("terms")).count()
    assert sum(len(r["docs"]) for r in blocks.where("term = -1").collect()) == n
