import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality

from .helpers import DOCUMENTS, documents

FOLDER = "/root/testdata/sf0.01"


def test_label_model_finds_accuracies_and_beats_the_balance_of_votes():
    rng = np.random.default_rng(3)
    kind = rng.choice(3, 4000, p=[0.7, 0.2, 0.1])
    accuracy = [0.95, 0.9, 0.6, 0.55, 0.55]
    votes = np.stack([np.where(rng.random(4000) < a, kind, rng.integers(0, 3, 4000)) for a in accuracy], axis=1)
    votes[rng.random(votes.shape) < 0.2] = quality.NOTHING
    chance, rates, shares = quality.fit_labellers(votes.astype(np.int8))
    assert (chance.argmax(axis=1) == kind).mean() > 0.93
    own = [np.mean([rates[j, k, k] for k in range(3)]) for j in range(5)]
    assert own[0] > own[1] > max(own[2:]) + 0.1
    assert shares == pytest.approx([0.7, 0.2, 0.1], abs=0.04)


def test_linear_scorer_leaves_out_what_adds_nothing():
    rng = np.random.default_rng(4)
    matrix = rng.random((2000, 12)) < 0.3
    chance = np.where(matrix[:, 0] | matrix[:, 1], 0.97, 0.03)
    rows, columns = np.nonzero(matrix)
    weights, offset = quality.fit_linear(rows, columns, 2000, 12, chance)
    assert weights[:2].min() > 2 and np.abs(weights[2:]).max() < 0.3 and offset < -1


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    scorer = quality.fit(docs, labels.where(half))
    held = quality.score_documents(docs, scorer).join(labels.where(~half), "doc_id").toPandas()
    bad = (held.quality == 0) | (held.toxic == 1)
    assert (held.reject_chance[bad] >= 0.5).mean() > 0.6
    assert (held.reject_chance[~bad] >= 0.5).mean() < 0.02


def test_no_labels_no_documents_and_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), DOCUMENTS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = quality.drop_rejects(docs, none)
    assert kept.schema == docs.schema
    texts = [r.text for r in kept.collect()]
    assert None in texts and "" in texts and len(texts) > 40
    empty = docs.limit(0)
    assert quality.drop_rejects(empty, none).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 0, None), (4, 1, 0)], none.schema)
    assert quality.drop_rejects(docs, odd).count() > 40


def test_equal_texts_fare_alike(spark):
    rows = [(1, "scum idiot loser", 0), (2, "scum idiot loser", 0), (3, "a plain line of words", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    scorer = quality.Scorer(np.array([int(quality._feature(quality._insults()[:1], 0)[0])]), np.array([9.0]), -3.0)
    scores = {r.doc_id: r.reject_chance for r in quality.score_documents(docs, scorer).collect()}
    assert scores[1] == scores[2] and scores[3] < 0.5


def short_texts():
    """Distinct texts of three words, every third toxic by a word of its own."""
    rows = [(i, f"line{i} {'grubnik' if i % 3 == 0 else 'meadow'} {'abcdefgh'[i % 8]}x") for i in range(240)]
    return rows, [(i, 1, int(i % 3 == 0)) for i, _ in rows]


def test_short_texts_count_wherever_they_lie(spark):
    rows, marks = short_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    one, many = (quality.fit(d, labels) for d in (docs.coalesce(1), docs.repartition(60)))
    assert len(one.features) and np.array_equal(one.features, many.features)
    assert np.allclose(one.weights, many.weights) and np.isclose(one.offset, many.offset)
    chance = {r.doc_id: r.reject_chance for r in quality.score_documents(docs, many).collect()}
    assert min(chance[i] for i in range(0, 240, 3)) > 0.5 > max(chance[i] for i in range(240) if i % 3)


def test_the_labelled_one_of_equal_texts_counts(spark):
    rows, marks = short_texts()
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    copies = spark.createDataFrame([(1000 + i, t) for i, t in rows], docs.schema)
    alone, beside = quality.fit(docs, labels), quality.fit(copies.union(docs).coalesce(1), labels)
    assert np.array_equal(alone.features, beside.features) and np.allclose(alone.weights, beside.weights)
