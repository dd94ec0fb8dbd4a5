import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import _stretches as S
from millrace.llm import _text as T
from millrace.llm import quality_rules as R

from .helpers import DOCUMENTS, SPACE, documents, prose, same

FOLDER = "/root/testdata/sf0.01"


def plain_counts(text, flagged=()) -> tuple:
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if SPACE.search(line)]
    alnum = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                                                       "abcdefghijklmnopqrstuvwxyz")))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(repeated), len(set(words)), sum("A" <= c <= "Z" for c in text), sum("0" <= c <= "9" for c in text),
            sum(c in "!?.,;:" for c in text), sum(w in flagged for w in alnum))


def awkward() -> list[tuple]:
    more = ["a\na\n\na \n a", "x y z x y z", "x y z x y", "\n\n\n", "ü Ü ü", "# * | <b>", "same line\r\nsame line\r\n",
            "idiot! IDIOT idiots", "a b a b a b a"]
    rows = documents(n=25)
    return rows + [(1000 + i, t, "en", "s", len(t), 0, None, None) for i, t in enumerate(more)]


def test_counts_agree_with_plain_version(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = awkward()
    got = R.counted(spark.createDataFrame(rows, DOCUMENTS), ["idiot", "x"]).select("doc_id", *R.COUNTS)
    same(got.collect(), [(r[0], *plain_counts(r[1], {"idiot", "x"})) for r in rows])
    assert R.counted(spark.createDataFrame([], DOCUMENTS)).collect() == []


@pytest.mark.parametrize("step", [1, 2, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("lower", [False, True])
def test_runs_in_stretches_of_any_length(step, lower):
    texts = ["", "one two", " ", "Ab", "", "three\nfour  fi", "ve", "x" * 200, "é ü", " y"]
    piece = next(T.pieces(pa.array(texts)))
    for table in (T.word_bytes("space"), S.line_bytes()):
        starts, hashes, ends = S.runs(piece, table, lower, step)
        pattern = SPACE if not table[32] else re.compile(r"[^\n]+")
        want = [(i, m) for i, t in enumerate(texts) for m in pattern.findall(t)]
        assert list(np.repeat(np.arange(len(texts)), np.diff(ends))) == [i for i, _ in want]
        for (_, text), start, value in zip(want, starts, hashes):
            raw = np.frombuffer(text.encode(), np.uint8)
            assert T.segment_hashes(raw, np.array([0]), np.array([len(raw)]), lower)[0] == value
            assert bytes(piece.bytes[start:start + len(raw)]) == text.encode()
    assert S.count_bytes(piece, S.line_bytes(), step).tolist() == [len(t.encode()) - t.count("\n") for t in texts]


def test_a_text_of_many_stretches(spark):
    words = prose(random.Random(3), 400)
    text = "\n".join(" ".join(words[i % 400:i % 400 + 7]) for i in range(12000)) + "\n" + "w" * 3_000_000
    assert len(text) > 3_400_000
    got = R.counted(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    want_words = text.split()
    assert got["n_words"] == len(want_words) and got["word_chars"] == sum(map(len, want_words))
    lines = text.split("\n")
    assert got["n_dup_lines"] == len(lines) - len(set(lines)) and got["n_distinct"] == len(set(want_words))


def toy(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rejected rows: many symbols, or repeated and short-worded."""
    rng = np.random.default_rng(seed)
    values = rng.random((n, len(R.FEATURES)))
    names = list(R.FEATURES)
    bad = (values[:, names.index("symbol_share")] > 0.8) | (
        (values[:, names.index("repeat_share")] > 0.6) & (values[:, names.index("chars_per_word")] < 0.3))
    return values, bad


def test_rules_that_generated_the_labels_are_found():
    values, bad = toy(3000, 1)
    rules = R.learn(values, bad, np.arange(3000) % 3 == 0)
    fresh, truth = toy(2000, 2)
    told = np.zeros(2000, bool)
    for rule in rules:
        told |= rule.holds(fresh)
    assert (told == truth).mean() > 0.98
    assert {c.feature for r in rules for c in r.conditions} <= {"symbol_share", "repeat_share", "chars_per_word"}


def test_labels_without_a_pattern_give_no_rule():
    values, _ = toy(2000, 3)
    bad = np.random.default_rng(9).random(2000) < 0.2
    assert R.learn(values, bad, np.arange(2000) % 3 == 0) == []
    assert R.learn(values, np.zeros(2000, bool), np.arange(2000) % 3 == 0) == []


def test_pruning_drops_a_condition_that_does_not_hold_up():
    values, bad = toy(1500, 4)
    right = R.Condition("symbol_share", True, 0.8)
    rule = R.Rule((right, R.Condition("digit_share", True, 0.9)))
    assert R.prune(rule, values, bad & (values[:, 0] > 0.8)) == R.Rule((right,))


def test_expression_agrees_with_the_rules_in_numpy(spark):
    rows = awkward()
    rules = R.DecisionList([R.Rule((R.Condition("symbol_share", True, 0.1),)),
                            R.Rule((R.Condition("distinct_share", False, 0.4), R.Condition("dup_lines", True, 1.0))),
                            R.Rule((R.Condition("flagged", True, 1.0),))], ["idiot"])
    got = R.judge(spark.createDataFrame(rows, DOCUMENTS), rules)
    assert str(rules).startswith("1. reject if symbol_share >= 0.1\n2. reject if distinct_share < 0.4 and dup_lines >= 1")
    for row in got.select(*R.COUNTS, "base_failed", "rule", "kept", *[R.feature(f).alias("f_" + f) for f in R.FEATURES]).collect():
        values = np.array([[row["f_" + f] for f in R.FEATURES]])
        held = [i for i, rule in enumerate(rules.rules, 1) if rule.holds(values)[0]]
        assert row["rule"] == (held[0] if held else None)
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert row["kept"] == (not row["base_failed"] and not held)


def test_without_labels_or_documents_the_list_is_empty(spark):
    docs = spark.createDataFrame(awkward(), DOCUMENTS)
    none = spark.createDataFrame([(None, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    rules = R.fit(docs, none)
    assert rules.rules == [] and str(rules) == "else keep"
    got = R.judge(docs, rules)
    assert got.where("kept = base_failed").count() == 0
    assert R.fit(docs.limit(0), none).rules == []


def test_accuracy_on_documents_without_part_in_the_fit(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.01', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER.replace('0.01', '0.1')}/labels.parquet")
    fitted = labels.where("doc_id % 2 = 0")
    rules = R.fit(docs.join(fitted, "doc_id", "left_semi"), fitted)
    told = R.judge(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), rules, ("doc_id", "quality", "toxic"))
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    n = told.agg(F.count_if(bad).alias("bad"), F.count_if(bad & ~F.col("kept")).alias("caught"),
                 F.count_if(~bad & (F.col("n_words") >= 50)).alias("fine"),
                 F.count_if(~bad & (F.col("n_words") >= 50) & ~F.col("kept")).alias("lost")).first()
    assert n["caught"] >= 0.85 * n["bad"] and n["lost"] <= 0.02 * n["fine"], (n, str(rules))
