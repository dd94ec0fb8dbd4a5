import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import _repeats, suffix_dedup, substring_dedup

from .helpers import DOCUMENTS, SPACE, documents, same, unique


def plain_bytes(rows, length):
    seen, out = set(), []
    for doc_id, text in sorted((r[0], r[1]) for r in rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def plain_words(rows, n):
    texts = [(r[0], SPACE.findall(r[1] or "")) for r in rows]
    count = Counter(tuple(w[i:i + n]) for _, w in texts for i in range(len(w) - n + 1))
    out = []
    for doc_id, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def filled(rows):
    return [(r[0], r[1] or "", *r[2:]) for r in rows]


# Few bytes per bucket and a low limit for hot beginnings reach every path.
@pytest.mark.parametrize("bucket_bytes,hot", [(1 << 22, 1 << 17), (2000, 1 << 17), (3000, 3), (1 << 22, 0)])
def test_bytes_agree_with_plain_version(spark, bucket_bytes, hot):
    rows = unique(documents())
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCUMENTS), bucket_bytes=bucket_bytes, hot=hot)
    same(got.collect(), plain_bytes(filled(rows), 100))


@pytest.mark.parametrize("bucket_bytes,hot", [(1 << 22, 1 << 17), (2000, 1 << 17), (3000, 3), (1 << 22, 0)])
def test_words_agree_with_plain_version(spark, bucket_bytes, hot):
    rows = documents()
    got = substring_dedup.remove_passages(spark.createDataFrame(rows, DOCUMENTS), bucket_bytes=bucket_bytes, hot=hot)
    same(got.collect(), plain_words(filled(rows), 35))


def test_few_letters_and_short_windows(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab\x00é ") for _ in range(rng.randrange(0, 90)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(suffix_dedup.remove_repeats(df, length=12, gram=5).collect(), plain_bytes(rows, 12))
    same(substring_dedup.remove_passages(df, words=4, prefix=2).collect(), plain_words(rows, 4))


def test_repeated_rows_and_missing_ids(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij") for _ in range(150))
    rows = [(None, text), (1, text), (1, text), (1, text + "z"), (2, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # The row without an id comes first; the others repeat it, but for one byte.
    assert sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in got) == [
        (False, 0, 0), (False, 150, 150), (False, 150, 150), (False, 151, 150), (True, 150, 0)]


def test_texts_and_spans(spark):
    text = " ".join(str(i * 7919 % 1000) for i in range(80))
    df = spark.createDataFrame([(1, text), (2, "head " + text + " tail")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substring_dedup.remove_passages(df, texts=True).collect()}
    assert rows[1].kept == "" and rows[2].kept == "head tail"
    assert (rows[2].starts, rows[2].stops) == ([1], [81])
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, texts=True).collect()}
    assert bytes(rows[1].kept).decode() == text and bytes(rows[2].kept) == b"head  tail"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert substring_dedup.remove_passages(empty).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    group = rng.integers(0, 4, 500)
    order = _repeats.multikey_order(group, words)
    rows = [(int(group[i]), *map(int, words[i])) for i in order]
    assert rows == sorted(rows)
