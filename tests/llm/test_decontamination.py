import hashlib
import random

import pytest

from millrace.llm import decontamination

from .helpers import ALNUM, DOCUMENTS, documents, lower, prose, same

ITEMS = "item_id long, text string, n_words string"


def words(text):
    return ALNUM.findall(lower(text or ""))


def plain(docs, items):
    windows = {}
    for item, text, *_ in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for r in docs:
        w, found = words(r[1]), set()
        hit = [False] * len(w)
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i:i + n]))
                if ids:
                    found |= ids
                    hit[i:i + n] = [True] * n
        out.append((r[0], len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return out


def items(docs, seed=4):
    rng = random.Random(seed)
    out = [(1, None, "x"), (2, "", "x"), (3, "!!! ...", "x"), (None, "no id but words of some length here for a window", "x")]
    for i in range(40):
        source = words(rng.choice(docs)[1])
        at = rng.randrange(max(1, len(source)))
        part = source[at:at + rng.choice([1, 2, 5, 9, 10, 11, 25, 60])]
        out.append((10 + i, ", ".join(part).upper() if i % 2 else " ".join(prose(rng, 3) + part), "x"))
    return out + [out[-1], (99, "Ab ab AB ab ab ab ab ab ab ab ab ab", "x")]


@pytest.mark.parametrize("slice_bytes", [1 << 24, 300])
def test_agrees_with_plain_version(spark, slice_bytes):
    docs = documents() + [(1000, "ab " * 30, None, None, 0, 0, None, None)]
    tests = items(docs)
    out = decontamination.decontaminate(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(tests, ITEMS),
                                        slice_bytes=slice_bytes)
    same(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect(), plain(docs, tests))
    for r in out.collect():
        assert sum(b - a for a, b in zip(r.hit_starts, r.hit_stops)) == r.n_hit


def test_matches_are_extended_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MATCHES", 3)
    docs = documents(2)
    tests = items(docs)
    out = decontamination.decontaminate(spark.createDataFrame(docs, DOCUMENTS), spark.createDataFrame(tests, ITEMS))
    same(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect(), plain(docs, tests))


def test_clean_documents_stay_whole(spark):
    docs = documents()
    frame, tests = spark.createDataFrame(docs, DOCUMENTS), items(docs)[:12]
    kept = decontamination.drop_contaminated(frame, spark.createDataFrame(tests, ITEMS))
    assert kept.schema == frame.schema
    clean = [r for r, p in zip(docs, plain(docs, tests)) if not p[-1]]
    same(kept.collect(), clean)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(documents(), DOCUMENTS), spark.createDataFrame([], ITEMS)
    assert decontamination.decontaminate(docs, none).where("contaminated OR n_items > 0").count() == 0
    some = spark.createDataFrame([(1, "a b c", "x")], ITEMS)
    assert decontamination.decontaminate(docs.limit(0), some).count() == 0
