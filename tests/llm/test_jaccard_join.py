import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import _tables, jaccard_join
from millrace.llm import _text as T

from .helpers import DOCUMENTS, SPACE, documents, lower, prose, same, unique


def plain_sets(rows):
    out = []
    for r in rows:
        w = SPACE.findall(lower(r[1] or ""))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def plain_components(rows, percent=75):
    sets = plain_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        if sets[i] and r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def near_copies(seed=3):
    """Chains and clusters around the threshold, on top of text that all share."""
    rng = random.Random(seed)
    common, rows = prose(rng, 40), []
    for c in range(6):
        base = prose(rng, rng.randrange(30, 160))
        for _ in range(rng.randrange(2, 14)):
            base = list(base)
            for _ in range(rng.randrange(0, 4)):
                base[rng.randrange(len(base))] = "w" + str(rng.randrange(10**6))
            rows.append((len(rows), " ".join(base + (common if c % 2 else []))))
    rows += [(len(rows) + i, " ".join(prose(rng, 8) + common)) for i in range(40)]
    return rows


@pytest.mark.parametrize("frequent", [0, 1 << 17])
def test_components_agree_with_plain_version(spark, monkeypatch, frequent):
    if not frequent:
        monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda docs: np.zeros(0, np.uint64))
    rows = near_copies()
    got = jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).drop("cls")
    same(got.collect(), plain_components(rows))


def test_awkward_rows(spark):
    rows = documents()
    got = jaccard_join.join_documents(spark.createDataFrame(rows, DOCUMENTS)).drop("cls")
    same(got.collect(), plain_components(rows))


def test_small_blocks_and_sets_by_join(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "NAMED_SETS", 0)
    monkeypatch.setattr(jaccard_join, "REMEMBERED", 8)
    rows = near_copies(8)
    got = jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).drop("cls")
    same(got.collect(), plain_components(rows))


def test_one_document_of_each_component_stays(spark):
    rows = unique(documents())
    docs = spark.createDataFrame(rows + [rows[-1]], DOCUMENTS)
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.schema == docs.schema
    want = plain_components(rows)
    assert {r.doc_id for r in kept.collect()} == {i for i, n, c in want if i == c}
    nonempty = [r for r in kept.collect() if SPACE.findall(r.text or "")]
    assert len(nonempty) == len({c for _, n, c in want if n})
    empty = [r for r in kept.collect() if not SPACE.findall(r.text or "")]
    assert len(empty) == sum(n == 0 for _, n, _ in want)
    assert len(nonempty) + len(empty) == kept.count()


def test_kept_rows_pass_no_python_worker(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc_id long, text string")
    kept = jaccard_join.drop_near_copies(docs)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()


def test_kept_rows_of_repeated_and_missing_ids(spark):
    rng = random.Random(11)
    a, b, c, d = (" ".join(prose(rng, 30)) for _ in range(4))
    rows = [(7, a, "x"), (7, a, "y"), (7, a.replace("o", "O").replace("n", "N"), "x"), (7, b, "x"), (8, a, "x"), (3, b + " more", "x"),
            (None, c, "x"), (None, c, "x"), (None, d, "x"), (9, d, "x"),
            (7, None, "x"), (7, " \t", "x"), (7, " \t", "x"), (None, "", "x"), (8, "\u00a0", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.schema == docs.schema
    got = sorted(((r[0], lower(r[1] or "")) for r in kept.collect()), key=str)
    assert got == sorted([(7, lower(a)), (3, lower(b + " more")), (None, c), (9, d), (7, ""), (7, " \t"), (7, " \t"),
                          (None, ""), (8, "\u00a0")], key=str)


def test_names_are_found_among_the_wanted():
    rng = np.random.default_rng(4)
    names = [rng.bytes(14) + end for end in (b"\0\0", b"\0a", b"a\0", b"aa") for _ in range(50)] + [bytes(16)]
    wanted = np.sort(jaccard_join._names(names[::3]))
    found = jaccard_join._among(jaccard_join._names(names), wanted)
    assert found.tolist() == [n in set(names[::3]) for n in names]
    assert not jaccard_join._among(jaccard_join._names(names), jaccard_join._names([])).any()


def test_frequent_shingles_are_counted_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COUNTED", 200)
    monkeypatch.setattr(jaccard_join, "PIECE_BYTES", 2000)
    rng = random.Random(6)
    often, more = " ".join(prose(rng, 5)), " ".join(prose(rng, 5))
    texts = [often] * 40 + [more] * 60 + [" ".join(prose(rng, 20)) for _ in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    want = [jaccard_join.shingles(next(T.pieces(pa.array([t]))))[1][0] for t in (often, more)]
    assert jaccard_join.frequent_shingles(docs).tolist() == want


def test_bound_never_rules_out_a_link():
    rng = np.random.default_rng(2)
    for n in (20, 900, 1100, 5000):
        tokens = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2))
        rng.shuffle(tokens)
        a, b = np.sort(tokens[:n]), np.sort(tokens[n // 8:n + n // 8])
        owner = np.repeat([0, 1], [len(a), len(b)])
        sizes = np.array([len(a), len(b)])
        raw = jaccard_join._counted_ranges(owner, np.concatenate([a, b]), sizes)
        level = jaccard_join.levels(sizes)
        to = int(level.min())
        x, y = (jaccard_join._matrix([r], int(k), to) for r, k in zip(raw, level))
        assert jaccard_join._may_link(x, y, sizes[:1], sizes[1:], 75)[0]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(70, 71), (71, 70), (5, 5)]
    got = dict(_tables.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(1, 50)) and got[71] == 70
    assert _tables.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    assert jaccard_join.join_documents(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_bound_rules_out_most_pairs_below_the_threshold():
    rng = np.random.default_rng(3)
    ruled_out = 0
    for n in (300, 700, 1500, 3000):
        for _ in range(20):
            tokens = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(tokens[:n]), np.sort(tokens[n // 4:n + n // 4])  # a Jaccard of 0.6
            sizes = np.array([n, n])
            raw = jaccard_join._counted_ranges(np.repeat([0, 1], n), np.concatenate([a, b]), sizes)
            level = int(jaccard_join.levels(sizes)[0])
            x, y = (jaccard_join._matrix([r], level, level) for r in raw)
            ruled_out += not jaccard_join._may_link(x, y, sizes[:1], sizes[1:], 75)[0]
    assert ruled_out >= 78


def test_large_sets_just_below_the_threshold_are_not_sure():
    hashes = np.unique(np.random.default_rng(7).integers(0, 1 << 64, 1_200_000, dtype=np.uint64))
    common, n = 857_142, 1_000_000
    a, b = hashes[:n], np.concatenate([hashes[:common], hashes[n:2 * n - common]])
    assert jaccard_join._spare(a, b, 75) == (-150, False)
    halves = [(x & np.uint64(0xFFFFFFFF)).astype(np.uint32) for x in (a, b)]
    spare, sure = jaccard_join._spare(*halves, 75)
    assert spare >= jaccard_join.MARGIN * 175 and not sure
    assert jaccard_join._spare(*[x[:1000] for x in halves], 75)[1]


def test_sorting_agrees_with_two_keys():
    rng = np.random.default_rng(11)
    for owners, low in ((1, 1 << 63), (7, 4), (300, 1 << 63), (300, 1 << 7)):
        owner = np.sort(rng.integers(0, owners, 4000))
        tokens = rng.integers(0, low, 4000, dtype=np.uint64)
        owner, tokens = np.concatenate([owner, owner[::3]]), np.concatenate([tokens, tokens[::3]])
        got, want = jaccard_join._sorting(owner, tokens), np.lexsort((tokens, owner))
        assert (owner[got] == owner[want]).all() and (tokens[got] == tokens[want]).all()
    assert not len(jaccard_join._sorting(np.zeros(0, np.int64), np.zeros(0, np.uint64)))


def test_marks_hold_every_key(spark):
    keys = np.random.default_rng(12).integers(-(1 << 63), 1 << 63, 3000)
    keys[:4] = [0, -1, (1 << 63) - 1, -(1 << 63)]
    marks = jaccard_join._marks(spark.createDataFrame([(int(k),) for k in keys[:1000]], "key long"))
    found = jaccard_join._marked(marks, keys)
    assert found[:1000].all() and found[1000:].sum() < 5
    assert not jaccard_join._marked(jaccard_join._marks(spark.createDataFrame([], "key long")), keys).any()


@pytest.mark.parametrize("named", [0, 1 << 18])
def test_sets_are_built_of_wanted_texts_alone(spark, monkeypatch, named):
    monkeypatch.setattr(jaccard_join, "NAMED_SETS", named)
    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, 30))) for i in range(40)] + [(40, None), (41, ""), (42, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketched = jaccard_join.sketches(docs, ["doc_id"])
    classes = sketched.where("n > 0").select("cls", "n", "ranges", "key")
    wanted = sketched.where("doc_id IN (3, 7, 42)").select("cls")
    got = {bytes(r.cls): r.tokens for r in jaccard_join._sets(docs, wanted, classes, np.uint64).collect()}
    assert {len(t) // 8 for t in got.values()} == {1, 26} and len(got) == 3
    # A text that has another key is not opened.
    other = classes.withColumn("key", F.when(F.col("n") == 1, F.col("key")).otherwise(F.lit(1)))
    assert len(jaccard_join._sets(docs, wanted, other, np.uint64).collect()) == 1
