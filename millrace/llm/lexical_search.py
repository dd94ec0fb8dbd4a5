"""Ranked lexical search over posting lists cut into blocks of similar documents.

Documents are ordered by what they would score and by the signs of random projections of their term impacts, and this
order is cut into cells of a few similar documents. Each term's posting list is clustered by these cells: a block has
the list's documents of one cell and their impacts. The greatest impact of each term in a cell, one number per block,
is the coordinatewise maximum over the cell, and with the query's weights it bounds the score of every document there.

A query first scores the cells with the highest bounds; the lowest score on its list so far is a threshold, and the
blocks of a cell are skipped only if the cell's bound is below it. Bounds and scores are integers, so this is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..session import stored
from . import _stretches as S
from . import _text as T
from .registry import query, table

# Documents of a cell.
CELL = 16
# Cells that a query scores to find its threshold.
SEEDS = 32
# Pairs of a query and one of its terms that are searched for at a time. Each takes about 24 bytes in every task.
PAIRS = 1 << 18
PROJECTIONS = 16


def _term_counts(piece: T.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and per text and different word: the text's number, the word's hash and how often it occurs."""
    _, hashes, ends = S.runs(piece, T.word_bytes("alnum"), lower=True)
    owner = T.owners(ends)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return np.diff(ends), owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def _lists(owner: np.ndarray, n: int, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values, kind))


def term_counts(rows: DataFrame, key: str, vocabulary: np.ndarray | None = None) -> DataFrame:
    """(key, n, terms, tfs) of rows (key, text): the number of all words, and the different ones with their counts.

    A term is its 64-bit hash, or its place in ``vocabulary`` (sorted hashes); terms outside of that are left out.
    """
    kind = rows.schema[key].dataType.simpleString()
    inner = rows.select(F.col(key).alias("key"), F.col("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch.column(1)):
                n, owner, hashes, tfs = _term_counts(piece)
                if vocabulary is None:
                    terms = hashes.view(np.int64)
                else:
                    place = np.searchsorted(vocabulary, hashes)
                    hit = np.flatnonzero(vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes)
                    owner, terms, tfs = owner[hit], place[hit], tfs[hit]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(n, pa.int64()),
                     _lists(owner, len(piece), terms, pa.int64()), _lists(owner, len(piece), tfs, pa.int64())],
                    ["key", "n", "terms", "tfs"])

    return (inner.mapInArrow(run, f"key {kind}, n long, terms array<long>, tfs array<long>")
            .withColumnRenamed("key", key))


def _weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in df], np.int64)


def _values(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of an Arrow list column without nulls."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.to_numpy()[offsets[0]:offsets[-1]].astype(kind, copy=False)


def _similar(forward: DataFrame, vocabulary: np.ndarray, weights: np.ndarray, documents: int, words: int) -> DataFrame:
    """(level, sim, doc_id, tie, terms, bases) of (doc_id, tie, n, terms, tfs). ``bases`` are the terms' impacts before
    their weights; ``level`` is the size of all impacts and ``sim`` holds the signs of their projections."""
    signs = [(T.mix(vocabulary) >> T.U64(j)) & T.U64(1) for j in range(PROJECTIONS)]
    signs = [np.where(s == 1, 1.0, -1.0) for s in signs]
    kind = forward.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            ends, terms = _values(batch.column(3), np.int64)
            _, tfs = _values(batch.column(4), np.int64)
            owner = np.repeat(np.arange(rows), np.diff(ends))
            m = 100 - 25 + (25 * batch.column(2).to_numpy() * documents) // words
            bases = (1000000000 * tfs) // (1000 * tfs + 12 * m[owner])
            impact = (weights[terms] * bases).astype(float)
            level = np.log2(np.maximum(np.bincount(owner, impact, rows), 1)) * 2
            sim = np.zeros(rows, np.int32)
            for j in range(PROJECTIONS):
                sim = sim * 2 + (np.bincount(owner, impact * signs[j][terms], rows) > 0)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(level.astype(np.int32)), pa.array(sim.astype(np.int32)), batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(bases, pa.int32()))],
                ["level", "sim", "doc_id", "tie", "terms", "bases"])

    return (forward.select("doc_id", "tie", "n", "terms", "tfs")
            .mapInArrow(run, f"level int, sim int, doc_id {kind}, tie long, terms array<int>, bases array<int>"))


def _blocks(similar: DataFrame, terms_in_all: int, cell_rows: int) -> DataFrame:
    """Blocks (cell, term, top, slots, bases): for a cell and a term, which documents of the cell hold it, their impacts
    and the greatest of them. The block of term -1 has the documents of the cell."""
    keys = ["level", "sim", "doc_id", "tie"]
    kind = similar.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = batch.num_rows
            ends, terms = _values(batch.column(1), np.int64)
            _, bases = _values(batch.column(2), np.int32)
            owner = np.repeat(np.arange(rows), np.diff(ends))
            key = owner // cell_rows * terms_in_all + terms
            order = np.argsort(key, kind="stable")
            key, bases, slots = key[order], bases[order], (owner[order] % cell_rows).astype(np.int16)
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(new)
            offsets = pa.array(np.append(at, len(key)), pa.int32())
            cells = -(-rows // cell_rows)
            own = pa.ListArray.from_arrays(pa.array(np.minimum(np.arange(cells + 1) * cell_rows, rows), pa.int32()),
                                           batch.column(0))
            tops = np.maximum.reduceat(bases, at) if len(at) else np.zeros(0, np.int32)
            names = ["cell", "term", "top", "slots", "bases", "docs"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + key[at] // terms_in_all), pa.array((key[at] % terms_in_all).astype(np.int32)),
                 pa.array(tops), pa.ListArray.from_arrays(offsets, pa.array(slots)),
                 pa.ListArray.from_arrays(offsets, pa.array(bases)), pa.nulls(len(at), own.type)], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + np.arange(cells)), pa.array(np.full(cells, -1, np.int32)), pa.nulls(cells, pa.int32()),
                 pa.nulls(cells, pa.list_(pa.int16())), pa.nulls(cells, pa.list_(pa.int32())), own], names)
            first += cells

    return (similar.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "terms", "bases")
            .mapInArrow(run, f"cell long, term int, top int, slots array<short>, bases array<int>, docs array<{kind}>"))


def _score(blocks: DataFrame, pairs: DataFrame, asked: tuple[np.ndarray, np.ndarray, np.ndarray],
           cell_rows: int) -> DataFrame:
    """(q, doc_id, score) of the documents of ``pairs`` (q, cell, least) that score at least ``least``."""
    first, whose, weight = asked  # per term: range of queries; those queries and the term's weight for them
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def run(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        empty = pa.table({"q": pa.array([], pa.int32()), "doc_id": pa.array([], blocks.schema.field("docs").type.value_type),
                          "score": pa.array([], pa.int64())})
        if not wanted.num_rows or not blocks.num_rows:
            return empty
        qs = wanted["q"].to_numpy()
        order = np.argsort(qs)
        qs, least = qs[order], wanted["least"].to_numpy()[order]
        blocks = blocks.combine_chunks()
        terms = blocks["term"].to_numpy()
        docs = blocks["docs"].chunk(0).take(pa.array(np.flatnonzero(terms == -1))).flatten()
        posted = np.flatnonzero(terms >= 0)
        rows = blocks.take(pa.array(posted)).combine_chunks()
        terms = terms[posted]
        if not len(terms):
            return empty
        ends, slots = _values(rows["slots"].chunk(0), np.int64)
        _, bases = _values(rows["bases"].chunk(0), np.int64)
        # Each block with each wanted query that asks for its term, then with each of its documents.
        count = first[terms + 1] - first[terms]
        at = T.ranges(first[terms], count)
        block = np.repeat(np.arange(len(terms)), count)
        place = np.searchsorted(qs, whose[at])
        hit = np.flatnonzero(qs[np.minimum(place, len(qs) - 1)] == whose[at])
        at, block, place = at[hit], block[hit], place[hit]
        size = np.diff(ends)[block]
        entry = T.ranges(ends[:-1][block], size)
        scores = np.zeros(len(qs) * cell_rows, np.int64)
        np.add.at(scores, np.repeat(place, size) * cell_rows + slots[entry], np.repeat(weight[at], size) * bases[entry])
        found = np.flatnonzero(scores >= np.repeat(np.maximum(least, 1), cell_rows))
        return pa.table({"q": pa.array(qs[found // cell_rows], pa.int32()), "doc_id": docs.take(pa.array(found % cell_rows)),
                         "score": pa.array(scores[found])})

    return (blocks.select("cell", "term", "slots", "bases", "docs").groupBy("cell")
            .cogroup(pairs.select("q", "cell", "least").groupBy("cell"))
            .applyInArrow(run, f"q int, doc_id {kind}, score long"))


def _search(docs: DataFrame, asked: list, top: int, cell_rows: int, seeds: int) -> DataFrame:
    """(q, rank, doc_id, score) for queries ``asked``: rows (q, terms, tfs)."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in asked]).view(T.U64))
    forward = stored(term_counts(docs.select("doc_id", "text"), "doc_id", vocabulary).where("n > 0")
                     .withColumn("tie", F.monotonically_increasing_id()), "search-terms")
    documents, words = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row for each different term that is asked for.
    seen = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(len(vocabulary), np.int64)
    df[[r["term"] for r in seen]] = [r["count"] for r in seen]
    weights = _weights(df, documents)

    terms = np.concatenate([np.searchsorted(vocabulary, np.array(r["terms"], np.int64).view(T.U64)) for r in asked])
    whose = np.repeat(np.array([r["q"] for r in asked], np.int32), [len(r["terms"]) for r in asked])
    times = np.concatenate([np.array(r["tfs"], np.int64) for r in asked])
    order = np.argsort(terms, kind="stable")
    terms, whose, weight = terms[order], whose[order], (times * weights[terms])[order]
    lookup = (np.searchsorted(terms, np.arange(len(vocabulary) + 1)), whose, weight)

    holding = forward.where(F.size("terms") > 0)
    blocks = stored(_blocks(_similar(holding, vocabulary, weights, documents, words), len(vocabulary), cell_rows),
                    "search-blocks")
    # Not more rows than PAIRS and one query more.
    asks = spark.createDataFrame(pa.table({"q": whose, "term": terms.astype(np.int32), "weight": weight}))
    bounds = stored(blocks.where("term >= 0").select("cell", "term", "top").join(F.broadcast(asks), "term")
                    .groupBy("q", "cell").agg(F.sum(F.col("weight") * F.col("top")).alias("bound")), "search-bounds")
    of_query = W.Window.partitionBy("q")
    highest = (bounds.withColumn("__n", F.row_number().over(of_query.orderBy(F.desc("bound"), "cell")))
               .where(F.col("__n") <= seeds).select("q", "cell", F.lit(1).cast("long").alias("least")))
    highest = stored(highest, "search-seeds")
    ranked = of_query.orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    near = blocks.join(highest.select("cell").distinct(), "cell", "left_semi")
    least = (_score(near, highest, lookup, cell_rows).withColumn("__n", F.row_number().over(ranked))
             .where(F.col("__n") <= top).groupBy("q").agg(F.max("__n").alias("__n"), F.min("score").alias("score"))
             .where(F.col("__n") == top).select("q", F.col("score").alias("least")))
    least = stored(least, "search-thresholds")
    open_ = (bounds.join(least, "q", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long")))
             .where(F.col("bound") >= F.col("least")))
    return (_score(blocks, open_, lookup, cell_rows).withColumn("rank", F.row_number().over(ranked))
            .where(F.col("rank") <= top).select("q", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, top: int = 20, cell_rows: int = CELL, seeds: int = SEEDS,
           pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) for each item (item_id, text).

    Terms are runs of ASCII letters, digits and other characters outside ASCII, with A-Z lower-cased; words are told
    apart by 64-bit hashes. The score is an integer form of BM25 over whole texts: the sum of
    ``w * ((10**9 * tf) div (1000 * tf + 12 * m))`` over the item's terms, repeats included, with
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 75 + (25 * n * N) div L``. Equal scores are ordered by
    doc_id, null first; every row of ``docs`` is a document of its own and every row of ``items`` a query of its own,
    whatever their ids. Documents or items without a term (null, empty) are found nowhere and find nothing.

    Items are taken in batches of about ``pairs`` different terms; each batch scans the documents once.
    """
    asked = stored(items.select(F.monotonically_increasing_id().alias("id"), "item_id", "text"), "search-items")
    terms = stored(term_counts(asked, "id").where("n > 0"), "search-asked")
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = -(-total // pairs)
    out = []
    for i in range(batches):
        own = terms.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i).orderBy("id").collect()
        if own:
            rows = [{"q": q, "terms": r["terms"], "tfs": r["tfs"]} for q, r in enumerate(own)]
            ids = docs.sparkSession.createDataFrame([(q, r["id"]) for q, r in enumerate(own)], "q int, id long")
            out.append(_search(docs, rows, top, cell_rows, seeds).join(F.broadcast(ids), "q").drop("q"))
    if not out:
        kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((items, "item_id"), (docs, "doc_id"))}
        return docs.sparkSession.createDataFrame(
            [], f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long")
    found = reduce(DataFrame.unionByName, out)
    return found.join(asked.select("id", "item_id"), "id").select("item_id", "rank", "doc_id", "score")


@query(sql=r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
sizes AS (SELECT row, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes),
tf AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(t) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
part AS (SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))) AS s
         FROM tf JOIN w USING (term) JOIN sizes USING (row), total),
scored AS (SELECT item_id, row, sum(k * s)::BIGINT AS score FROM q JOIN part USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
  FROM scored JOIN sizes USING (row) WHERE score > 0) WHERE rank <= 20
""")
def op13_blocked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
