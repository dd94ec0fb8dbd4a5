"""Benchmark decontamination by winnowing.

Test items and documents are cut into words; of every six consecutive 5-word hashes the least is a fingerprint. Any
ten consecutive words hold six such hashes, so equal spans of ten words share a fingerprint at the same place, and a
matching fingerprint is extended word by word to see whether ten words agree around it. Items of fewer than ten words
are one window of their own length and are found by its hash, again compared word by word.

The items' index lies in the shared folder as slices of bounded size. A document's task reads the slices one after the
other, so neither the driver nor a task holds all items, whatever their number.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import _text as T
from ._files import read_bytes, write_bytes
from .registry import query, table

WINDOW = 10
GRAM = 5
# Bytes of item texts in one slice of the index.
SLICE_BYTES = 16 << 20
# Matches of fingerprints that are extended at a time.
MATCHES = 1 << 18
RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "hit_starts array<int>, hit_stops array<int>")


def _hashed(piece: T.Piece) -> tuple[T.Words, np.ndarray]:
    found = T.words(piece, "alnum")
    return found, T.segment_hashes(piece.bytes, found.starts, found.stops, lower=True)


def _fingerprints(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the selected grams and their hashes."""
    grams = T.window_hashes(values, GRAM)
    places = T.selected(grams, T.whole(ends, GRAM), WINDOW - GRAM + 1)
    return places, grams[places]


def build_index(items: DataFrame, folder: str, slice_bytes: int = SLICE_BYTES) -> list[str]:
    """Write the slices of the index of (item_id, text) below ``folder``; their paths. Items without words are in none."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    named = items.select(F.col("item_id").cast("string").alias("item_id"), "text",
                         F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)).alias("slice"))

    def write(key, group):
        values, ends, last = [], [np.zeros(1, np.int64)], 0
        for piece in T.pieces(group["text"]):
            found, hashes = _hashed(piece)
            values.append(hashes)
            ends.append(found.ends[1:] + last)
            last += len(hashes)
        values, ends = np.concatenate([np.zeros(0, T.U64), *values]), np.concatenate(ends)
        lengths = np.diff(ends)
        places, prints = _fingerprints(values, ends)
        order = np.argsort(prints, kind="stable")
        short = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
        out = io.BytesIO()
        np.savez(out, values=values, ends=ends, places=places[order], prints=prints[order], short=short,
                 names=np.array([x or "" for x in group["item_id"].to_pylist()], dtype=np.str_))
        path = f"{folder}/slice-{key[0].as_py()}.npz"
        write_bytes(path, out.getvalue())
        return pa.table({"path": pa.array([path], pa.string())})

    written = named.groupBy("slice").applyInArrow(write, "path string")
    return sorted(row["path"] for row in written.collect())


class _Slice:
    def __init__(self, path: str):
        with np.load(io.BytesIO(read_bytes(path))) as stored:
            for name in stored.files:
                setattr(self, name, stored[name])
        self.owner = T.owners(self.ends)
        # Short items by length: their window's hash, in order.
        self.by_length = {}
        lengths = np.diff(self.ends)
        for n in np.unique(lengths[self.short]):
            items = self.short[lengths[self.short] == n]
            hashes = np.array([T.window_hashes(self.values[self.ends[i]:self.ends[i + 1]], int(n))[0] for i in items],
                              T.U64)
            order = np.argsort(hashes, kind="stable")
            self.by_length[int(n)] = (hashes[order], items[order])

    @property
    def items(self) -> int:
        return len(self.ends) - 1


def _pairs(hashes: np.ndarray, table: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``hashes``, place in sorted ``table``) of all equal values, at most about ``limit`` at a time."""
    lo = np.searchsorted(table, hashes, "left")
    n = np.searchsorted(table, hashes, "right") - lo
    at = np.flatnonzero(n)
    while len(at):
        take = max(1, int(np.searchsorted(np.cumsum(n[at]), limit, "right")))
        part, at = at[:take], at[take:]
        yield np.repeat(part, n[part]), T.ranges(lo[part], n[part])


def _extend(values: np.ndarray, ends: np.ndarray, owner: np.ndarray, at: np.ndarray, index: _Slice,
            to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that agree to the left and, from the fingerprint on, to the right: at most WINDOW - GRAM and WINDOW."""
    doc, item = owner[at], index.owner[to]
    sides = []
    for step, most in ((-1, WINDOW - GRAM), (1, WINDOW)):
        count, same = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for k in range(most):
            move = k if step > 0 else -1 - k
            a, b = at + move, to + move
            same &= (a >= ends[doc]) & (a < ends[doc + 1]) & (b >= index.ends[item]) & (b < index.ends[item + 1])
            same[same] = values[a[same]] == index.values[b[same]]
            count += same
        sides.append(count)
    return sides[0], sides[1]


def _hits(values: np.ndarray, ends: np.ndarray, index: _Slice) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, stop, item) of word ranges that the items of a slice share with the texts."""
    owner = T.owners(ends)
    places, prints = _fingerprints(values, ends)
    for at, to in _pairs(prints, index.prints, MATCHES):
        at, to = places[at], index.places[to]
        left, right = _extend(values, ends, owner, at, index, to)
        keep = (left + right >= WINDOW) & (right >= GRAM)
        yield at[keep] - left[keep], at[keep] + right[keep], index.owner[to[keep]]
    for n, (hashes, items) in index.by_length.items():
        grams = np.where(ok, T.window_hashes(values, n), 0) if len(ok := T.whole(ends, n)) else np.zeros(0, T.U64)
        inside = np.flatnonzero(ok)
        for at, to in _pairs(grams[inside], hashes, MATCHES):
            at, item = inside[at], items[to]
            same = np.ones(len(at), bool)
            for k in range(n):
                same &= values[at + k] == index.values[index.ends[item] + k]
            yield at[same], at[same] + n, item[same]


def match(texts, slices: list[str], cache: dict) -> pa.Table:
    """Per text of an Arrow column the columns of RESULT."""
    rows = {name.split()[0]: [] for name in RESULT.split(", ")}
    for piece in T.pieces(texts):
        found, values = _hashed(piece)
        ends = found.ends
        starts, stops, docs, names = [], [], [], []
        for path in slices:
            if path not in cache:
                cache.clear()
                cache[path] = _Slice(path)
            index = cache[path]
            for start, stop, item in _hits(values, ends, index):
                starts.append(start)
                stops.append(stop)
                doc = np.searchsorted(ends, start, "right") - 1
                pairs = np.unique(doc * index.items + item)
                docs.append(pairs // index.items)
                names.append(index.names[pairs % index.items])
        none = np.zeros(0, np.int64)
        mask = T.covered(np.concatenate([none, *starts]), np.concatenate([none, *stops]), int(ends[-1]))
        mask = np.concatenate([mask, [False]])
        total = np.concatenate([[0], np.cumsum(mask[:-1])])
        hit = total[ends[1:]] - total[ends[:-1]]
        doc, name = np.concatenate([none, *docs]), np.concatenate([np.zeros(0, np.str_), *names])
        order = np.argsort(doc, kind="stable")
        doc, name = doc[order], name[order]
        cuts = np.searchsorted(doc, np.arange(len(piece) + 1))
        for i in range(len(piece)):
            lo, hi = int(ends[i]), int(ends[i + 1])
            ids = sorted(set(name[cuts[i]:cuts[i + 1]].tolist()))
            rows["n_words"].append(hi - lo)
            rows["n_hit"].append(int(hit[i]))
            rows["n_items"].append(len(ids))
            rows["items_sha256"].append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            rows["contaminated"].append(bool(hit[i]))
            if hit[i]:
                step = np.diff(np.concatenate([[0], mask[lo:hi].view(np.int8), [0]]))
                rows["hit_starts"].append(np.flatnonzero(step == 1).tolist())
                rows["hit_stops"].append(np.flatnonzero(step == -1).tolist())
            else:
                rows["hit_starts"].append([])
                rows["hit_stops"].append([])
    kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(rows.items(), kinds)})


def decontaminate(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with RESULT: how many of its words lie in a window of an item.

    ``hit_starts`` and ``hit_stops`` are the ranges of hit words. Null and empty texts have no words and no hits;
    items without words are found nowhere; a null item_id is the empty string; items with one id count once; every
    repeated row gets the same result. The text of ``docs`` must be named ``text``.
    """
    spark = docs.sparkSession
    slices = build_index(items, scratch_path(spark, "benchmark-index"), slice_bytes)
    names = [f"c{i}" for i in range(len(keep))]
    inner = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text").alias("__text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]) + ", " + RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            found = match(batch.column(batch.num_columns - 1), slices, cache)
            columns = batch.columns[:-1] + [c.combine_chunks() for c in found.columns]
            yield pa.RecordBatch.from_arrays(columns, names + found.column_names)

    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *[x.split()[0] for x in RESULT.split(", ")])


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a hit, all columns kept."""
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return decontaminate(packed, items, ("row",), **options).where("NOT contaminated").select("row.*")


@query(sql=r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op10_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
