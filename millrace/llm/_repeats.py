"""What the two operators for repeated passages share: sampled suffixes of the texts whose beginnings occur twice.

A text is a row of units (bytes or words) and a window is ``width`` of them. Of the runs of ``gram`` units in any
window at least one is selected by its hash (winnowing), at the same place wherever the window occurs. So it is enough
to look at the suffixes that start at selected places, together with the few units on their left: two equal windows
are equal parts of the contexts of two suffixes with one beginning.

1. The beginnings (hashes) are counted; those that occur once are gone.
2. Texts meet the repeated beginnings of their bucket. Equal contexts of one bucket are settled there, and one of them
   speaks for all. Texts with one opening share a bucket, so that copies mostly meet here.
3. Contexts are dealt out by their beginning and compared window by window (this is where the operators differ).
   A beginning that occurs more than ``HOT`` times would be too much for one task: its windows are dealt out one by
   one, each under a digest of itself.
4. Spans return to their texts.

Texts are shuffled once: steps 2 and 4 read the same exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import _text as T
from ..session import stored

# Bytes of text meant for one bucket.
BUCKET_BYTES = 4 << 20
# Characters of a text's opening, by which it is put into a bucket.
OPENING = 48
# Occurrences of a beginning that one task may compare.
HOT = 1 << 17
# Rows compared at a time.
ROWS = 1 << 16

SPAN, CONTEXT, WINDOW, MANY = 0, 1, 2, 3
ROW = "key binary, kind int, suffix binary, before binary, bucket long, doc_id long, tie long, start long, stop long"
NAMES = [c.split()[0] for c in ROW.split(", ")]
SPANS = "bucket long, doc_id long, tie long, start long, stop long"
SPAN_NAMES = [c.split()[0] for c in SPANS.split(", ")]
# Stands for a null doc_id in orders: before all others.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Unit:
    """How texts are cut: ``kind`` is "byte" or "space" (words between white space)."""

    kind: str
    width: int
    gram: int
    earlier: bool  # whether only later occurrences of a window count, or all of them

    @property
    def left(self) -> int:
        return self.width - self.gram


@dataclass
class Cut:
    """The units of a piece: their values, text offsets, and their places in bytes."""

    values: np.ndarray
    ends: np.ndarray
    starts: np.ndarray | None
    stops: np.ndarray | None


def cut(piece: T.Piece, unit: Unit) -> Cut:
    if unit.kind == "byte":
        return Cut(T.byte_values()[piece.bytes], piece.ends, None, None)
    found = T.words(piece, unit.kind)
    return Cut(T.segment_hashes(piece.bytes, found.starts, found.stops), found.ends, found.starts, found.stops)


def anchors(found: Cut, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the selected runs of ``gram`` units."""
    grams = T.window_hashes(found.values, unit.gram)
    places = T.selected(grams, T.whole(found.ends, unit.gram), unit.width - unit.gram + 1)
    return places, grams[places]


def value_segments(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    up, down = T.powers(len(values) + 1)
    total = np.zeros(len(values) + 1, T.U64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return T.mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(T.U64))


def in_buckets(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """(bucket, doc_id, text). Texts with one opening share a bucket; the openings of more texts than fit into a few
    buckets are spread over several by doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.xxhash64(F.substring(text, 1, OPENING)).alias("opening"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # One row for each opening that fills more than two buckets.
    hot = stored(named.groupBy("opening").agg(F.sum(F.octet_length("text")).alias("bytes"))
                 .where(F.col("bytes") > 2 * bucket_bytes)
                 .select("opening", F.ceil(F.col("bytes") / bucket_bytes).alias("parts")), "hot-openings")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return (named.join(hot, "opening", "left")
            .select(F.pmod(F.xxhash64("opening", part), F.lit(buckets)).alias("bucket"), "doc_id", "text"))


def repeated_grams(bucketed: DataFrame, unit: Unit) -> DataFrame:
    """(bucket, gram, total) of the beginnings that occur at least twice; total counts all occurrences."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            for piece in T.pieces(batch.column(1)):
                found = cut(piece, unit)
                places, grams = anchors(found, unit)
                owner = np.searchsorted(found.ends, places, "right") - 1
                bucket = buckets[piece.first + owner]
                order = np.lexsort((bucket, grams))
                grams, bucket = grams[order], bucket[order]
                first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (bucket[1:] != bucket[:-1]))[:len(grams)])
                n = np.diff(np.append(first, len(grams)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[first].view(np.int64)), pa.array((bucket[first] << 20) + np.minimum(n, (1 << 20) - 1))],
                    ["gram", "code"])

    counted = bucketed.select("bucket", "text").mapInArrow(run, "gram long, code long")
    same = W.Window.partitionBy("gram")
    n = F.col("code").bitwiseAND((1 << 20) - 1)
    return (counted.withColumn("total", F.sum(n).over(same)).where("total > 1")
            .select(F.shiftright("code", 20).alias("bucket"), "gram", "total"))


def _documents(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts, doc_ids and ties of a bucket in document order. Rows of one doc_id and text get ties of their own."""
    table = table.combine_chunks()
    texts = table["text"].combine_chunks() if isinstance(table["text"], pa.ChunkedArray) else table["text"]
    ids = table["doc_id"].fill_null(NO_ID).to_numpy()
    ties = []
    for piece in T.pieces(texts):
        ties.append(T.segment_hashes(piece.bytes, piece.ends[:-1], piece.ends[1:]).view(np.int64))
    ties = np.concatenate([np.zeros(0, np.int64), *ties])
    order = np.lexsort((ties, ids))
    ids, ties = ids[order], ties[order].copy()
    again = np.append(False, (ids[1:] == ids[:-1]) & (ties[1:] == ties[:-1]))[:len(ids)]
    if again.any():
        start = np.maximum.accumulate(np.where(again, 0, np.arange(len(ids))))
        with np.errstate(over="ignore"):
            ties += np.arange(len(ids)) - start
    return texts.take(pa.array(order)), ids, ties


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each document, overlapping and adjoining ones made one."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # Documents are laid out far apart, so that one running maximum serves all.
    far = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + doc * far)
    new = np.append(True, (start[1:] + doc[1:] * far > reach[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - doc[last] * far


def _contexts(unit: Unit, hot: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = {name: [] for name in NAMES}
        if left.num_rows and right.num_rows:
            bucket = left["bucket"][0].as_py()
            texts, ids, ties = _documents(left)
            grams, at = np.unique(right["gram"].to_numpy().view(T.U64), return_index=True)
            totals = right["total"].to_numpy()[at]
            parts, pieces = [], list(T.pieces(texts))
            for i, piece in enumerate(pieces):
                found = cut(piece, unit)
                places, hashes = anchors(found, unit)
                slot = np.minimum(np.searchsorted(grams, hashes), len(grams) - 1)
                keep = grams[slot] == hashes
                places, slot = places[keep], slot[keep]
                doc = np.searchsorted(found.ends, places, "right") - 1
                lo = np.maximum(found.ends[doc], places - unit.left)
                hi = np.minimum(found.ends[doc + 1], places + unit.width)
                fits = hi - lo >= unit.width
                places, slot, doc, lo, hi = (x[fits] for x in (places, slot, doc, lo, hi))
                context = T.mix(value_segments(found.values, lo, hi) + T.mix((places - lo).astype(T.U64)))
                if found.starts is None:
                    spots = lo, places, hi
                else:
                    spots = found.starts[lo], found.starts[places], found.stops[hi - 1]
                parts.append((np.full(len(places), i), doc + piece.first, places - found.ends[doc], lo - found.ends[doc],
                              hi - found.ends[doc], context, totals[slot], *spots))
            which, doc, place, lo, hi, context, total, a, b, c = (np.concatenate(x) for x in zip(*parts))
            # Units are in order of documents and places, so the first of equal contexts is the earliest.
            _, first, same, count = np.unique(context, return_index=True, return_inverse=True, return_counts=True)
            settled = np.ones(len(doc), bool)
            if unit.earlier:
                settled[first] = False
            else:
                settled = count[same] > 1
            d, s, e = _merged(doc[settled], lo[settled], hi[settled])
            keys = T.mix(ties[d].view(T.U64) + s.astype(T.U64)).astype(">u8").tobytes()
            _add(rows, key=[keys[i:i + 8] for i in range(0, len(keys), 8)], kind=[SPAN] * len(d), suffix=[None] * len(d),
                 before=[None] * len(d), bucket=[bucket] * len(d), doc_id=ids[d], tie=ties[d], start=s, stop=e)
            buffers = [p.bytes.tobytes() for p in pieces]
            one = np.sort(first)
            ordinary = one[total[one] <= hot]
            many = count[same] > 1
            after = [buffers[w][x:y] for w, x, y in zip(which[ordinary].tolist(), b[ordinary].tolist(), c[ordinary].tolist())]
            kind = np.where(many[ordinary] & (not unit.earlier), MANY, CONTEXT)
            _add(rows, key=[_beginning(x, unit) for x in after], kind=kind, suffix=after,
                 before=[buffers[w][x:y] for w, x, y in
                         zip(which[ordinary].tolist(), a[ordinary].tolist(), b[ordinary].tolist())],
                 bucket=[bucket] * len(ordinary), doc_id=ids[doc[ordinary]], tie=ties[doc[ordinary]],
                 start=place[ordinary], stop=[0] * len(ordinary))
            for i in one[total[one] > hot].tolist():
                words = _units(buffers[which[i]][a[i]:c[i]], unit)
                n = hi[i] - lo[i] - unit.width + 1
                _add(rows, key=[_digest(words[j:j + unit.width], unit) for j in range(n)],
                     kind=[WINDOW if unit.earlier or not many[i] else MANY] * n, suffix=[None] * n, before=[None] * n,
                     bucket=[bucket] * n, doc_id=[int(ids[doc[i]])] * n, tie=[int(ties[doc[i]])] * n,
                     start=list(range(lo[i], lo[i] + n)), stop=list(range(lo[i] + unit.width, lo[i] + n + unit.width)))
        kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 5
        return pa.table([pa.concat_arrays([pa.array(x, kind) for x in rows[name]] or [pa.array([], kind)])
                         for name, kind in zip(NAMES, kinds)], names=NAMES)

    return run


def _add(rows: dict, **columns) -> None:
    for name, values in columns.items():
        rows[name].append(values)


def _units(raw: bytes, unit: Unit):
    return raw if unit.kind == "byte" else raw.split()


def _beginning(suffix: bytes, unit: Unit) -> bytes:
    if unit.kind == "byte":
        return suffix[:unit.gram]
    return b" ".join(suffix.split(None, unit.gram)[:unit.gram])


def _digest(window, unit: Unit) -> bytes:
    raw = window if unit.kind == "byte" else b" ".join(window)
    # Not as long as any beginning and marked, so that it never sorts among contexts.
    return b"\xff" + hashlib.md5(raw, usedforsecurity=False).digest()


def multikey_order(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of rows by group and then by their words from left to right. Each round sorts by one more word, and only
    the rows that are equal so far."""
    order = np.argsort(group, kind="stable")
    tied = group[order]
    same = np.flatnonzero(np.append(False, tied[1:] == tied[:-1]) | np.append(tied[1:] == tied[:-1], False))
    label = np.cumsum(np.append(True, tied[1:] != tied[:-1]))[:len(tied)]
    for k in range(words.shape[1]):
        if not len(same):
            break
        rows = order[same]
        inner = np.lexsort((words[rows, k], label[same]))
        rows, own = rows[inner], label[same][inner]
        order[same] = rows
        value = words[rows, k]
        equal = (own[1:] == own[:-1]) & (value[1:] == value[:-1])
        # New labels keep the old order: a place's own number is unique and grows.
        label[same] = np.maximum.accumulate(np.where(np.append(True, ~equal), same, 0))
        same = same[np.append(False, equal) | np.append(equal, False)]
    return order


def shared_lengths(rows: np.ndarray) -> np.ndarray:
    """For each row, with how many leading columns it agrees with the row before (the first: 0)."""
    equal = rows[1:] == rows[:-1]
    length = np.where(equal.all(axis=1), rows.shape[1], np.argmin(equal, axis=1)) if len(rows) > 1 else np.zeros(0, int)
    return np.append(0, length)[:len(rows)]


def flagged_offsets(group: np.ndarray, right: np.ndarray, n_right: np.ndarray, left: np.ndarray, n_left: np.ndarray,
                    rank: np.ndarray, many: np.ndarray, unit: Unit, order_of: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Per context the least and the largest offset (units left of the suffix) of its windows that are repeated; the
    largest is -1 where none is.

    ``right`` holds the suffixes' units (columns from the suffix on), ``left`` those before, nearest first. Suffixes
    are sorted, and with the lengths that neighbours share the classes of suffixes with equal first ``width - l`` units
    are read off for every l; likewise for the left sides. A window is a pair of classes.
    """
    n = len(group)
    ids = []
    for side in (right, left):
        order = order_of(group, side)
        fresh = np.append(True, group[order][1:] != group[order][:-1])[:n]
        ids.append((order, fresh, shared_lengths(side[order])))
    least, largest = np.full(n, unit.width), np.full(n, -1)
    by_rank = np.argsort(rank, kind="stable")
    for l in range(unit.left + 1):
        rows = by_rank[(n_left[by_rank] >= l) & (n_right[by_rank] >= unit.width - l)]
        if len(rows) < 2 and not many[rows].any():
            continue
        classes = []
        for (order, fresh, shared), need in zip(ids, (unit.width - l, l)):
            number = np.empty(n, np.int64)
            number[order] = np.cumsum(fresh | (shared < need))
            classes.append(number)
        pair = classes[0][rows] * (n + 1) + classes[1][rows]
        _, first, same, count = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        if unit.earlier:
            hit = np.ones(len(rows), bool)
            hit[first] = False
        else:
            hit = (count + np.bincount(same, weights=many[rows], minlength=len(count)))[same] > 1
        rows = rows[hit]
        largest[rows] = l
        least[rows] = np.minimum(least[rows], l)
    return least, largest


def compare(unit: Unit, matrices: Callable, order_of: Callable = multikey_order) -> Callable:
    """A function for mapInArrow over rows in order of their keys: the spans of repeated windows."""
    def settle(table: pa.Table) -> pa.RecordBatch:
        kind = table["kind"].to_numpy()
        keys = table["key"].combine_chunks().dictionary_encode()
        keys = (keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys).indices.to_numpy()
        bucket, doc, tie, start, stop = (table[c].to_numpy() for c in SPAN_NAMES)
        out = [np.flatnonzero(kind == SPAN)]
        starts, stops = [start[out[0]]], [stop[out[0]]]
        rows = np.flatnonzero((kind == CONTEXT) | ((kind == MANY) & table["suffix"].is_valid().to_numpy()))
        if len(rows):
            some = table.take(pa.array(rows))
            right, n_right = matrices(some["suffix"].to_pylist(), unit.width, False)
            left, n_left = matrices(some["before"].to_pylist(), unit.left, True)
            rank = np.empty(len(rows), np.int64)
            rank[np.lexsort((start[rows], tie[rows], doc[rows]))] = np.arange(len(rows))
            many = kind[rows] == MANY
            least, largest = flagged_offsets(keys[rows], right, n_right, left, n_left, rank, many, unit, order_of)
            hit = (largest >= 0) & ~many
            out.append(rows[hit])
            starts.append(start[rows[hit]] - largest[hit])
            stops.append(start[rows[hit]] - least[hit] + unit.width)
        rows = np.flatnonzero((kind == WINDOW) | ((kind == MANY) & ~table["suffix"].is_valid().to_numpy()))
        if len(rows):
            rows = rows[np.lexsort((-kind[rows], start[rows], tie[rows], doc[rows], keys[rows]))]
            # A window around two selected places comes twice.
            fresh = np.ones(len(rows), bool)
            fresh[1:] = np.any([x[rows][1:] != x[rows][:-1] for x in (keys, doc, tie, start)], axis=0)
            rows = rows[fresh]
            again = np.append(False, keys[rows][1:] == keys[rows][:-1])
            if not unit.earlier:
                again = (again | np.append(again[1:], False)) & (kind[rows] != MANY)
            out.append(rows[again])
            starts.append(start[rows[again]])
            stops.append(stop[rows[again]])
        rows = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[rows], doc[rows], tie[rows], np.concatenate(starts),
                                                                 np.concatenate(stops))], SPAN_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                # Whole keys only: the last one may go on.
                table = pa.Table.from_batches(waiting).combine_chunks()
                keys = table["key"].combine_chunks()
                last, lo, hi = keys[len(keys) - 1].as_py(), 0, len(keys)
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if keys[mid].as_py() < last else (lo, mid)
                if lo:
                    yield settle(table.slice(0, lo))
                waiting = table.slice(lo).combine_chunks().to_batches()
                size = len(keys) - lo
        if size:
            yield settle(pa.Table.from_batches(waiting).combine_chunks())

    return run


def remove(docs: DataFrame, unit: Unit, matrices: Callable, finish: Callable, schema: str,
           bucket_bytes: int = BUCKET_BYTES, hot: int = HOT, order_of: Callable = multikey_order) -> DataFrame:
    """Rows of ``finish(piece, doc_ids, per-text list of (starts, stops))`` for every row of ``docs``."""
    bucketed = in_buckets(docs, bucket_bytes)
    grams = repeated_grams(bucketed, unit)
    contexts = bucketed.groupBy("bucket").cogroup(grams.groupBy("bucket")).applyInArrow(_contexts(unit, hot), ROW)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = (contexts.repartitionByRange(parts, "key").sortWithinPartitions("key")
             .mapInArrow(compare(unit, matrices, order_of), SPANS))

    def close(left, right):
        if not left.num_rows:
            return pa.table([pa.array([], f.type) for f in empty], names=empty.names)
        texts, ids, ties = _documents(left)
        doc_id, tie, start, stop = (right[c].to_numpy() for c in ("doc_id", "tie", "start", "stop"))
        slots = {key: i for i, key in enumerate(zip(ids.tolist(), ties.tolist()))}
        doc = np.array([slots[key] for key in zip(doc_id.tolist(), tie.tolist())], np.int64)
        doc, start, stop = _merged(doc, start, stop)
        edges = np.searchsorted(doc, np.arange(len(ids) + 1))
        out = []
        for piece in T.pieces(texts):
            rows = range(piece.first, piece.first + len(piece))
            names = pa.array(ids[rows.start:rows.stop], mask=ids[rows.start:rows.stop] == NO_ID)
            out.append(finish(piece, names, [(start[edges[i]:edges[i + 1]], stop[edges[i]:edges[i + 1]]) for i in rows]))
        return pa.concat_tables(out)

    empty = finish(next(T.pieces(pa.array([""]))), pa.array([0]), [(np.zeros(0, int), np.zeros(0, int))]).schema
    return bucketed.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(close, schema)
