"""Jaccard join of documents on word shingles: a grouped prefix join.

Two sets of sizes n and m with a Jaccard of at least t share a shingle among the first ``n - ceil(t n) + 1`` of the one
and the first ``m - ceil(t m) + 1`` of the other, in any common order. Rare shingles come first, so these prefixes
share few. Documents with equal prefixes and sizes are one group; only groups are posted under shingles. Lists of
groups that share a shingle become candidate pairs, candidates are expanded to the distinct sets in them and verified.

Only classes of linked documents are wanted, so pairs of one class need no test: each list is first tested as a star
around its best-connected member, and only pairs across the classes found so far are then listed in full. An upper
bound of the overlap (shingles counted in hash ranges, more of them for larger sets) is applied before any set is
moved. Sets are compared by 32 bits of each shingle's hash, which can only make an intersection look larger; where it
is just large enough, by all 64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import _text as T
from ..session import stored
from ._tables import components
from .registry import query, table

SHINGLE = 5
PERCENT = 75
# Ranges of hashes in which a set's shingles are counted, doubled until there are at least as many as shingles. A count
# has two bits; 3 stands for 3 or more.
RANGES = 128
FULL = 255
# Counts compared at a time.
CELLS = 4 << 20
# A 32-bit intersection larger than needed by this many, and twice what is expected of sets of that size, is not due to
# equal halves of different hashes.
MARGIN = 32
# Bytes of text whose shingles are made at a time: a task's arrays are some twenty times as large.
PIECE_BYTES = 1 << 18
# Shingles counted together, and how many of the most frequent are put last. Both change the work, not the result.
COUNTED = 1 << 22
FREQUENT = 1 << 17
# Groups and lists a task remembers to skip repeats.
REMEMBERED = 1 << 20
# Members of a list compared in one task with as many others.
BLOCK = 1024
# Sets fetched by a list of their names; above it they are fetched by a join.
NAMED_SETS = 1 << 18
# Bits of the filter, 2^MARKS of them, that tells texts whose set is not wanted. It changes the work, not the result.
MARKS = 26
# What a text with a word holds: any character but white space.
WORDED = r"[^\x20\x09-\x0D]"
SKETCH = "n long, grp long, cls binary, ranges binary, prefix array<long>, key long"


def need(n, percent: int = PERCENT):
    """Least overlap of a set of n with a set that is similar enough."""
    return (percent * n + 99) // 100


def _sorting(owner: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Order by owner, then token; rows that are alike in any order. One sort by as much of both as 64 bits hold."""
    bits = int(owner.max(initial=0)).bit_length()
    if not bits:
        return np.argsort(tokens)
    key = (owner.astype(T.U64) << T.U64(64 - bits)) | (tokens >> T.U64(bits))
    order = np.argsort(key)
    key, tokens_ = key[order], tokens[order]
    if ((key[1:] == key[:-1]) & (tokens_[1:] < tokens_[:-1])).any():
        order = np.lexsort((tokens, owner))
    return order


def shingles(piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct shingles, in order of both. Texts of one to four words have one shingle."""
    found = T.words(piece)
    values = T.segment_hashes(piece.bytes, found.starts, found.stops, lower=True)
    ok = T.whole(found.ends, SHINGLE)
    at = np.flatnonzero(ok)
    owner = [T.owners(found.ends)[at]]
    tokens = [T.window_hashes(values, SHINGLE)[at]]
    counts = np.diff(found.ends)
    for n in range(1, SHINGLE):
        texts = np.flatnonzero(counts == n)
        if len(texts):
            owner.append(texts)
            tokens.append(T.mix(T.window_hashes(values, n)[found.ends[texts]] + T.U64(n)))
    owner, tokens = np.concatenate(owner), np.concatenate(tokens)
    order = _sorting(owner, tokens)
    owner, tokens = owner[order], tokens[order]
    if len(owner):
        keep = np.append(True, (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1]))
        owner, tokens = owner[keep], tokens[keep]
    return owner, tokens


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, T.U64), np.cumsum(values, dtype=T.U64)])
    return total[ends[1:]] - total[ends[:-1]]


def levels(n: np.ndarray) -> np.ndarray:
    """How often the ranges of a set of ``n`` are doubled."""
    n = np.asarray(n, np.int64)
    out = np.zeros(n.shape, np.int64)
    limit = RANGES
    while (n > limit).any():
        out += n > limit
        limit *= 2
    return out


def _counted_ranges(owner: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    level = levels(sizes)
    cuts = np.concatenate([[0], np.cumsum(RANGES << level)])
    at = cuts[owner] + (tokens >> (57 - level[owner]).astype(T.U64)).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=int(cuts[-1])), 3).astype(np.uint8).reshape(-1, 4)
    raw = (counts << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()
    return [raw[a:b] for a, b in zip((cuts[:-1] // 4).tolist(), (cuts[1:] // 4).tolist())]


def _classes(tokens: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """A 128-bit name of each set."""
    halves = [_sums(T.mix(tokens ^ T.U64(salt)), ends) for salt in (0x5BD1E9955BD1E995, 0xC2B2AE3D27D4EB4F)]
    raw = np.stack(halves, axis=1).astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def frequent_shingles(docs: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """The most frequent shingles, rarest first: from counts over all documents, taken in blocks, without the shingles
    that a block has fewer than three times. The table has a fixed size and only orders the prefixes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = np.zeros(1 << 16, T.U64), 0

        def counted(tokens):
            # Sorted in place: copies of a block would be most of what a task holds.
            tokens.sort()
            starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            counts = np.diff(starts, append=len(tokens))
            often = counts >= 3
            return pa.RecordBatch.from_arrays([pa.array(tokens[starts[often]].view(np.int64)), pa.array(counts[often])],
                                              ["token", "n"])

        for batch in batches:
            for piece in T.pieces(batch.column(0), PIECE_BYTES):
                tokens = shingles(piece)[1]
                if size + len(tokens) > len(waiting):
                    waiting.resize(max(2 * len(waiting), size + len(tokens)), refcheck=False)
                waiting[size:size + len(tokens)] = tokens
                size += len(tokens)
                if size >= COUNTED:
                    yield counted(waiting[:size])
                    size = 0
        if size:
            yield counted(waiting[:size])
        del waiting
        T.release()

    counts = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.where("n >= 16").orderBy(F.desc("n"), "token").limit(most).select("token").toArrow()
    return top.column("token").to_numpy()[::-1].copy().view(T.U64)


def sketches(docs: DataFrame, keep: list[str], frequent: np.ndarray | None = None,
             percent: int = PERCENT) -> DataFrame:
    """The ``keep`` columns of every row with SKETCH. The prefix is given for the first row of a group in each task and
    only if ``frequent`` is given; empty sets have none."""
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.xxhash64("text").alias("__key"),
                        F.col("text").alias("__text"))
    names = inner.columns[:-2]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[:-2]] + [SKETCH])
    if frequent is not None:
        order = np.argsort(frequent)
        table_ = docs.sparkSession.sparkContext.broadcast((frequent[order], (order + 1).astype(np.int64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for piece in T.pieces(batch.column(batch.num_columns - 1), PIECE_BYTES):
                owner, tokens = shingles(piece)
                sizes = np.bincount(owner, minlength=len(piece))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                classes = _classes(tokens, ends)
                ranges = _counted_ranges(owner, tokens, sizes)
                prefixes, groups = [[]] * len(piece), np.zeros(len(piece), T.U64)
                if frequent is not None:
                    known, ranks = table_.value
                    rank = np.zeros(len(tokens), np.int64)
                    if len(known) and len(tokens):
                        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                        rank = np.where(known[at] == tokens, ranks[at], 0)
                    order = np.lexsort((tokens, rank, owner))
                    first = np.where(sizes > 0, sizes - need(sizes, percent) + 1, 0)
                    chosen = tokens[order[T.ranges(ends[:-1], first)]]
                    cuts = np.concatenate([[0], np.cumsum(first)])
                    groups = T.mix(_sums(T.mix(chosen ^ T.U64(0x165667B19E3779F9)), cuts) + sizes.astype(T.U64))
                    prefixes = []
                    signed = chosen.view(np.int64)
                    for i, group in enumerate(groups.tolist()):
                        if group in seen or not sizes[i]:
                            prefixes.append(signed[:0])
                        else:
                            if len(seen) >= REMEMBERED:
                                seen.clear()
                            seen.add(group)
                            prefixes.append(signed[cuts[i]:cuts[i + 1]])
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array(sizes.astype(np.int64)), pa.array(groups.view(np.int64)), pa.array(classes, pa.binary()),
                     pa.array(ranges, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                    [c.split()[0] for c in SKETCH.split(", ")[:-1]]))
            if out:
                found = pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays(batch.columns[:-2] + found.columns + [batch.column(batch.num_columns - 2)],
                                                 names + found.schema.names + ["key"])
        T.release()

    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
                      *[c.split()[0] for c in SKETCH.split(", ")])


def _runs(batches: Iterable[pa.RecordBatch], columns: int, limit: int):
    """Rows sorted by their first ``columns`` columns, as whole runs of equal ones: (arrays, run starts, cut off)."""
    carry = None
    for batch in batches:
        arrays = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if carry is not None:
            arrays = [np.concatenate([a, b]) for a, b in zip(carry, arrays)]
        if not len(arrays[0]):
            continue
        change = np.zeros(len(arrays[0]), bool)
        change[0] = True
        for a in arrays[:columns]:
            change[1:] |= a[1:] != a[:-1]
        starts = np.flatnonzero(change)
        last = int(starts[-1])
        if last:
            yield [a[:last] for a in arrays], starts[:-1], False
        carry = [a[last:] for a in arrays]
        if len(carry[0]) > limit:
            yield carry, np.zeros(1, np.int64), True
            # The run's last row stays, so that its remainder is known to continue it.
            carry = [a[-1:] for a in carry]
    if carry is not None and len(carry[0]):
        yield carry, np.zeros(1, np.int64), False


def _lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (token, grp) in order: the rows of lists of two groups or more, each set of groups once per task."""
    seen: set[int] = set()
    hot = None
    for (tokens, groups), _, cut in _runs(batches, 1, REMEMBERED):
        keep = np.append(True, (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1]))
        tokens, groups = tokens[keep], groups[keep]
        starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        sizes = np.diff(np.append(starts, len(tokens)))
        names = T.mix(np.add.reduceat(T.mix(groups.view(T.U64)), starts) + sizes.astype(T.U64))
        if cut or tokens[0] == hot:
            # A list too long to be kept: passed on in parts under one name.
            names[0] = T.mix(tokens[:1].view(T.U64))[0]
            sizes[0] = max(sizes[0], 2)
            hot = tokens[0]
        chosen = []
        for i in np.flatnonzero(sizes >= 2).tolist():
            name = int(names[i])
            if tokens[starts[i]] != hot:
                if name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
            chosen.append(i)
        if chosen:
            real = np.diff(np.append(starts, len(tokens)))[chosen]
            at = T.ranges(starts[chosen], real)
            for lo in range(0, len(at), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names[chosen], real)[part].view(np.int64)), pa.array(tokens[at[part]]),
                     pa.array(np.repeat(sizes[chosen], real)[part]), pa.array(groups[at[part]])],
                    ["list", "token", "size", "grp"])


_UNPACKED = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
_UNPACKED[_UNPACKED == 3] = FULL


def _matrix(column, level: int, to: int) -> np.ndarray:
    """Counts of sets of one level, brought to a lower one; FULL stands for an unknown count of 3 or more."""
    packed = np.frombuffer(b"".join(column), np.uint8)
    out = _UNPACKED[packed].reshape(-1, RANGES << level)
    for _ in range(level - to):
        a, b = out[:, ::2], out[:, 1::2]
        out = np.where((a == FULL) | (b == FULL), FULL, a + b).astype(np.uint8)
    return out


def _may_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether the counts per range, as many in ``a`` as in ``b``, leave room for enough overlap.

    Ranges that are full on both sides together hold no more common shingles than either side has left for them: its
    size without its known counts, and without 3 for each range that is full on its side only.
    """
    full_a, full_b = a == FULL, b == FULL
    both = full_a & full_b
    least = np.minimum(a, b)
    least[both] = 0
    most = least.sum(axis=1, dtype=np.int64)
    some = both.sum(axis=1)
    left = [size - np.where(full, 3, x).sum(axis=1, dtype=np.int64) + 3 * some for x, size, full in
            ((a, n, full_a), (b, m, full_b))]
    most = most + np.where(some > 0, np.minimum(*left), 0)
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (100 * most >= percent * (n + m - most))


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of classes that the bound does not rule out."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 4))
            a, b = (np.array(batch.column(i).to_pylist(), object) for i in (3, 5))
            left, right = levels(n), levels(m)
            ok = np.zeros(len(n), bool)
            for x, y in set(zip(left.tolist(), right.tolist())):
                # Sets more than a level apart differ too much in size.
                if abs(x - y) <= 1:
                    to, both = min(x, y), np.flatnonzero((left == x) & (right == y))
                    for at in np.array_split(both, len(both) * (RANGES << max(x, y)) // CELLS + 1):
                        ok[at] = _may_link(_matrix(a[at], x, to), _matrix(b[at], y, to), n[at], m[at], percent)
            yield batch.select([0, 1]).filter(pa.array(ok))

    side = classes.select("cls", "n", "ranges")
    joined = (pairs.join(side.toDF("u", "n", "a"), "u").join(side.toDF("v", "m", "b"), "v")
              .select("u", "v", "n", "a", "m", "b"))
    return joined.mapInArrow(run, "u binary, v binary")


def _marks(keys: DataFrame) -> np.ndarray:
    """A filter of 2^MARKS bits, as 64-bit words, with those of the ``key`` column set; its size is fixed."""
    at = F.shiftrightunsigned("key", 64 - MARKS)
    words = (keys.select(F.shiftright(at, 6).cast("int").alias("word"),
                         F.expr("shiftleft(1L, CAST(shiftrightunsigned(key, %d) & 63 AS INT))" % (64 - MARKS)).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << max(0, MARKS - 6), T.U64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(T.U64)
    return out


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(T.U64) >> T.U64(64 - MARKS)
    return (marks[(at >> T.U64(6)).astype(np.int64)] >> (at & T.U64(63)) & T.U64(1)).astype(bool)


def _names(classes: list[bytes]) -> np.ndarray:
    """Names of sets as an array: a Python set of them would take five times the memory."""
    return np.frombuffer(b"".join(classes), "S16")


def _among(names: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which names are in the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(names), bool)
    return wanted[np.minimum(np.searchsorted(wanted, names), len(wanted) - 1)] == names


def _sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, kind: type) -> DataFrame:
    """(cls, tokens) of the wanted classes, computed anew from one text of each: tokens are the sorted upper bits of the
    hashes that ``kind`` has room for, in bytes. The filter passes over most other texts; what it lets through by chance
    goes by name."""
    shift = T.U64(64 - 8 * np.dtype(kind).itemsize)
    spark = docs.sparkSession
    names = None
    if wanted.count() <= NAMED_SETS:
        names = spark.sparkContext.broadcast(np.sort(_names(wanted.toArrow().column("cls").to_pylist())))
    marks = spark.sparkContext.broadcast(_marks(classes.select("cls", "key").join(wanted, "cls", "left_semi")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            near = _marked(marks.value, batch.column(0).to_numpy())
            if not near.any():
                continue
            for piece in T.pieces(batch.column(1).filter(pa.array(near)), PIECE_BYTES):
                owner, tokens = shingles(piece)
                ends = np.searchsorted(owner, np.arange(len(piece) + 1))
                cls, sets = [], []
                classes_ = _classes(tokens, ends)
                asked = np.diff(ends) > 0
                if names is not None:
                    asked &= _among(_names(classes_), names.value)
                for i in np.flatnonzero(asked).tolist():
                    name = classes_[i]
                    if name not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(name)
                        cls.append(name)
                        sets.append((tokens[ends[i]:ends[i + 1]] >> shift).astype(kind).tobytes())
                if cls:
                    yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(sets, pa.binary())],
                                                     ["cls", "tokens"])
        T.release()

    found = docs.select(F.xxhash64("text").alias("key"), "text").mapInArrow(run, "cls binary, tokens binary")
    if names is None:
        found = found.join(wanted, "cls", "left_semi")
    return found.groupBy("cls").agg(F.first("tokens").alias("tokens"))


def _spare(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[int, bool]:
    """100ths by which the overlap of two sets of hashes is more (or, below zero, less) than is needed, and whether this
    is so much that equal 32-bit halves of different hashes cannot be the reason."""
    both = np.sort(np.concatenate([np.unique(a), np.unique(b)]), kind="stable")
    # Equal halves inside one set: its size counts all of them, the intersection at most too many.
    size = len(a) + len(b)
    common = int((both[1:] == both[:-1]).sum()) + size - len(both)
    spare = 100 * common - percent * (size - common)
    # Of n hashes about n * n / 2^33 pairs have equal halves.
    return spare, spare >= (MARGIN + (size * size >> 32)) * (100 + percent)


def _overlaps(docs: DataFrame, pairs: DataFrame, classes: DataFrame, kind: type, percent: int) -> DataFrame:
    """(u, v, spare, sure) of pairs of classes, see ``_spare``, so far as hashes cut to ``kind`` tell."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_spare(np.frombuffer(a, kind), np.frombuffer(b, kind), percent)
                     for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.int64()),
                 pa.array([x for _, x in found], pa.bool_())], ["u", "v", "spare", "sure"])
        T.release()

    wanted = pairs.select(F.col("u").alias("cls")).union(pairs.select("v")).distinct()
    sets = stored(_sets(docs, wanted, classes, kind), "shingle-sets")
    joined = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v").select("u", "v", "a", "b")
    return joined.mapInArrow(run, "u binary, v binary, spare long, sure boolean")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose sets are similar enough. ``pairs`` is a written table."""
    if pairs.isEmpty():
        return pairs
    found = stored(_overlaps(docs, pairs, classes, np.uint32, percent).where("spare >= 0"), "shingle-overlaps")
    close = stored(found.where("NOT sure").select("u", "v"), "shingle-close")
    out = found.where("sure").select("u", "v")
    if close.isEmpty():
        return out
    return out.union(_overlaps(docs, close, classes, np.uint64, percent).where("spare >= 0").select("u", "v"))


def _across(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From (list, left, right, block, n, cls, label, ranges) in order of the first three: pairs of one list that lie
    in different classes and may be linked. A pair of blocks is compared where its blocks meet."""
    seen: set[bytes] = set()
    found: list[tuple[bytes, bytes]] = []
    for arrays, starts, _ in _runs(batches, 3, 1 << 62):
        _, left, right, block, sizes, cls, label, ranges = arrays
        for lo, hi in zip(starts.tolist(), np.append(starts[1:], len(left)).tolist()):
            order = lo + np.argsort(sizes[lo:hi], kind="stable")
            n, own = sizes[order], block[order]
            names = np.unique(label[order], return_inverse=True)[1]
            if names.max(initial=0) == 0:
                continue
            level = levels(n)
            # Rows in order of size are in order of level: the counts of each level, and those brought to the one below.
            first = {int(x): int(np.searchsorted(level, x)) for x in np.unique(level)}
            of = {x: _matrix(ranges[order[level == x]], x, x) for x in first}
            below = {x: _matrix(ranges[order[level == x]], x, x - 1) for x in first if x}
            stop = np.searchsorted(percent * n, 100 * n, "right")
            for i in range(len(order)):
                js = np.arange(i + 1, stop[i])
                js = js[names[js] != names[i]]
                if left[lo] != right[lo]:
                    js = js[own[js] != own[i]]
                # Later sets are larger: of the same level, or one above.
                js = js[level[js] - level[i] <= 1]
                if len(js):
                    x = int(level[i])
                    same, next_ = js[level[js] == x], js[level[js] == x + 1]
                    rows = of[x][same - first[x]]
                    if len(next_):
                        rows = np.concatenate([rows, below[x + 1][next_ - first[x + 1]]])
                    ok = _may_link(of[x][i - first[x]][None, :], rows, n[i], n[js], percent)
                    for j in js[ok].tolist():
                        pair = tuple(sorted((bytes(cls[order[i]]), bytes(cls[order[j]]))))
                        key = pair[0] + pair[1]
                        if key not in seen:
                            if len(seen) >= REMEMBERED // 4:
                                seen.clear()
                            seen.add(key)
                            found.append(pair)
            if len(found) >= 1 << 14:
                yield _pair_batch(found)
                found = []
    if found:
        yield _pair_batch(found)


def _pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["u", "v"])


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return (members.join(labels, members.cls == labels.node, "left")
            .withColumn("label", F.coalesce("label", "cls")).drop("node"))


def link_classes(docs: DataFrame, sketched: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, label): sets that have a link to another one, and the least set that links reach."""
    spark = docs.sparkSession
    lists = (sketched.select(F.explode("prefix").alias("token"), "grp")
             .repartition("token").sortWithinPartitions("token", "grp")
             .mapInArrow(_lists, "list long, token long, size long, grp long"))
    lists = (lists.withColumn("chosen", F.min("token").over(W.Window.partitionBy("list")))
             .where("token = chosen").select("list", "size", "grp"))
    classes = stored(sketched.where("n > 0").groupBy("grp", "cls", "n")
                     .agg(F.first("ranges").alias("ranges"), F.first("key").alias("key")), "shingle-classes")
    # Sets of one group are a list of their own.
    many = classes.groupBy("grp").agg(F.count("*").alias("size")).where("size > 1")
    named = classes.select("grp", "cls", "n")
    members = stored(lists.join(named, "grp").select("list", "size", "cls", "n")
                     .union(named.join(many, "grp").select(F.xxhash64("grp").alias("list"), "size", "cls", "n"))
                     .distinct(), "shingle-lists")
    scores = members.groupBy("cls").agg(F.sum("size").alias("score"))
    links, labels = None, None
    while True:
        if labels is None:
            ranked = members.join(scores, "cls").withColumn("label", F.col("cls"))
            best = F.struct("score", "cls")
        else:
            labelled = _labelled(members, labels)
            weights = labels.groupBy("label").agg(F.count("*").alias("weight"))
            ranked = (labelled.join(weights, "label", "left").join(scores, "cls"))
            best = F.struct(F.coalesce("weight", F.lit(1)), F.xxhash64("cls", "list"), "cls")
        top = ranked.groupBy("list").agg(F.max_by(F.struct("cls", "label", "n"), best).alias("top"),
                                          F.count("*").alias("members"))
        if labels is not None:
            # The first star has tested the one pair of a list of two.
            top = top.where("members > 2")
        # Sets too different in size cannot link: such pairs go before any counts are moved.
        close = F.least("n", "top.n") * 100 >= F.greatest("n", "top.n") * percent
        star = (ranked.join(top, "list").where("label <> top.label").where(close)
                .select(F.least("cls", "top.cls").alias("u"), F.greatest("cls", "top.cls").alias("v")).distinct())
        tested = stored(_bounded(star, classes, percent), "shingle-pairs")
        found = stored(_verified(docs, tested, classes, percent), "shingle-links")
        tests, new = tested.count(), found.count()
        links = found if links is None else links.union(found)
        labels = stored(components(links), "shingle-labels")
        # Another star pays where many members joined the centre's class: of the rest many may join its other members.
        if new <= max(64, tests // 4) or new == 0:
            break
    labelled = _labelled(members, labels)
    open_lists = (labelled.groupBy("list").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                               F.count("*").alias("members"))
                  .where("lo <> hi AND members > 2").select("list", "members"))
    rank = F.row_number().over(W.Window.partitionBy("list").orderBy("n", "cls")) - 1
    placed = (labelled.join(open_lists, "list")
              .withColumn("block", F.when(F.col("members") > BLOCK, F.floor(rank / BLOCK)).otherwise(F.lit(0)).cast("int"))
              .join(classes.select("cls", "ranges"), "cls")
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("members") - 1) / BLOCK).cast("int")))))
    across = (placed.select("list", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                            "block", "n", "cls", "label", "ranges")
              .repartition("list", "left", "right").sortWithinPartitions("list", "left", "right")
              .mapInArrow(lambda batches: _across(batches, percent), "u binary, v binary"))
    rest = stored(across.distinct().join(tested, ["u", "v"], "left_anti"), "shingle-pairs")
    if rest.isEmpty():
        return labels
    return components(links.union(stored(_verified(docs, rest, classes, percent), "shingle-links")))


def _joined(docs: DataFrame, percent: int) -> DataFrame:
    """The columns of ``join_documents`` and the hash of the text, as ``key``."""
    texts = docs.select("doc_id", "text")
    frequent = frequent_shingles(texts)
    sketched = stored(sketches(texts, ["doc_id"], frequent, percent), "shingle-sketches")
    labels = stored(link_classes(texts, sketched, percent), "shingle-labels")
    rows = _labelled(sketched.select("doc_id", "n", "cls", "key"), labels)
    least = rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return (rows.join(least, "label", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), "cls",
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "key"))


def join_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, cls, component_id) of every row of ``docs`` (doc_id, text).

    Two documents link when 100 times the size of their sets' intersection is at least ``percent`` times that of the
    union; a component's id is its least doc_id. Null and empty texts, and texts of white space, have the empty set and
    link with nothing. Repeated rows link like any others. A row whose doc_id is null links as well, and has no id to
    give: its component has the least doc_id that is not null, or null.
    """
    return _joined(docs, percent).drop("key")


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the one that gives it its id. Documents with the empty set all stay."""
    # A struct is equal to another one of the same null.
    kept = stored(_joined(docs, percent).where("n_shingles > 0 AND doc_id <=> component_id")
                  .groupBy(F.struct("doc_id").alias("id"), "cls").agg(F.min("key").alias("key"))
                  .select("id", "key"), "shingle-components")
    # Whole rows travel as one column, so that no name of theirs meets one of the join. They pass no Python worker: the
    # hash of its text tells which row of an id is kept.
    packed = docs.select(F.struct("doc_id").alias("id"), F.xxhash64("text").alias("key"),
                         F.coalesce(F.col("text").rlike(WORDED), F.lit(False)).alias("worded"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    first = F.row_number().over(W.Window.partitionBy("id", "key").orderBy("key"))
    chosen = (packed.where("worded").join(kept, ["id", "key"], "left_semi")
              .withColumn("copy", first).where("copy = 1"))
    return chosen.select("row.*").union(packed.where("NOT worded").select("row.*"))


@query(sql=r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT DISTINCT u AS a, u AS b FROM link UNION SELECT a, v FROM reach JOIN link ON b = u),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
""")
def op6_grouped_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return join_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
