"""Words, hashes and windows of many texts at once, in numpy.

Texts of an Arrow batch are handled as one byte array in pieces of bounded size; every operation is a pass over an
array and none a loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes of text handled at a time. A longer text is a piece of its own.
PIECE_BYTES = 1 << 20
U64 = np.uint64
TOP = U64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one to one)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=4)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        powers = np.full(length, base, U64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    size = 1 << max(16, int(length - 1).bit_length())
    up, down = _powers(size)
    return up[:length], down[:length]


def byte_values(lower: bool = False) -> np.ndarray:
    """A random number per byte; with ``lower``, A-Z have those of a-z."""
    values = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


def word_bytes(kind: str) -> np.ndarray:
    """Which bytes are part of a word: anything but white space, or ASCII letters, digits and non-ASCII."""
    table = np.ones(256, bool)
    if kind == "space":
        table[[9, 10, 11, 12, 13, 32]] = False
    elif kind == "alnum":
        table[:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = False
        table[0x41:0x5B] = True  # lower-cased first
    else:
        raise ValueError(kind)
    return table


@dataclass
class Piece:
    """Texts ``first`` to ``first + len(self)`` of a column: their bytes and the places between them."""

    first: int
    bytes: np.ndarray
    ends: np.ndarray  # n + 1 offsets

    def __len__(self) -> int:
        return len(self.ends) - 1

    @property
    def buffer(self) -> memoryview:
        return memoryview(self.bytes)


def pieces(column, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of an Arrow column (null: empty), in pieces of about ``limit`` bytes."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for chunk in chunks:
        if chunk.null_count:
            chunk = chunk.fill_null("" if pa.types.is_string(chunk.type) or pa.types.is_large_string(chunk.type) else b"")
        chunk = chunk.cast(pa.large_binary())
        n = len(chunk)
        if n:
            offsets = np.frombuffer(chunk.buffers()[1], np.int64, n + 1, chunk.offset * 8)
            data = chunk.buffers()[2]
            data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            lo = 0
            while lo < n:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
                yield Piece(base + lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                lo = hi
        base += n


@dataclass
class Words:
    """Words of a piece: byte places and, per text, the numbers of its first word and of the next text's."""

    starts: np.ndarray
    stops: np.ndarray
    ends: np.ndarray  # n + 1 offsets into the words


def words(piece: Piece, kind: str = "space") -> Words:
    inside = word_bytes(kind)[piece.bytes]
    size = len(inside)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(piece) + 1, np.int64))
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = piece.ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, piece.ends))


def segment_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte range; equal ranges have equal hashes wherever they are."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.take(byte_values(lower), data, out=total[1:], mode="clip")
    total[1:] *= up[:len(data)]
    np.cumsum(total, out=total)
    sums = total[stops]
    sums -= total[starts]
    sums *= down[starts]
    return mix(sums)


def byte_windows(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` bytes."""
    return window_hashes(byte_values()[data], width, mixed=True)


def window_hashes(values: np.ndarray, width: int, mixed: bool = True) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values; runs across texts are included, the caller leaves them out."""
    n = len(values)
    if n < width:
        return np.zeros(0, U64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=total[1:])
    sums = total[width:] - total[:-width]
    sums *= down[:n - width + 1]
    return mix(sums) if mixed else sums


def release() -> None:
    """Give memory that a finished task no longer uses back to the system: its worker lives on."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def owners(ends: np.ndarray) -> np.ndarray:
    """Number of the text of each word (or byte)."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def whole(ends: np.ndarray, width: int) -> np.ndarray:
    """Which runs of ``width`` lie inside one text."""
    total = int(ends[-1])
    if total < width:
        return np.zeros(0, bool)
    return np.repeat(ends[1:], np.diff(ends))[:total - width + 1] >= np.arange(width, total + 1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def selected(hashes: np.ndarray, ok: np.ndarray, window: int) -> np.ndarray:
    """Winnowing: places whose hash is the least of some run of ``window`` hashes.

    Of ``window`` consecutive places inside one text at least one is selected, and which ones follows from their
    hashes alone: equal runs have equal selections. Places that are not ``ok`` are never selected.
    """
    if not len(hashes):
        return np.zeros(0, np.int64)
    kept = np.where(ok, hashes, TOP)
    if len(kept) < window:
        kept = np.concatenate([kept, np.full(window - len(kept), TOP, U64)])
    least = _sliding(kept, window, np.minimum)
    # A place is selected if it equals the largest of the minima of the runs that contain it.
    zero = np.zeros(window - 1, U64)
    most = _sliding(np.concatenate([zero, least, zero]), window, np.maximum)
    return np.flatnonzero((most == kept)[:len(hashes)] & ok)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of ranges one after the other: starts[0], starts[0] + 1, ..."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(np.asarray(starts, np.int64), lengths)


def covered(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Mask of the places inside any of the ranges."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops, -1)
    return np.cumsum(steps[:size]) > 0
