"""Hashes of the words or lines of texts of any length, a bounded stretch of bytes at a time."""

from __future__ import annotations

import numpy as np

from . import _text as T

STRETCH_BYTES = 1 << 20
_BASE = T._BASE
_INVERSE = pow(_BASE, -1, 1 << 64)


def line_bytes() -> np.ndarray:
    """Which bytes are part of a line."""
    table = np.ones(256, bool)
    table[10] = False
    return table


def runs(piece: T.Piece, inside: np.ndarray, lower: bool = False, step: int = STRETCH_BYTES
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs of bytes for which ``inside`` holds: first bytes, 64-bit hashes, and per text the number of its
    first run. Equal runs have equal hashes, those of ``T.segment_hashes``. Per byte of text only a stretch is held."""
    data, size = piece.bytes, len(piece.bytes)
    values = T.byte_values(lower)
    begins = piece.ends[1:-1]
    begins = begins[(begins > 0) & (begins < size)]
    carry = T.U64(0)
    starts, from_sums, scales, to_sums = [], [], [], []
    for lo in range(0, size, step):
        hi = min(size, lo + step)
        n = hi - lo
        # Inside or not, from the byte before the stretch to the byte behind it.
        flags = np.zeros(n + 2, bool)
        first, last = max(lo - 1, 0), min(hi + 1, size)
        flags[first - lo + 1:last - lo + 1] = inside[data[first:last]]
        cut = np.zeros(n + 1, bool)
        cut[begins[np.searchsorted(begins, lo):np.searchsorted(begins, hi, "right")] - lo] = True
        here = flags[1:n + 1] & (~flags[:n] | cut[:n])
        # A run ends before place i (1 to n) if the byte before is inside and the one at i is not, or another text's.
        ends_here = flags[1:n + 1] & (~flags[2:] | cut[1:])
        up, down = T.powers(n + 1)
        sums = np.empty(n + 1, T.U64)
        sums[0] = 0
        np.cumsum(values[data[lo:hi]] * up[:n], out=sums[1:])
        sums *= T.U64(pow(_BASE, lo, 1 << 64))
        sums += carry
        carry = sums[-1]
        at = np.flatnonzero(here)
        starts.append(at + lo)
        from_sums.append(sums[at])
        scales.append(down[at] * T.U64(pow(_INVERSE, lo, 1 << 64)))
        to_sums.append(sums[np.flatnonzero(ends_here) + 1])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, T.U64), np.zeros(len(piece) + 1, np.int64)
    hashes = np.concatenate(to_sums)
    hashes -= np.concatenate(from_sums)
    hashes *= np.concatenate(scales)
    places = np.concatenate(starts)
    return places, T.mix(hashes), np.searchsorted(places, piece.ends)


def count_bytes(piece: T.Piece, which: np.ndarray, step: int = STRETCH_BYTES) -> np.ndarray:
    """Per text, the bytes for which ``which`` holds."""
    out = np.zeros(len(piece), np.int64)
    for lo in range(0, len(piece.bytes), step):
        hi = min(len(piece.bytes), lo + step)
        total = np.concatenate([[0], np.cumsum(which[piece.bytes[lo:hi]])])
        ends = np.clip(piece.ends, lo, hi) - lo
        out += total[ends[1:]] - total[ends[:-1]]
    return out
