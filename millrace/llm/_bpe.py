"""Token ids of texts through the tokenizers library, each distinct stretch of text encoded once.

The tokenizer splits text by a pattern before it merges, and a merge never crosses a split. Texts are therefore cut at
places where the pattern always splits (see ``cuts``), the stretches are hashed and looked up in numpy, and only those
not met before are handed to the library. The ids of a text are those of its stretches, one after the other. Strings of added
tokens become those tokens, as in the plain call of the library; no stretch begins inside one.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from . import _text as T

# Distinct stretches kept per worker, and ids for each on average; beyond either, stretches met in one piece only go.
STORE, STORE_IDS = 1_000_000, 8
# Stretches handed to the library as one text.
JOINED = 256


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _classes() -> bytes:
    """Per byte the sum of the classes that it is in."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] |= PRINT | BEGIN
    kinds[0xC3:0xE0] |= BEGIN
    kinds[0x41:0x5B] |= LETTER
    kinds[0x61:0x7B] |= LETTER
    kinds[[0x2C, 0x2E]] |= STOP
    kinds[0x20] |= SPACE
    kinds[0x0A] |= FEED
    return kinds.tobytes()


# BEGIN: bytes that begin a character that is no white space: printable ASCII and two-byte characters from U+00C0 on.
PRINT, BEGIN, LETTER, STOP, SPACE, FEED = (np.uint8(1 << k) for k in range(6))
_CLASSES = _classes()


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where stretches begin. The pattern ends a part there whatever stands around:

    before a space after a printable ASCII character, or before one that a character other than white space follows;
    before a line feed after a printable ASCII character, and behind such a line feed if no white space follows;
    before a comma or full stop after an ASCII letter; and at the start of each text.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    # One look-up of all classes.
    kinds = np.frombuffer(data.tobytes().translate(_CLASSES), np.uint8)
    printed, space, feed, begins = (kinds & kind != 0 for kind in (PRINT, SPACE, FEED, BEGIN))
    cut[1:n] = (space | feed)[1:] & printed[:-1]
    cut[:n - 1] |= space[:-1] & begins[1:]
    cut[2:n] |= printed[:-2] & feed[1:-1] & begins[2:]
    cut[1:n] |= (kinds & STOP != 0)[1:] & (kinds & LETTER != 0)[:-1]
    cut[ends[:-1]] = True
    return np.flatnonzero(cut[:n])


def separator(added: list[bytes]) -> bytes | None:
    """An added token whose string the library finds between any two texts that do not hold it: it can overlap neither
    itself nor another one."""
    for mark in added:
        heads, tails = [mark[:k] for k in range(1, len(mark))], tuple(mark[k:] for k in range(1, len(mark)))
        others = [t for t in added if t != mark]
        if mark and not any(mark.endswith(h) for h in heads) and not any(
                mark in t or t in mark or t.startswith(tails) or any(t.endswith(h) for h in heads) for t in others):
            return mark
    return None


def lengths(tokenizer) -> np.ndarray:
    """Bytes that each id stands for: a byte-level token has one character per byte, an added one is its string."""
    sizes = {i: len(token) for token, i in tokenizer.get_vocab(with_added_tokens=False).items()}
    sizes |= {i: len(t.content.encode()) for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = np.zeros(max(sizes) + 1, np.int64)
    out[list(sizes)] = list(sizes.values())
    return out


class Store:
    """Runs of ids under 64-bit keys other than 0: an open hash table, asked for many keys in a few passes over arrays."""

    def __init__(self, places: int = 1 << 16):
        self._clear(places)
        self.ids, self.n_ids = np.zeros(places, np.uint32), 0

    def _clear(self, places: int) -> None:
        self.keys = np.zeros(places, T.U64)  # 0: free
        self.starts, self.sizes = np.zeros(places, np.int64), np.zeros(places, np.int32)
        self.again = np.zeros(places, bool)
        self.count = 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, or the free one where it would go; whether it is there)."""
        last = len(self.keys) - 1
        at = (keys & T.U64(last)).astype(np.int64)
        held = self.keys[at]
        known = held == keys
        on = np.flatnonzero(~known & (held != 0))
        while len(on):
            at[on] = (at[on] + 1) & last
            held = self.keys[at[on]]
            known[on] = held == keys[on]
            on = on[~known[on] & (held != 0)]
        return at, known

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Add distinct keys that are not there, with their runs one after the other."""
        places = 2 * (self.count + len(keys))
        if places > len(self.keys):
            held = np.flatnonzero(self.keys)
            rows = self.keys[held], self.starts[held], self.sizes[held], self.again[held]
            self._clear(1 << (places - 1).bit_length())
            self._place(*rows)
        if self.n_ids + len(ids) > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.n_ids + len(ids)), np.uint32)
            grown[:self.n_ids] = self.ids[:self.n_ids]
            self.ids = grown
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self._place(keys, self.n_ids + np.cumsum(sizes) - sizes, sizes, np.zeros(len(keys), bool))
        self.n_ids += len(ids)

    def _place(self, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, again: np.ndarray) -> None:
        self.count += len(keys)
        on = np.arange(len(keys))
        while len(on):  # of keys that meet at a free place one gets it
            at, _ = self.find(keys[on])
            self.keys[at] = keys[on]
            got = self.keys[at] == keys[on]
            at, won, on = at[got], on[got], on[~got]
            self.starts[at], self.sizes[at], self.again[at] = starts[won], sizes[won], again[won]

    def runs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs at these places, one after the other; their sizes)."""
        sizes = self.sizes[at].astype(np.int64)
        return self.ids[T.ranges(self.starts[at], sizes)], sizes

    def met_again(self, most: int, most_ids: int) -> Store:
        """A store of the runs that were met again since they came; an empty one if they are more than that."""
        kept, held = Store(), np.flatnonzero(self.again)
        if len(held) <= most and self.sizes[held].sum(dtype=np.int64) <= most_ids:
            ids, sizes = self.runs(held)
            kept.add(self.keys[held], sizes, ids)
        return kept


class Encoder:
    """Ids of pieces. Stretches are told apart by length and a 64-bit hash."""

    def __init__(self, path: str, store: int = STORE):
        self.tokenizer, self.limit = load(path), store
        if '"ByteLevel"' not in str(self.tokenizer.pre_tokenizer) and "ByteLevel" not in str(self.tokenizer.pre_tokenizer):
            raise ValueError("a byte-level tokenizer is needed")
        if self.tokenizer.normalizer is not None:
            raise ValueError("a tokenizer without a normalizer is needed")
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("a tokenizer whose added tokens stand for their strings alone is needed")
        self.added = [t.content.encode() for t in added]
        self.mark = separator(self.added) if self.tokenizer.truncation is None and self.tokenizer.padding is None else None
        self.lengths = lengths(self.tokenizer)
        self.known = Store()

    def _starts(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The places of ``cuts`` but those inside the string of an added token or one byte before it: text ends at such
        a string, so a space before it stays with other white space on its left."""
        starts = cuts(data, ends)
        buffer = data.tobytes()
        apart = np.zeros(0, bool)
        for token in self.added:
            at = buffer.find(token)
            while at >= 0:
                if not len(apart):
                    apart = np.zeros(len(buffer), bool)
                apart[max(at - 1, 0):at + len(token)] = True
                at = buffer.find(token, at + 1)
        if len(apart):
            first = ends[:-1]
            apart[first[first < len(buffer)]] = False  # texts stay apart
            starts = starts[~apart[starts]]
        return starts

    def _library(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text), as the library gives for each text alone.

        ``JOINED`` of them are one call's text. Two stand side by side where a stretch begins between them by their own
        bytes; elsewhere an added token keeps them apart. The bytes that ids stand for tell which text they belong to.
        """
        if self.mark is None or self.mark in b"\0".join(texts):
            return self._each(texts)
        whole = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        begins = np.zeros(len(whole), bool)
        begins[self._starts(whole, np.array([0, len(whole)]))] = True
        # ``cuts`` looks two bytes back and one ahead.
        apart = ~begins[ends[:-1]] | (sizes[:-1] < 2) | (sizes[1:] < 2)
        apart[JOINED - 1::JOINED] = False  # another call
        apart = np.append(apart, False)
        parts = [text + self.mark if mark else text for text, mark in zip(texts, apart.tolist())]
        joined = [b"".join(parts[i:i + JOINED]).decode() for i in range(0, len(parts), JOINED)]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        reached = np.cumsum(self.lengths[ids])
        marks = np.cumsum(apart) * len(self.mark)  # with the one behind the text
        wanted = np.stack([ends + marks - apart * len(self.mark), ends + marks], axis=1).ravel()
        places = np.searchsorted(reached, wanted)
        if not len(ids) or reached[-1] != wanted[-1] or (reached[places] != wanted).any():
            return self._each(texts)  # ids across texts, or that do not stand for their bytes
        inside = np.ones(len(ids), bool)
        inside[places[1::2][apart]] = False
        return ids[inside], np.diff(np.cumsum(inside)[places[::2]], prepend=0)

    def _each(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        lists = [np.array(e.ids, np.uint32) for e in found]
        return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))

    def encode(self, piece: T.Piece) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text)."""
        starts = self._starts(piece.bytes, piece.ends)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(piece), np.int64)
        stops = np.append(starts[1:], len(piece.bytes))
        keys = T.segment_hashes(piece.bytes, starts, stops)
        keys = T.mix(keys + (stops - starts).astype(T.U64))
        keys[keys == 0] = 1  # the store's free places
        at, known = self.known.find(keys)
        self.known.again[at[known]] = True
        if not known.all():
            first = np.unique(keys[~known], return_index=True)[1]
            if self.known.count + len(first) > self.limit or self.known.n_ids > STORE_IDS * self.limit:
                self.known = self.known.met_again(self.limit // 2, STORE_IDS * self.limit // 2)
                known = self.known.find(keys)[1]
                first = np.unique(keys[~known], return_index=True)[1]
            first = np.sort(np.flatnonzero(~known)[first])  # in the order of the texts
            buffer = piece.bytes.tobytes()
            texts = [buffer[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())]
            ids, sizes = self._library(texts)
            self.known.add(keys[first], sizes, ids)
            at, _ = self.known.find(keys)
        ids, sizes = self.known.runs(at)
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.searchsorted(starts, piece.ends)])


@lru_cache(maxsize=1)
def shared(path: str) -> Encoder:
    """The encoder of this worker: the tasks that it runs one after the other load the tokenizer once and share the
    stretches that are known. What it holds is bounded by ``STORE``."""
    return Encoder(path)
