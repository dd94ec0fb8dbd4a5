"""Small documents with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size long, cls string, n string"
_AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lower(text: str) -> str:
    return text.translate(_AZ)


def prose(rng: random.Random, n: int) -> list[str]:
    return [rng.choice("abcdefghijklmnop") + rng.choice(["on", "ea", "st", "é", "ü"]) + str(rng.randrange(60))
            for _ in range(n)]


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows of DOCUMENTS: nulls, empty and white texts, ties, repeated rows, copies, shared passages, one long text."""
    rng = random.Random(seed)
    base, shared = prose(rng, 120), prose(rng, 60)
    texts: list[str | None] = [None, "", " \t\n", "One", "one", "a b c d", "A b\nc d", "x " * 50, "ab" * 300]
    for i in range(n):
        words = prose(rng, rng.randrange(1, 150))
        if i % 4 == 0:
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = "edit" + str(rng.randrange(999))
        if i % 5 == 0:
            words[len(words) // 2:len(words) // 2] = shared
        texts.append((" " if i % 3 else "\n").join(words))
    texts += [" ".join(base)] * 6 + [" ".join(prose(rng, 4000) + shared + shared)]
    rows = [(i, t, "en", None if i % 7 == 0 else f"src{i % 4}", None if t is None else len(t), i, "x", "y")
            for i, t in enumerate(texts)]
    # A repeated row, one doc_id with two texts, and rows without an id.
    rows += [rows[-1], (3, "another text for three", None, "src1", 5, 0, None, None),
             (None, texts[20], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


def unique(rows: list[tuple]) -> list[tuple]:
    """The rows whose doc_id is there once."""
    ids = [r[0] for r in rows]
    return [r for r in rows if r[0] is not None and ids.count(r[0]) == 1]


def same(got, want) -> None:
    order = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)
