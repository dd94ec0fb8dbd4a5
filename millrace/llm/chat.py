"""Chat formatting by columnar assembly.

A batch of turns, in order of conversations, becomes one byte buffer: the lengths of all headers, escaped texts and
footers are computed first, their running sums say where each goes, and every text and header is scattered there in one
numpy step. Conversations are slices of the buffer. A conversation longer than a batch comes in several pieces, so no
task ever holds one whole.

The template of a turn is ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash goes before
every ``\\``, ``#`` and ``<`` (in roles also ``:`` and line feeds), so the marks occur nowhere else and reading back
gives the very text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from .registry import query, table

OPEN, MIDDLE, CLOSE = b"### ", b": ", b"</turn>\n"
LEARNED = "assistant"
FORMATTED = ("conv_id long, piece long, formatted string, n_turns long, loss_starts array<int>, loss_stops array<int>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

_IN_TEXT = np.zeros(256, bool)
_IN_TEXT[[0x5C, 0x23, 0x3C]] = True
_IN_ROLE = _IN_TEXT.copy()
_IN_ROLE[[0x3A, 0x0A]] = True
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)
_ESCAPED = re.compile(rb"\\(.)", re.S)


def escape(data: np.ndarray, ends: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a backslash before every marked one, and the new offsets of the texts."""
    marked = marks[data]
    shift = np.cumsum(marked)
    out = np.full(len(data) + int(marked.sum()), 0x5C, np.uint8)
    out[np.arange(len(data)) + shift] = data
    return out, ends + np.concatenate([[0], shift])[ends]


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    found = list(T.pieces(column, 1 << 62))
    return (found[0].bytes, found[0].ends) if found else (np.zeros(0, np.uint8), np.zeros(1, np.int64))


def assemble(roles, texts, learned: str = LEARNED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, offsets of the turns, loss mask by turn, starts and stops of the texts) of formatted turns."""
    role, role_ends = escape(*_bytes(roles), _IN_ROLE)
    text, text_ends = escape(*_bytes(texts), _IN_TEXT)
    n = len(role_ends) - 1
    fixed = [np.frombuffer(part, np.uint8) for part in (OPEN, MIDDLE, CLOSE)]
    sizes = np.stack([np.full(n, len(fixed[0])), np.diff(role_ends), np.full(n, len(fixed[1])), np.diff(text_ends),
                      np.full(n, len(fixed[2]))], axis=1)
    places = np.concatenate([[0], np.cumsum(sizes.ravel())])
    out = np.empty(int(places[-1]), np.uint8)
    starts = places[:-1].reshape(n, 5)
    for column, part in zip((0, 2, 4), fixed):
        out[starts[:, column, None] + np.arange(len(part))] = part
    out[T.ranges(starts[:, 1], sizes[:, 1])] = role
    out[T.ranges(starts[:, 3], sizes[:, 3])] = text
    loss = np.array([r == learned for r in roles.to_pylist()], bool)
    return out, np.append(starts[:, 0], places[-1]), loss, starts[:, 3], starts[:, 3] + sizes[:, 3]


def format_conversations(turns: DataFrame, learned: str = LEARNED, batch_bytes: int = T.PIECE_BYTES) -> DataFrame:
    """Formatted conversations from (conv_id, turn, role, text): rows of FORMATTED in order of conv_id and piece.

    Nearly all conversations are one piece; ``loss_starts`` and ``loss_stops`` are the places (in code points of the
    piece) of the escaped texts of the learned role. Turns are in order of ``turn`` (null first), then role and text,
    so repeated and tied rows have a defined place. Null roles and texts are empty; a null conv_id is a conversation.
    The result is partitioned and sorted by conversation.
    """
    ordered = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"), "turn")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = (), 0
        for batch in batches:
            lo = 0
            sizes = np.cumsum([0] + (np.diff(_bytes(batch.column(2))[1]) + np.diff(_bytes(batch.column(1))[1])).tolist())
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + batch_bytes, "right")) - 1)
                part = batch.slice(lo, hi - lo)
                lo = hi
                buffer, places, loss, starts, stops = assemble(part.column(1), part.column(2), learned)
                convs = part.column(0).to_pylist()
                first = [0] + [i for i in range(1, len(convs)) if convs[i] != convs[i - 1]]
                edges = np.append(first, len(convs))
                cuts = places[edges]
                formatted = pa.LargeStringArray.from_buffers(
                    len(first), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(buffer)).cast(pa.string())
                # Code points before each byte: bytes that do not continue a character.
                chars = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
                base = chars[cuts[:-1]]
                which = np.repeat(np.arange(len(first)), np.diff(edges))
                rows = np.flatnonzero(loss)
                counts = np.searchsorted(which[rows], np.arange(len(first) + 1)).astype(np.int32)
                spans = [pa.ListArray.from_arrays(pa.array(counts),
                                                  pa.array((chars[x[rows]] - base[which[rows]]).astype(np.int32)))
                         for x in (starts, stops)]
                numbers = []
                for i in first:
                    piece = piece + 1 if (convs[i],) == last else 0
                    last = (convs[i],)
                    numbers.append(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([convs[i] for i in first], pa.int64()), pa.array(numbers, pa.int64()), formatted,
                     pa.array(np.diff(edges)), *spans], [c.split()[0] for c in FORMATTED.split(", ")])

    return ordered.mapInArrow(run, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted piece."""
    data, at, out = formatted.encode(), 0, []
    while at < len(data):
        found = _TURN.match(data, at)
        if not found:
            raise ValueError(f"no turn begins at byte {at}")
        out.append(tuple(_ESCAPED.sub(rb"\1", part).decode() for part in found.groups()))
        at = found.end()
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: rows of DIGEST. Pieces of a conversation are digested one after the other."""
    ordered = (formatted.select("conv_id", "piece", "formatted", "loss_starts", "loss_stops")
               .repartition("conv_id").sortWithinPartitions("conv_id", "piece"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def finished():
            conv, n, turns, chars, loss, size = now
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            for conv, _, text, starts, stops in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(finished())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, stops):
                    said = _ESCAPED.sub(rb"\1", text[a:b].encode())
                    now[3] += len(said.decode())
                    now[4].update(said)
                now[5] += len(text)
            if len(done) >= 4096:
                yield _digest_batch(done)
                done = []
        if now is not None:
            done.append(finished())
        if done:
            yield _digest_batch(done)

    return ordered.mapInArrow(run, DIGEST)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                      [c.split()[0] for c in DIGEST.split(", ")])


@query(sql=r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(regexp_replace(role, '([\\#<:\n])', '\\\1', 'g')) + 2 + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""")
def op5_columnar_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return digests(format_conversations(turns))
