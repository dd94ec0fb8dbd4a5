"""Removal of repeated word passages with prefix-partitioned suffix trees.

Sampled suffixes (see ``_repeats``) are split into groups by a prefix of eight words; a prefix that too many suffixes
share is lengthened to the whole window, so that every group fits into memory. A group's suffixes, sorted by their
words, with the numbers of words that neighbours share, are its suffix tree: a node of depth n is a run of neighbours
that share n words or more. A node at least as deep as the rest of a window, met by a node of the left sides, is a
repeated window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _repeats as R
from . import _text as T
from .registry import query, table

WORDS = 35
PREFIX = 8
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _matrices(values: list[bytes], width: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of equally wide rows, filled up with zeros, and the rows' own numbers of words."""
    out, lengths = np.zeros((len(values), width), np.uint64), []
    for piece in T.pieces(pa.array(values, pa.binary())):
        found = T.words(piece)
        hashes = T.segment_hashes(piece.bytes, found.starts, found.stops)
        n = np.diff(found.ends)
        columns = T.ranges(np.zeros(len(n), np.int64), n)
        if backwards:
            columns = np.repeat(n, n) - 1 - columns
        out[piece.first + np.repeat(np.arange(len(n)), n), columns] = hashes
        lengths.append(n)
    return out, np.concatenate([np.zeros(0, np.int64), *lengths])


def remove_passages(docs: DataFrame, words: int = WORDS, prefix: int = PREFIX, texts: bool = False,
                    bucket_bytes: int = R.BUCKET_BYTES, hot: int = R.HOT) -> DataFrame:
    """Remove each word covered by a window of ``words`` words whose words also start anywhere else, in the same
    document or another. One row per row of ``docs`` (doc_id, text); with ``texts`` also the remaining words with a
    space between (``kept``) and the removed ranges of words (``starts``, ``stops``).

    Words are runs of anything but ASCII white space, unchanged. Windows never reach across documents and are judged on
    the input. Null and empty texts have no words; repeated rows remove each other's windows.
    """
    unit = R.Unit("space", words, prefix, earlier=False)

    def finish(piece: T.Piece, doc_ids: pa.Array, spans: list) -> pa.Table:
        found, data, rows = T.words(piece), piece.bytes.tobytes(), []
        for i, (starts, stops) in enumerate(spans):
            lo, hi = int(found.ends[i]), int(found.ends[i + 1])
            stay = np.ones(hi - lo, bool)
            for a, b in zip(starts.tolist(), stops.tolist()):
                stay[a:b] = False
            at = lo + np.flatnonzero(stay)
            kept = b" ".join([data[a:b] for a, b in zip(found.starts[at].tolist(), found.stops[at].tolist())])
            rows.append((hi - lo, hi - lo - len(at), hashlib.sha256(kept).hexdigest(), kept.decode(), starts.tolist(),
                         stops.tolist()))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["n_words", "n_removed", "kept_sha256", "kept", "starts", "stops"]
        columns = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
        out = pa.table([doc_ids.cast(pa.int64()), *columns], names=["doc_id", *names])
        return out if texts else out.select(range(4))

    schema = SCHEMA + (", kept string, starts array<long>, stops array<long>" if texts else "")
    return R.remove(docs, unit, _matrices, finish, schema, bucket_bytes, hot)


@query(sql=r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
hit AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM hit),
word AS (SELECT doc_id, w[p] AS x, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op8_prefix_tree_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_passages(table(spark, folder, "documents"))
