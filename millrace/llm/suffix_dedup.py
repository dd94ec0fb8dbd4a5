"""Removal of repeated byte strings with a sorted suffix array.

Sampled suffixes (see ``_repeats``) of all documents are range-partitioned by their leading bytes at splitters that
Spark samples, sorted in each partition by a multikey sort of 8-byte words, and compared with their neighbours. All
suffixes with one beginning are in one partition, so no pair is lost at a boundary; a beginning that would be too much
for one task is compared across partitions by digests of its windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _repeats as R
from . import _text as T
from .registry import query, table

LENGTH = 100
GRAM = 32
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _matrices(values: list[bytes], width: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of equally wide rows, filled up with zeros, and the rows' own lengths."""
    lengths = np.array([len(v) for v in values], np.int64)
    out = np.zeros((len(values), width), np.uint8)
    data = np.frombuffer(b"".join(values), np.uint8)
    columns = T.ranges(np.zeros(len(values), np.int64), lengths)
    rows = np.repeat(np.arange(len(values)), lengths)
    if backwards:
        columns = np.repeat(lengths, lengths) - 1 - columns
    out[rows, columns] = data
    return out, lengths


def _order(group: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Multikey sort of byte rows, eight bytes at a time."""
    width = -(-max(1, rows.shape[1]) // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, :rows.shape[1]] = rows
    return R.multikey_order(group, padded.view(">u8").astype(np.uint64))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False,
                   bucket_bytes: int = R.BUCKET_BYTES, hot: int = R.HOT) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts earlier: in a row of smaller doc_id,
    or in the same document before. One row per row of ``docs`` (doc_id, text); with ``texts`` also the remaining
    bytes (``kept``) and the removed ranges (``starts``, ``stops``).

    Strings never reach across documents and are judged on the input. Overlapping occurrences count. Null and empty
    texts have no bytes. A null doc_id comes before all others; rows of one doc_id are in order of a hash of their
    texts, and of rows that agree in both all but one are later.
    """
    unit = R.Unit("byte", length, gram, earlier=True)

    def finish(piece: T.Piece, doc_ids: pa.Array, spans: list) -> pa.Table:
        data, rows = piece.bytes.tobytes(), []
        for i, (starts, stops) in enumerate(spans):
            lo, hi = int(piece.ends[i]), int(piece.ends[i + 1])
            edges = [lo, *(lo + np.stack([starts, stops], axis=1)).ravel().tolist(), hi]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((hi - lo, hi - lo - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept,
                         starts.tolist(), stops.tolist()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "starts", "stops"]
        columns = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
        found = pa.table([doc_ids.cast(pa.int64()), *columns], names=["doc_id", *names])
        return found if texts else found.select(range(5))

    schema = SCHEMA + (", kept binary, starts array<long>, stops array<long>" if texts else "")
    return R.remove(docs, unit, _matrices, finish, schema, bucket_bytes, hot, _order)


@query(sql=r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
        FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
seen AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, i) AS r FROM win),
hit AS (SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS gap FROM seen WHERE r > 1),
runs AS (SELECT doc_id, i, sum((gap > 100)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans),
kept AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k
         FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
