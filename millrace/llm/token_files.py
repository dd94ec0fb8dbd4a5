"""Token ids in seekable files.

A file is a series of independent zstandard frames of little-endian 32-bit ids, each with its own content checksum,
then a skippable frame with the documents' ids and lengths, then the seek table of the public "seekable format": per
frame its compressed size, its decompressed size and the low half of the XXH64 of its content. A reader fetches the
two tables from the file's end and decompresses only the frames that hold the documents asked for. Any zstandard tool
can unpack the whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..session import scratch_path
from . import _bpe
from . import _text as T
from ._files import Replacing, open_file
from .registry import query, table

END_ID = 2
FRAME_IDS = 1 << 18
# Bytes of text meant for one file.
FILE_BYTES = 32 << 20
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# Skippable frame of the documents' table.
DOCUMENTS = 0x184D2A50

MANIFEST = "part int, file string, n_docs long, n_tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Writer:
    """Writes runs of ids and the documents they belong to."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.frame_ids = out, frame_ids
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.waiting, self.n_waiting = [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.names: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, names: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.names.append(names)
        self.nulls.append(nulls)
        self.sizes.append(sizes)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.frame_ids:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.frame_ids * self.frame_ids
            for at in range(0, whole, self.frame_ids):
                self._frame(ids[at:at + self.frame_ids])
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _frame(self, ids: np.ndarray) -> None:
        content = ids.astype("<u4").tobytes()
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        """Write the tables; (documents, ids)."""
        if self.n_waiting:
            self._frame(np.concatenate(self.waiting))
        names = np.concatenate([np.zeros(0, "<i8"), *self.names]).astype("<i8")
        nulls = np.concatenate([np.zeros(0, np.uint8), *self.nulls]).astype(np.uint8)
        sizes = np.concatenate([np.zeros(0, "<i8"), *self.sizes]).astype("<i8")
        body = zstandard.ZstdCompressor(write_checksum=True).compress(
            struct.pack("<q", len(names)) + names.tobytes() + sizes.tobytes() + nulls.tobytes())
        self.out.write(struct.pack("<II", DOCUMENTS, len(body)) + body)
        entries = [*self.frames, (8 + len(body), 0, 0)]
        seek = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), CHECKSUM_FLAG, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(seek)) + seek)
        return len(names), int(sizes.sum())


class Reader:
    """Reads documents of one file by their place in it."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        source.seek(size - 9 - 12 * count)
        table_ = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3)
        self.places = np.concatenate([[0], np.cumsum(table_[:, 0], dtype=np.int64)])
        self.table = table_[:-1]
        self.ends = np.concatenate([[0], np.cumsum(table_[:-1, 1], dtype=np.int64)]) // 4
        source.seek(int(self.places[-2]) + 8)
        body = zstandard.ZstdDecompressor().decompress(source.read(int(table_[-1, 0]) - 8))
        n = struct.unpack_from("<q", body)[0]
        self.doc_ids = np.frombuffer(body, "<i8", n, 8)
        self.sizes = np.frombuffer(body, "<i8", n, 8 + 8 * n)
        self.nulls = np.frombuffer(body, np.uint8, n, 8 + 16 * n).astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self._last = (-1, np.zeros(0, "<u4"))

    def frame(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            self.source.seek(int(self.places[k]))
            content = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.table[k, 0])))
            if len(content) != self.table[k, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self._last = (k, np.frombuffer(content, "<u4"))
        return self._last[1]

    def parts(self, i: int) -> Iterator[np.ndarray]:
        """The ids of document ``i`` of the file, frame by frame."""
        lo, hi = int(self.starts[i]), int(self.starts[i + 1])
        k = int(np.searchsorted(self.ends, lo, "right")) - 1
        while lo < hi:
            first = int(self.ends[k])
            yield self.frame(k)[lo - first:hi - first]
            k += 1
            lo = int(self.ends[k])

    def document(self, i: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *self.parts(i)])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                 file_bytes: int = FILE_BYTES, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode (doc_id, text) into files below ``folder``, in ascending doc_id order; the manifest, one row per file.

    Null doc_ids come first; rows of one doc_id are in order of their texts. Null and empty texts are the end id only.
    Runs at once. A file appears under its name when it is whole, so a task that is run again replaces it.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or _bpe.default_path()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // file_bytes))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.ids.zst"
        encoder = _bpe.shared(tokenizer)
        with Replacing(path) as out:
            writer = Writer(out, frame_ids)
            while batch is not None:
                names = batch.column(0)
                nulls = np.asarray(names.is_null().to_numpy(zero_copy_only=False), np.uint8)
                names = names.fill_null(0).to_numpy(zero_copy_only=False)
                for piece in T.pieces(batch.column(1)):
                    ids, sizes = encoder.encode(piece)
                    rows = slice(piece.first, piece.first + len(piece))
                    # One place more per document, for the end id.
                    ends = np.cumsum(sizes + 1)
                    full = np.full(len(ids) + len(piece), end_id, np.uint32)
                    inside = np.ones(len(full), bool)
                    inside[ends - 1] = False
                    full[inside] = ids
                    writer.add(names[rows], nulls[rows], sizes + 1, full)
                batch = next(batches, None)
            n_docs, n_tokens = writer.close()
        T.release()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([path]), pa.array([n_docs]), pa.array([n_tokens])],
            ["part", "file", "n_docs", "n_tokens"])

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(part, file, n_docs, n_tokens, start) of each file; ``start`` counts the ids of the files before."""
    before = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
            .withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))))


def read_documents(files: DataFrame, ids: bool = False) -> DataFrame:
    """Read the files of a manifest: doc_id, start, n_tokens, ids_crc32 per document, with ``ids`` also the ids.

    Frames are checked against their checksums.
    """
    schema = DOCUMENT + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(path) as source:
                    reader = Reader(source)
                    n = len(reader.sizes)
                    for lo in range(0, n, 10_000):
                        rows = range(lo, min(n, lo + 10_000))
                        sums, lists = [], []
                        for i in rows:
                            crc, parts = 0, []
                            for part in reader.parts(i):
                                crc = zlib.crc32(part.tobytes(), crc)
                                parts.append(part)
                            sums.append(crc)
                            if ids:
                                lists.append(np.concatenate([np.zeros(0, "<u4"), *parts]).astype(np.int64))
                        part = slice(lo, lo + len(rows))
                        columns = [pa.array(reader.doc_ids[part], mask=reader.nulls[part]),
                                   pa.array(reader.starts[:-1][part] + start), pa.array(reader.sizes[part]),
                                   pa.array(sums, pa.int64())]
                        if ids:
                            columns.append(pa.array(lists, pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    placed = files.select("file", "start")
    return placed.repartition(max(1, files.count())).mapInArrow(run, schema)


def fetch(files: DataFrame, wanted: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: only the frames that hold them are decompressed."""
    asked = np.array(sorted(set(wanted)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_file(path) as source:
                    reader = Reader(source)
                    rows = np.flatnonzero(np.isin(reader.doc_ids, asked) & ~reader.nulls)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids[rows]),
                         pa.array([reader.document(int(i)).astype(np.int64) for i in rows], pa.list_(pa.int64()))],
                        ["doc_id", "ids"])

    return files.select("file").mapInArrow(run, "doc_id long, ids array<long>")


def encode_documents(docs: DataFrame, **options) -> DataFrame:
    """Write the documents' ids below the shared folder and return what the files hold."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_tokens(docs, folder, **options))


@query()
def op9_seekable_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"))
