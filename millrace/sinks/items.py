"""Keyed puts: to any key-value table by a callback, or to a stored table of items with commits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.windows import last_write

BUCKET = "__bucket"


def put_items(df: DataFrame, put_batch: Callable[[list[dict]], None], keys: Sequence[str],
              order: Sequence[str | Column] | None = None, batch_rows: int = 25) -> None:
    """Send every item to ``put_batch`` in small lists, from the tasks.

    With ``order`` the last write of each key wins before anything is sent. A put replaces the
    item of its key, so a task that runs again leaves the same table. A job that fails leaves part of the items:
    ``put`` commits all or none.
    """
    items = last_write(df, keys, order) if order else df

    def send(batches: Iterator) -> Iterator:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                put_batch(batch.slice(start, batch_rows).to_pylist())
            yield batch.slice(0, 0)

    items.mapInArrow(send, items.schema).write.format("noop").mode("overwrite").save()


# An item table is a folder with ``table.json`` (schema, keys, number of buckets), ``data`` (parquet files that are
# named <job>-<bucket>-<unique>) and ``commits`` (one JSON file per committed job: the files it added and the commits
# it stands in for). Only what a commit names is part of the table.


def _place(path: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes local URIs with one slash.
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file://{path}")


def _put_text(folder: str, name: str, text: str) -> None:
    system, at = _place(folder)
    system.create_dir(at, recursive=True)
    part = f"{at}/.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(text.encode())
    system.move(part, f"{at}/{name}")


def _texts(folder: str) -> dict[str, dict]:
    """The JSON files of a folder by name, in order."""
    system, at = _place(folder)
    found = {}
    for info in sorted(system.get_file_info(fs.FileSelector(at, allow_not_found=True)), key=lambda i: i.path):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with system.open_input_stream(info.path) as source:
                found[info.base_name] = json.loads(source.read())
    return found


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: (file name, bucket, items)."""

    files: list[tuple[str, int, int]] = field(default_factory=list)


class ItemWriter(DataSourceArrowWriter):
    """Tasks stage files under names of their own; the driver commits those that the successful attempts name.

    A task that runs twice stages twice, and only one of its messages reaches the commit. A job that fails commits
    nothing: ``abort`` removes what it staged, and what a lost executor may have left is in no commit.
    """

    def __init__(self, path: str, replaces: list[str]):
        self.path, self.replaces, self.job = path.rstrip("/"), replaces, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, at = _place(f"{self.path}/data")
        system.create_dir(at, recursive=True)
        message, bucket, name, rows, out = Staged(), None, "", 0, None
        try:
            for batch in iterator:
                numbers = batch.column(batch.schema.get_field_index(BUCKET)).to_numpy()
                items = batch.drop_columns([BUCKET])
                start = 0
                while start < len(numbers):
                    # Rows come sorted by bucket: one open file at a time.
                    stop = start + int((numbers[start:] != numbers[start]).argmax() or len(numbers) - start)
                    if numbers[start] != bucket:
                        if out is not None:
                            out.close()
                            message.files.append((name, int(bucket), rows))
                        bucket, rows = numbers[start], 0
                        name = f"{self.job}-{int(bucket):05d}-{uuid.uuid4().hex}.parquet"
                        out = pq.ParquetWriter(f"{at}/{name}", items.schema, filesystem=system)
                    out.write_batch(items.slice(start, stop - start))
                    rows += stop - start
                    start = stop
        finally:
            if out is not None:
                out.close()
        if out is not None:
            message.files.append((name, int(bucket), rows))
        return message

    def commit(self, messages: list[Staged | None]) -> None:
        files = sorted(f for m in messages if m is not None for f in m.files)
        last = max([int(n.split("-")[0]) for n in _texts(f"{self.path}/commits")], default=0)
        _put_text(f"{self.path}/commits", f"{last + 1:012d}-{self.job}.json",
                  json.dumps({"files": files, "replaces": self.replaces}))

    def abort(self, messages: list[Staged | None]) -> None:
        system, at = _place(f"{self.path}/data")
        for info in system.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if info.base_name.startswith(self.job):
                system.delete_file(info.path)


class ItemSource(DataSource):
    """``df.write.format("millrace_items")``; ``put`` prepares the rows for it."""

    @classmethod
    def name(cls) -> str:
        return "millrace_items"

    def writer(self, schema: T.StructType, overwrite: bool) -> ItemWriter:
        return ItemWriter(self.options["path"], json.loads(self.options.get("replaces", "[]")))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _table(path: str) -> dict:
    found = _texts(path).get("table.json")
    if found is None:
        raise FileNotFoundError(f"{path} is no item table")
    return found


def create_items(path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64) -> None:
    """An empty item table with one item per ``keys``, in ``buckets`` by a hash of them."""
    if "table.json" in _texts(path):
        raise FileExistsError(f"{path} is an item table")
    _put_text(path, "table.json", json.dumps({"schema": schema.jsonValue(), "keys": list(keys), "buckets": buckets}))


def _write(df: DataFrame, path: str, table: dict, replaces: Sequence[str] = ()) -> None:
    df.sparkSession.dataSource.register(ItemSource)
    names = T.StructType.fromJson(table["schema"]).fieldNames()
    (df.select(*names, _bucket(table["keys"], table["buckets"]).alias(BUCKET))
       .repartition(table["buckets"], BUCKET).sortWithinPartitions(BUCKET)
       .write.format("millrace_items").mode("append").option("path", path)
       .option("replaces", json.dumps(list(replaces))).save())


def put(df: DataFrame, path: str, order: Sequence[str | Column] | None = None) -> None:
    """Put items into an item table as one commit: each replaces the item of its key, and all of them or none count.

    ``order`` tells which of several rows with one key is the last; without it a key must be there once. A null is a
    key like any other.
    """
    table = _table(path)
    items = last_write(df, table["keys"], order) if order else df
    _write(items, path, table)


def commits(path: str) -> list[str]:
    """Names of the commits that count, oldest first."""
    found = _texts(f"{path.rstrip('/')}/commits")
    gone = {name for c in found.values() for name in c["replaces"]}
    return [name for name in found if name not in gone]


def _read(spark: SparkSession, path: str, buckets: set[int] | None = None) -> DataFrame:
    path, table = path.rstrip("/"), _table(path)
    schema = T.StructType.fromJson(table["schema"])
    logs, live = _texts(f"{path}/commits"), commits(path)
    files = [f"{path}/data/{name}" for c in live for name, bucket, _ in logs[c]["files"]
             if buckets is None or bucket in buckets]
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    if len(live) == 1:
        return rows
    # A row per live commit: which one comes later is told by its number, then by the job's name.
    numbers = spark.createDataFrame([(c.split("-", 1)[1].removesuffix(".json"), i) for i, c in enumerate(live)],
                                    "__job string, __commit int")
    told = rows.select("*", F.substring_index(F.col("_metadata.file_name"), "-", 1).alias("__job")).join(numbers, "__job")
    return last_write(told, table["keys"], ["__commit"]).select(*schema.fieldNames())


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """The items of a table: of each key that of the last commit that has one."""
    return _read(spark, path)


def get_items(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The items whose keys are in ``wanted``; only files of the keys' buckets are read. Null keys are found as well."""
    table = _table(path)
    keys = table["keys"]
    # At most one row per bucket.
    buckets = {r[0] for r in wanted.select(_bucket(keys, table["buckets"])).distinct().collect()}
    asked = wanted.select(*[F.col(k).alias(f"__{k}") for k in keys])
    items = _read(spark, path, buckets)
    same = [items[k].eqNullSafe(asked[f"__{k}"]) for k in keys]
    return items.join(asked, same, "left_semi")


def compact_items(spark: SparkSession, path: str) -> None:
    """One commit that stands in for all earlier ones. Their files go afterwards: readers that began before must be done."""
    path, live = path.rstrip("/"), commits(path)
    if len(live) < 2:
        return
    _write(_read(spark, path), path, _table(path), live)
    logs = _texts(f"{path}/commits")
    system, at = _place(path)
    for name in live:
        for data, _, _ in logs[name]["files"]:
            system.delete_file(f"{at}/data/{data}")
    # The newest commit names them as replaced until here.
    for name in live:
        system.delete_file(f"{at}/commits/{name}")
