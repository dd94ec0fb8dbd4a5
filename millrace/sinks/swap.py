"""Exchange files of a folder for others as one step that survives a crash."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

JOURNAL = "_swaps"


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, target = file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, target):
        fs.delete(part, False)
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = file_system(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def files_below(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Files below a folder that Spark would read, at any depth."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    found, listing = [], fs.listFiles(root, True)
    while listing.hasNext():
        name = listing.next().getPath().toString()
        inner = name[len(fs.makeQualified(root).toString()):]
        hidden = any(p.startswith(".") or p.startswith("_") and "=" not in p for p in inner.split("/"))
        if name.endswith(suffix) and not hidden:
            found.append(name)
    return sorted(found)


def _apply(spark: SparkSession, folder: str, put: Mapping[str, str], drop: Iterable[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, _ = file_system(spark, folder)
    for staged, target in put.items():
        if fs.exists(path(staged)):
            fs.mkdirs(path(target).getParent())
            if not fs.rename(path(staged), path(target)) and not fs.exists(path(target)):
                raise OSError(f"cannot move {staged} to {target}")
    for gone in drop:
        fs.delete(path(gone), False)


def _journals(spark: SparkSession, folder: str) -> list[str]:
    fs, journals = file_system(spark, f"{folder.rstrip('/')}/{JOURNAL}")
    if not fs.exists(journals):
        return []
    names = [status.getPath().toString() for status in fs.listStatus(journals)]
    return sorted(n for n in names if n.endswith(".json") and not n.rsplit("/", 1)[1].startswith("."))


def _end(spark: SparkSession, folder: str, journal: str, what: dict) -> None:
    _apply(spark, folder, what["put"], what["drop"])
    for path in (what["staging"], journal):
        fs, done = file_system(spark, path)
        fs.delete(done, True)


@contextmanager
def staging(spark: SparkSession, folder: str) -> Iterator[str]:
    """A hidden folder inside ``folder`` for files that a swap will move. It goes if the work fails before the swap is
    decided; after that it goes when the swap ends."""
    path = f"{folder.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        if not any(json.loads(read_text(spark, j))["staging"] == path for j in _journals(spark, folder)):
            fs, done = file_system(spark, path)
            fs.delete(done, True)


def swap(spark: SparkSession, folder: str, staged: str, put: Mapping[str, str], drop: Iterable[str] = ()) -> None:
    """Move files out of the ``staged`` folder to their names and delete the files they stand in for.

    The list of both is written to the folder first. From then on the exchange is decided: should the driver die on the
    way, ``finish_swaps`` ends it. Files not named are never touched. New files come before old ones go, so a reader
    that lists the folder in between sees rows twice, never too few; writers of one folder must take turns.
    """
    what = {"put": dict(put), "drop": list(drop), "staging": staged}
    journal = f"{folder.rstrip('/')}/{JOURNAL}/{uuid.uuid4().hex}.json"
    write_text(spark, journal, json.dumps(what))
    _end(spark, folder, journal, what)


def finish_swaps(spark: SparkSession, folder: str) -> int:
    """End the exchanges that were decided and not ended; returns their number. Ending one twice changes nothing."""
    journals = _journals(spark, folder)
    for journal in journals:
        _end(spark, folder, journal, json.loads(read_text(spark, journal)))
    return len(journals)
