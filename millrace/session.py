"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Bytes of shuffle input that one task should get before adaptive execution merges small ones.
SHUFFLE_TASK_BYTES = 128 << 20
# Bytes of files one scan task reads: small for small scans, larger where there would be too many tasks.
SCAN_TASK_BYTES = (128 << 20, 1 << 30)
SCAN_TASKS = 200_000


def sizes(shuffle_bytes: int | None = None, scan_bytes: int | None = None) -> dict[str, str]:
    """Settings that depend on the amount of data a job shuffles and scans."""
    out = {}
    if shuffle_bytes:
        parts = max(200, -(-shuffle_bytes // SHUFFLE_TASK_BYTES))
        out["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(parts)
    if scan_bytes:
        least, most = SCAN_TASK_BYTES
        out["spark.sql.files.maxPartitionBytes"] = str(min(most, max(least, scan_bytes // SCAN_TASKS)))
    return out


# Bytes of an Arrow batch: every task and its Python worker hold a few batches outside the JVM's heap. Spark's own bound
# is 64 MB and 10,000 rows.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """From now on the session's tasks and Python workers exchange batches of about ``batch_bytes``, at least a row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


def get_session(app: str = "millrace", master: str | None = None, conf: dict[str, str] | None = None,
                shuffle_bytes: int | None = None, scan_bytes: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings every job here expects.

    ``shuffle_bytes`` is the size of the largest shuffle of the job. It sets how many partitions
    adaptive execution starts from; it merges them where a shuffle turns out smaller.
    ``scan_bytes`` is the size of the largest table read.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **sizes(shuffle_bytes, scan_bytes), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors all see, as named by ``spark.checkpoint.dir``.

    Without the setting it is a folder below the warehouse, which is shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/millrace-scratch"


# Paths in use, the innermost owner last. The first list belongs to the application.
_owned: list[list[str]] = [[]]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder. It is removed with its owner: the innermost ``scratch`` block, or else
    the application when it ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _owned[0]:
        # Now that a session runs: what is registered later is called earlier, before the session goes.
        atexit.unregister(_release)
        atexit.register(_release)
    _owned[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch data that is made inside and removes it at the end. Results that read from it are to be
    written, or collected, before."""
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            remove(spark, path)


def _release() -> None:
    spark = SparkSession.getActiveSession()
    while spark is not None and _owned[0]:
        with suppress(Exception):
            remove(spark, _owned[0].pop())


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: the rows survive the loss of any executor, and later reads
    fetch only the columns they need."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
