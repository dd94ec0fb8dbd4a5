"""File sinks: folders, one named file, gzip archives by day, compaction."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import children


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", separator: str = ",") -> None:
    df.write.mode(mode).options(header=True, sep=separator).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: tuple[str, ...], buckets: int) -> None:
    """A parquet table hashed and sorted by its join keys.

    Two tables with the same keys and number of buckets join without a shuffle.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))


def write_pairs(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text lines of the form ``(word,count)``."""
    counts.select(F.format_string("(%s,%d)", *counts.columns)).write.mode(mode).text(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a file in place of ``target``. What was there stays until the new one has the name, or comes back; between
    the two renames there is a moment in which the name is free."""
    fs, to = _file_system(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(to.getParent())
    aside = path(f"{target}.old-{uuid.uuid4().hex}")
    kept = fs.exists(to)
    if kept and not fs.rename(to, aside):
        raise OSError(f"cannot move {target} aside")
    try:
        done = fs.rename(path(source), to)
    except Exception:
        done = False
    if not done:
        if kept:
            fs.rename(aside, to)
        raise OSError(f"cannot move {source} to {target}")
    if kept:
        fs.delete(aside, True)


def _join(spark: SparkSession, parts: list[str], target: str) -> None:
    """Bytes of several files as one: by the file system's own concatenation, or where it has none, as a stream of
    bytes from file to file."""
    fs, to = _file_system(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        fs.create(to).close()
        paths = spark._sc._gateway.new_array(path, len(parts))
        for i, part in enumerate(parts):
            paths[i] = path(part)
        fs.concat(to, paths)
        return
    except Exception as error:
        # "Not supported", or conditions on the parts that these do not meet.
        said = f"{type(error).__name__} {error}"
        if "UnsupportedOperation" not in said and "IllegalArgument" not in said:
            raise
    out = fs.create(to, True)
    try:
        for part in parts:
            source = fs.open(path(part))
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            source.close()
    finally:
        out.close()


def write_parts(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """A folder of parts, each with a header if the format has one."""
    df.write.mode(mode).format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def part_order(path: str) -> tuple[int, str]:
    """Parts by their number: from 100,000 tasks on names are longer and no longer sort as text."""
    name = path.rsplit("/", 1)[1]
    return int(re.match(r"part-(\d+)", name)[1]), name


def _part_files(spark: SparkSession, folder: str) -> list[str]:
    return sorted((p for p, n, _ in children(spark, folder) if n and p.rsplit("/", 1)[1].startswith("part-")), key=part_order)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write one file with exactly this name, whatever its size, and return the name.

    The rows are written in parallel as parts without a header into a private staging folder; the parts' bytes are
    joined in their order behind the header, so a sorted frame gives a sorted file and no rows pass through one task.
    The file takes its name at the end: until then, and if anything fails, the old one stays.
    """
    if fmt not in ("csv", "json", "text"):
        raise ValueError(f"parts of {fmt} cannot be joined; use write_parts")
    spark = df.sparkSession
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    staging = f"{folder}/.staging-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(f"{staging}/rows")
        parts = _part_files(spark, f"{staging}/rows")
        if fmt == "csv":
            names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
            names.coalesce(1).write.csv(f"{staging}/header")
            parts = _part_files(spark, f"{staging}/header") + parts
        _join(spark, parts, f"{staging}/whole")
        _replace(spark, f"{staging}/whole", path)
    finally:
        fs, done = _file_system(spark, staging)
        fs.delete(done, True)
    return path


def write_archive(df: DataFrame, path: str, mode: str = "append") -> None:
    """Gzip JSON lines by year, month and day (columns of the frame).

    The rebalance hint gathers the rows of a day, so that it gets few files, and splits the
    partition of a day that is larger than the advisory partition size.
    """
    days = ["year", "month", "day"]
    (df.hint("rebalance", *days).write.mode(mode).partitionBy(*days)
       .option("compression", "gzip").json(path))


def write_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """One target per frame, e.g. all frames of a relationalized root."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{folder.rstrip('/')}/{name}")


def compact(spark: SparkSession, source: str, target: str, fmt: str, pattern: str = "*",
            target_bytes: int = 128 << 20, schema: str | None = None, **options) -> int:
    """Rewrite many small files as few of about ``target_bytes``; returns the number of inputs.

    The scan itself packs small files into one task up to the target size, so nothing is shuffled.
    Reading also strips the header each CSV part carries, which joining bytes would repeat. Files of parquet and ORC
    may have different columns: all are kept. CSV and JSON need a schema that names all columns.
    """
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"files of {fmt} do not tell all columns; give a schema")
    matched = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path").count())
    if not matched:
        raise FileNotFoundError(f"no file in {source} matches {pattern}")
    packed = spark.newSession()
    packed.conf.set("spark.sql.files.maxPartitionBytes", target_bytes)
    packed.conf.set("spark.sql.files.openCostInBytes", 0)
    packed.conf.set("spark.sql.files.minPartitionNum", 1)
    reader = packed.read.format(fmt).options(**options).option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", True)
    reader.load(source).write.format(fmt).options(**options).mode("overwrite").save(target)
    return matched
