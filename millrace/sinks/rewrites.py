"""Stored tables changed in part: only the files that must change are written anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import stored
from .swap import file_system, files_below, finish_swaps, staging, swap

# Files up to this size are merged, larger ones stay as they are.
SMALL_BYTES = 6_000_000


def _listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, bytes) of the files at any depth; their contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(folder))
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """(path, dir, bin) of files (path, bytes) to be merged: per folder, in order of path, bins of about
    ``target_bytes``. A file that would be alone in its bin has nothing to be merged with and is left out."""
    rows = files.withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
    before = Window.partitionBy("dir").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__at", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    together = Window.partitionBy("dir", "__at")
    return (placed.withColumn("__n", F.count("*").over(together)).where("__n > 1")
            .withColumn("bin", F.concat_ws("#", "dir", F.col("__at").cast("string"))).select("path", "dir", "bin"))


def compact_small(spark: SparkSession, folder: str, fmt: str = "parquet", small_bytes: int = SMALL_BYTES,
                  target_bytes: int = 128 << 20, pattern: str = "*", schema: str | T.StructType | None = None,
                  **options) -> dict[str, int]:
    """Merge the files of at most ``small_bytes`` within each (partition) folder and leave the others alone.

    Larger files keep name and bytes. The small ones are packed into bins of about ``target_bytes`` by the listing;
    each bin is written by one task as one file. The results take their names, and the merged files go, in one swap at
    the end. Files of parquet and ORC may differ in columns; CSV and JSON need a schema that names all of them. Returns
    how many files were ``kept``, ``merged`` and ``written``. File names, no contents, pass through the driver.
    """
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"files of {fmt} do not tell all columns; give a schema")
    finish_swaps(spark, folder)
    files = stored(_listing(spark, folder, pattern), "listing")
    plan = stored(packed(files.where(F.col("bytes") <= small_bytes), target_bytes), "bins")
    total, merged = files.count(), plan.count()
    if not merged:
        return {"kept": total, "merged": 0, "written": 0}
    numbers = {r["bin"]: (i, r["dir"]) for i, r in enumerate(plan.select("bin", "dir").distinct().orderBy("bin").collect())}
    number = stored(spark.createDataFrame([(b, i) for b, (i, _) in numbers.items()], "bin string, __bin int"), "bin-numbers")
    # Folder names are no columns here: a file goes back to the folder that it came from.
    reader = spark.read.format(fmt).options(**options).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    rows = reader.load(folder)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    chosen = (rows.where(F.col("_metadata.file_size") <= small_bytes)
              .select(*columns, F.col("_metadata.file_path").alias("__path"))
              .join(plan.join(number, "bin").select(F.col("path").alias("__path"), "__bin"), "__path").drop("__path"))
    with staging(spark, folder) as staged:
        (chosen.repartition(len(numbers), "__bin").sortWithinPartitions("__bin").write.format(fmt).options(**options)
         .partitionBy("__bin").save(f"{staged}/rows"))
        dirs, put = dict(numbers.values()), {}
        for path in files_below(spark, f"{staged}/rows"):
            at = int(path.rsplit("/", 2)[1].partition("=")[2])
            name = path.rsplit("/", 1)[1]
            put[path] = f"{dirs[at]}/{name.partition('.')[0]}-{at:05d}.{name.partition('.')[2]}"
        if not put:  # no rows in any of them: they still tell the columns
            return {"kept": total, "merged": 0, "written": 0}
        swap(spark, folder, staged, put, [r["path"] for r in plan.select("path").collect()])
    return {"kept": total - merged, "merged": merged, "written": len(put)}


def _near(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Target rows between the staged keys' ends: a filter that parquet files are skipped by. None without keys."""
    ends = stage.agg(*[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for i, k in enumerate(keys):
        if ends[f"lo{i}"] is None:
            return None
        target = target.where(F.col(k).between(F.lit(ends[f"lo{i}"]), F.lit(ends[f"hi{i}"])))
    return target


def merge_into(spark: SparkSession, folder: str, stage: DataFrame, keys: Sequence[str],
               partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Merge staged rows into a stored parquet table by ``keys``: staged rows replace those with an equal key, all other
    rows are kept. Rows without a key match nothing and are added.

    A first pass reads only the keys, within the range of the staged ones, and finds the files that hold any. Only these
    are read whole and written anew, without the replaced rows; the staged rows come as further files. One swap makes
    the exchange. Files without a staged key keep name, bytes and time stamp. Returns how many files were ``kept``,
    ``rewritten`` and ``written``.
    """
    finish_swaps(spark, folder)
    before = files_below(spark, folder)
    stage = stored(stage, "stage")
    if not before:
        stage.write.mode("append").partitionBy(*partition_by).parquet(folder)
        return {"kept": 0, "rewritten": 0, "written": len(files_below(spark, folder))}
    keys = list(keys)
    target = spark.read.parquet(folder)
    wanted = stage.select(*keys).distinct()
    near = _near(target, stage, keys)
    touched = [] if near is None else [r[0] for r in near.select(*keys, F.col("_metadata.file_path").alias("__path"))
                                       .join(wanted, keys, "left_semi").select("__path").distinct().collect()]
    rows = stage.select(*target.columns)
    if touched:
        old = spark.read.schema(target.schema).option("basePath", folder).parquet(*touched)
        rows = old.join(wanted, keys, "left_anti").select(*target.columns).unionByName(rows)
    with staging(spark, folder) as staged:
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        rows.write.partitionBy(*partition_by).parquet(f"{staged}/rows")
        fs, at = file_system(spark, f"{staged}/rows")
        root = fs.makeQualified(at).toString()
        put = {path: f"{folder.rstrip('/')}{path[len(root):]}" for path in files_below(spark, f"{staged}/rows")}
        swap(spark, folder, staged, put, touched)
    return {"kept": len(before) - len(touched), "rewritten": len(touched), "written": len(put)}
