"""Names for data: discover folders, register views, list and refresh them."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "json", "csv", "orc", "text")


def children(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """(path, bytes, is directory) of the visible entries of a folder, on any file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen(), status.isDirectory()))
    return found


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()


def discover(spark: SparkSession, base: str, pattern: str = "*", fmt: str | None = None) -> dict[str, dict]:
    """Tables below ``base`` whose name matches: {name: {path, format}}. Names come from the entries.

    Without ``fmt`` the format is taken from the entry's extension.
    """
    tables = {}
    for path, _, _ in children(spark, base):
        entry = path.rstrip("/").rsplit("/", 1)[1]
        stem, _, extension = entry.partition(".")
        found = fmt or next((f for f in FORMATS if f in extension.split(".")), None)
        if found and fnmatch(stem, pattern):
            if stem in tables:
                raise ValueError(f"{path} and {tables[stem]['path']} would both be named {stem}")
            tables[stem] = {"path": path, "format": found}
    return tables


def register(spark: SparkSession, tables: dict[str, dict], prefix: str = "", persist: bool = False) -> list[str]:
    """Name each table spec: path, format, and optionally schema and options.

    A spec without a schema is inferred; for large JSON or CSV give one, or a ``samplingRatio``
    option. The names are temp views, or with ``persist`` tables of the current database.
    """
    names = []
    for stem, spec in tables.items():
        name, options = f"{prefix}{stem}", dict(spec.get("options", {}))
        if persist:
            schema = spec.get("schema") or _reader(spark, spec, options).load(spec["path"]).schema
            if isinstance(schema, str):
                schema = T.StructType.fromDDL(schema)
            if spark.catalog.tableExists(name):
                if spark.catalog.getTable(name).tableType != "EXTERNAL":
                    raise ValueError(f"{name} is a table that owns its data")
                spark.sql(f"DROP TABLE `{name}`")
            spark.catalog.createTable(name, path=spec["path"], source=spec["format"], schema=schema, **options)
        else:
            _reader(spark, spec, options).load(spec["path"]).createOrReplaceTempView(name)
        names.append(name)
    return names


def _reader(spark: SparkSession, spec: dict, options: dict) -> DataFrameReader:
    reader = spark.read.format(spec["format"]).options(**options)
    return reader.schema(spec["schema"]) if spec.get("schema") else reader.option("inferSchema", True)


def use(spark: SparkSession, database: str) -> None:
    spark.catalog.setCurrentDatabase(database)


def show_tables(spark: SparkSession, pattern: str = "*") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if fnmatch(t.name, pattern))


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over named frames: ``query(spark, "SELECT * FROM {t}", t=df)``."""
    return spark.sql(sql, **frames)


def refresh(spark: SparkSession, table: str | None = None, path: str | None = None) -> None:
    """Forget cached file listings of a table or path that another job rewrote."""
    if table:
        spark.catalog.refreshTable(table)
    if path:
        spark.catalog.refreshByPath(path)
