"""Schemas of JSON lines found in the data, with a choice type where a field mixes types."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types of scalars as they show up in the data. Numbers with a point are doubles whatever their digits.
SCALARS = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType()}
OBJECT, ARRAY, VOID = "OBJECT", "ARRAY", "VOID"
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[A-Z_]+(?=<|\(|,|>|$)|\(\d+,\d+\)|[<>:,]|[^<>:,`\s]+|\s+")


def _walk(tokens: list[str], at: int, path: tuple[str, ...]) -> tuple[list[tuple[tuple[str, ...], str]], int]:
    """(path, type) of the type that starts at a token, and the token behind it."""
    kind = tokens[at]
    at += 1
    if kind in (OBJECT, ARRAY) and at < len(tokens) and tokens[at] == "<":
        found = [(path, kind)]
        at += 1
        while tokens[at] != ">":
            if tokens[at] == ",":
                at += 1
                continue
            if kind == OBJECT:
                name = tokens[at]
                name = name[1:-1].replace("``", "`") if name.startswith("`") else name
                inner, at = _walk(tokens, at + 2, (*path, name))
            else:
                inner, at = _walk(tokens, at, (*path, "[]"))
            found += inner
        return found, at + 1
    if at < len(tokens) and tokens[at].startswith("("):
        at += 1
    return [(path, "DOUBLE" if kind in ("DECIMAL", "FLOAT") else kind)], at


def shape_fields(shape: str) -> list[tuple[tuple[str, ...], str]]:
    """(path, type) of every field in the type of one value, as ``schema_of_variant`` words it. A step into an array is
    ``[]``."""
    tokens = [t for t in _TOKEN.findall(shape) if not t.isspace()]
    return _walk(tokens, 0, ())[0]


def field_types(lines: DataFrame, value: str = "value") -> DataFrame:
    """(path, type, rows): how many JSON texts have a value of a type at a path (array of names; ``[]`` is any element).

    One scan: each text is reduced to the type of its value by Spark, equal types are counted on both sides of the
    shuffle, and only different types are taken apart. Counts of parts of the data add up, so the aggregate of an
    aggregate is the same as that of all data. Texts that are no JSON have the type ``MALFORMED`` at the empty path;
    null and blank texts are no records.
    """
    text = F.col(f"`{value}`")
    shape = F.schema_of_variant(F.try_parse_json(text))
    # How many digits a decimal has makes no other type of it.
    plain = F.regexp_replace(shape, r"\b(: |<|^)DECIMAL\(\d+,\d+\)", "$1DOUBLE")
    shapes = (lines.where(text.isNotNull() & (F.trim(text) != "")).select(F.coalesce(plain, F.lit("MALFORMED")).alias("shape"))
              .groupBy("shape").agg(F.count("*").alias("rows")))

    def take_apart(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(list(path), kind, rows) for shape, rows in zip(frame["shape"], frame["rows"])
                   for path, kind in set(shape_fields(shape))]
            yield pd.DataFrame(out, columns=["path", "type", "rows"])

    return (shapes.mapInPandas(take_apart, "path array<string>, type string, rows long")
            .groupBy("path", "type").agg(F.sum("rows").alias("rows")))


def merge_types(fields: list[tuple[tuple[str, ...], str]], path: tuple[str, ...] = ()) -> T.DataType:
    """The least type that holds all values at a path: of no value and a type the type, of whole numbers and doubles
    doubles, of objects their fields together, of arrays one of the merged element, and of anything else a choice."""
    kinds = {kind for at, kind in fields if at == path} - {VOID, "MALFORMED"}
    if not kinds:
        return T.StringType()  # nulls only
    if kinds == {OBJECT}:
        names = sorted({at[len(path)] for at, _ in fields if len(at) > len(path) and at[:len(path)] == path})
        below = [(at, kind) for at, kind in fields if at[:len(path)] == path]
        return T.StructType([T.StructField(n, merge_types(below, (*path, n))) for n in names])
    if kinds == {ARRAY}:
        return T.ArrayType(merge_types(fields, (*path, "[]")))
    if kinds <= {"BIGINT", "DOUBLE"}:
        return SCALARS["DOUBLE" if "DOUBLE" in kinds else "BIGINT"]
    if len(kinds) == 1 and kinds <= set(SCALARS):
        return SCALARS[next(iter(kinds))]
    return T.VariantType()


def discovered_schema(types: DataFrame) -> T.StructType:
    """The schema for ``field_types``. What is collected is a row per field and type, not data."""
    fields = [(tuple(r["path"]), r["type"]) for r in types.collect()]
    found = merge_types(fields)
    if not isinstance(found, T.StructType):
        raise ValueError("the records are no JSON objects")
    return found


def choices(types: DataFrame) -> DataFrame:
    """(path, types) of the fields that mix types: dotted path and its types in order of their names.

    Whole numbers and doubles are one type here, as are nulls and any other. An array that mixes types by itself has
    elements of the type ``VARIANT``.
    """
    kinds = F.array_sort(F.collect_set("type"))
    mixed = (types.where(~F.col("type").isin(VOID, "MALFORMED")).groupBy("path").agg(kinds.alias("types"))
             .where((F.size("types") > 1) & (F.col("types") != F.array(F.lit("BIGINT"), F.lit("DOUBLE")))
                    | F.array_contains("types", "VARIANT")))
    return mixed.select(F.regexp_replace(F.array_join("path", "."), r"\.\[\]", "[]").alias("path"), "types")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Records of JSON lines. Without a schema it is found first, by one scan; fields that mix types become VARIANT
    columns (``resolve_choice`` settles them). Lines that do not parse have all fields null; blank lines are none."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    schema = schema or discovered_schema(field_types(lines))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")
