"""Column shaping: mapping, choice resolution, JSON unboxing, relationalizing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import millis_to_timestamp, null_if_token
from ..session import stored

# Type names a mapping may use, where they differ from Spark's own.
TYPE_NAMES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint", "bool": "boolean"}

Mapping = tuple[str, str, str, str]


def spark_type(name: str) -> str:
    return TYPE_NAMES.get(name.lower(), name)


def column(df: DataFrame, path: str) -> Column:
    """A column by exact name (dots included) or, failing that, by struct path."""
    return F.col(f"`{path}`") if path in df.columns else F.col(path)


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.StructType, T.MapType))


def convert(value: Column, source: T.DataType, target: str) -> Column:
    """Cast that yields NULL instead of an error.

    A whole number becomes a timestamp by counting milliseconds; nested values become JSON text.
    """
    target = spark_type(target)
    if target == "string" and _is_nested(source):
        return F.to_json(value)
    if target == "timestamp" and isinstance(source, T.IntegralType):
        return millis_to_timestamp(value)
    return value.try_cast(target)


def apply_mapping(df: DataFrame, mappings: Iterable[Mapping]) -> DataFrame:
    """Project, rename, cast and unnest in one ``select``; unlisted columns are dropped.

    Each mapping is (source path, source type, target name, target type).
    """
    mappings = list(mappings)
    sources = df.select(*[column(df, path).alias(str(i)) for i, (path, *_) in enumerate(mappings)]).schema
    return df.select(*[
        convert(column(df, path), sources[i].dataType, target).alias(name)
        for i, (path, _, name, target) in enumerate(mappings)
    ])


def rename_field(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def select_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    return df.select(*[column(df, path) for path in paths])


def drop_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Drop columns, names with dots included, or fields inside a struct column."""
    for path in paths:
        path = path.strip("`")
        root, _, rest = path.partition(".")
        if path in df.columns:
            df = df.drop(path)
        elif rest and root in df.columns:
            df = df.withColumn(root, F.col(f"`{root}`").dropFields(rest))
    return df


def drop_null_fields(df: DataFrame, by: str = "type") -> DataFrame:
    """Drop columns that cannot hold a value (``by="type"``, free) or hold none (``by="data"``).

    The data form is one extra pass that reads a single boolean per column.
    """
    if by == "data":
        seen = df.agg(*[F.bool_or(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]).first()
        return df.drop(*[c for c in df.columns if not seen[c]])
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NullType):
            df = df.drop(field.name)
        elif isinstance(field.dataType, T.StructType):
            empty = [f.name for f in field.dataType.fields if isinstance(f.dataType, T.NullType)]
            if empty and len(empty) == len(field.dataType.fields):
                df = df.drop(field.name)
            elif empty:
                df = df.withColumn(field.name, F.col(f"`{field.name}`").dropFields(*[f"`{n}`" for n in empty]))
    return df


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _holds(kind: Column, target: str) -> Column:
    """Whether values of a variant's kind are values of a type, without loss."""
    if target in ("tinyint", "smallint", "int", "bigint"):
        return kind == "BIGINT"
    if target in ("float", "double") or target.startswith("decimal"):
        return kind.isin("BIGINT", "FLOAT", "DOUBLE") | kind.startswith("DECIMAL")
    return kind == target.upper()


def _choice_branches(df: DataFrame, name: str, types: Sequence[str]) -> dict[str, Column]:
    """One column per candidate type; each value shows up in exactly one of them."""
    value = _named(name)
    branches: dict[str, Column] = {}
    if isinstance(df.schema[name].dataType, T.VariantType):
        left = ~F.is_variant_null(value)
        for i, t in enumerate(types):
            target = spark_type(t)
            got = F.try_variant_get(value, "$", target)
            if i < len(types) - 1:
                fits = F.coalesce(_holds(F.schema_of_variant(value), target) & got.isNotNull(), F.lit(False))
            else:
                fits = F.lit(True)
                if target == "string":
                    got = F.coalesce(got, F.to_json(value))
            branches[t] = F.when(left & fits, got)
            left = left & ~fits
        return branches
    taken = F.lit(False)
    for t in types:
        cast = value.try_cast(spark_type(t))
        branches[t] = F.when(~taken, cast)
        taken = taken | cast.isNotNull()
    return branches


def resolve_choice(
    df: DataFrame,
    specs: Iterable[tuple[str, str]] = (),
    choice: str | None = None,
    types: Sequence[str] = ("long", "string"),
) -> DataFrame:
    """Settle columns that mix types, held as STRING or VARIANT.

    ``specs`` names columns with ``cast:T``, ``make_cols`` or ``make_struct``; ``choice`` applies
    one action to every VARIANT column. The last of ``types`` should be the catch-all.
    """
    actions = dict(specs)
    if choice:
        for field in df.schema.fields:
            if isinstance(field.dataType, T.VariantType):
                actions.setdefault(field.name, choice)
    out = []
    for name in df.columns:
        action = actions.get(name)
        if action is None:
            out.append(_named(name))
        elif action.startswith("cast:"):
            target = spark_type(action.removeprefix("cast:"))
            if isinstance(df.schema[name].dataType, T.VariantType):
                out.append(F.try_variant_get(_named(name), "$", target).alias(name))
            else:
                out.append(_named(name).try_cast(target).alias(name))
        elif action == "make_cols":
            out += [c.alias(f"{name}_{t}") for t, c in _choice_branches(df, name, types).items()]
        elif action == "make_struct":
            branches = _choice_branches(df, name, types)
            out.append(F.struct(*[c.alias(t) for t, c in branches.items()]).alias(name))
        else:
            raise ValueError(f"unknown choice action {action!r}")
    return df.select(*out)


def json_schema(df: DataFrame, name: str) -> str:
    """DDL that fits every JSON text of a column, found by one distributed aggregate."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{name}`")))).first()[0]
    if not found or not found.startswith("OBJECT<"):
        raise ValueError(f"column {name!r} holds no common JSON object (found {found})")
    # Types stand at the start, behind a colon or as the element of an array; the same words may be field names.
    ddl = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", found)
    ddl = re.sub(r"(: |ARRAY<)(?:VOID|VARIANT)\b", r"\1STRING", ddl)
    return re.sub(r"(: |ARRAY<)DECIMAL\(\d+,\d+\)", r"\1DOUBLE", ddl)


def unbox(df: DataFrame, name: str, schema: str | T.StructType | None = None, flatten: bool = True) -> DataFrame:
    """Parse a JSON text column into typed fields; malformed text gives NULL fields."""
    boxed = df.withColumn(name, F.from_json(F.col(f"`{name}`"), schema or json_schema(df, name)))
    if not flatten:
        return boxed
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return boxed.select(*kept, f"`{name}`.*")


def _leaves(schema: T.StructType, parent: Column | None, prefix: str) -> list[tuple[str, Column, T.DataType]]:
    found = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, value, f"{name}.")
        else:
            found.append((name, value, field.dataType))
    return found


def relationalize(df: DataFrame, root: str, key: str | None = None) -> dict[str, DataFrame]:
    """Nested rows to flat tables: structs to dotted columns, each array to a child table.

    An array column in the parent holds the row's id; its child table has ``id`` (foreign key),
    ``index`` and ``val`` columns. ``key`` names a unique column to use as id. Without one,
    ids are generated and the rows written, so that parent and children agree on them.
    """
    if key is None:
        key = "__row_id"
        df = stored(df.withColumn(key, F.monotonically_increasing_id()), "relationalize")
        tables = _relations(df, root, F.col(key), skip={key})
    else:
        tables = _relations(df, root, F.col(f"`{key}`"), skip=set())
    return tables


def _relations(df: DataFrame, name: str, row_id: Column, skip: set[str]) -> dict[str, DataFrame]:
    columns, children = [], {}
    for path, value, data_type in _leaves(df.schema, None, ""):
        if path in skip:
            continue
        if isinstance(data_type, T.ArrayType):
            columns.append(F.when(value.isNotNull(), row_id).alias(path))
            # Child names take the field path, without the "val" step of the parent table.
            child = f"{name}_{path.removeprefix('val.')}" if path != "val" else f"{name}_val"
            exploded = df.select(row_id.alias("id"), F.posexplode(value).alias("index", "val"))
            children[child] = exploded
        else:
            columns.append(value.alias(path))
    tables = {name: df.select(*columns)}
    for child, exploded in children.items():
        nested_id = F.concat_ws(":", F.col("id").cast("string"), F.col("index").cast("string"))
        tables.update(_relations(exploded, child, nested_id, skip=set()))
    return tables


def remap(df: DataFrame, source: str, target: str) -> DataFrame:
    """Rename an attribute, e.g. to a name with a dot."""
    return df.withColumnRenamed(source, target)


def null_normalise(df: DataFrame, columns: Sequence[str], token: str = "null") -> DataFrame:
    """Turn a literal token such as ``"null"`` into NULL."""
    return df.withColumns({c: null_if_token(c, token) for c in columns})
