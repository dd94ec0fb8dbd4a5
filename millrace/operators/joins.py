"""Equi-joins. Plain joins leave broadcast, sort-merge and skew splitting to Spark."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


def prefix_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str] | str,
                right_keys: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join on differently named keys and keep all columns of both sides.

    Where both sides have a column name, the left one gets a leading dot.
    """
    left_keys = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    right_keys = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    taken = set(left.columns) | set(right.columns)
    renames = {}
    for name in left.columns:
        if name in right.columns:
            new = f".{name}"
            while new in taken:
                new = f".{new}"
            taken.add(new)
            renames[name] = new
    left = left.withColumnsRenamed(renames)
    condition = reduce(Column.__and__, (
        F.col(f"`{renames.get(a, a)}`") == right[f"`{b}`"] for a, b in zip(left_keys, right_keys, strict=True)
    ))
    return left.join(right, condition, how)


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, Sequence[str] | str]) -> DataFrame:
    """Chain of inner joins on shared key names."""
    for dimension, keys in dimensions:
        fact = fact.join(dimension, keys, "inner")
    return fact


def in_list(df: DataFrame, values: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in another frame; never multiplies rows, whatever the list repeats."""
    return df.join(values, keys, "left_semi")


def ref_check(df: DataFrame, reference: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key is missing from the reference frame."""
    return df.join(reference, keys, "left_anti")


def merge_by_key(source: DataFrame, stage: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Staged rows replace source rows of the same key; all other rows are kept."""
    return stage.unionByName(source.join(stage, keys, "left_anti"))


def fanout_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a many-to-many join would give per key, without building the pairs."""
    keys = list(keys)
    a = left.groupBy(*keys).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(*keys).agg(F.count("*").alias("right_rows"))
    return a.join(b, keys).withColumn("joined_rows", F.col("left_rows") * F.col("right_rows"))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and their rows: never more than ``rows / hot_rows`` of them."""
    return (df.groupBy(*keys).agg(F.count("*").alias("__rows"))
            .filter(F.col("__rows") > hot_rows).select(*keys, "__rows"))


def salted_join(fact: DataFrame, other: DataFrame, keys: Sequence[str], salt_by: Sequence[str],
                how: str = "inner", hot_rows: int = 2_000_000) -> DataFrame:
    """Join with a fact side whose hottest keys hold a large share of the rows.

    Rows of a hot key are spread by a hash of ``salt_by`` (columns that differ within a key, so that the spread is the
    same if a task is run again) over as many salts as it has times ``hot_rows`` rows, so a salt has about that many at
    any size. The matching rows of the other side are repeated once per salt of their key; other keys are not touched.
    Rows without a key match nothing: in a left join they bypass it.
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("the repeated side must be the right side of an inner or left join")
    keys = list(keys)
    unmatched = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    # A written table of known size: Spark broadcasts it where it is small.
    hot = stored(hot_keys(fact.filter(~unmatched), keys, hot_rows)
                 .withColumn("__salts", F.ceil(F.col("__rows") / max(1, hot_rows)).cast("int")).drop("__rows"), "hot-keys")
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    salted = (fact.filter(~unmatched).join(hot, keys, "left")
              .withColumn("__salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int")).drop("__salts"))
    repeated = (other.join(hot, keys, "left")
                .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts"))
    joined = salted.join(repeated, [*keys, "__salt"], how).drop("__salt")
    if how == "inner":
        return joined
    return joined.unionByName(fact.filter(unmatched), allowMissingColumns=True)
