"""Mixing sources to target weights.

Every document gets a hash-random key. A source's documents are ordered by that key; prefix sums of their sizes are
computed in hash ranges (a range of keys is a task's work, the ranges' sums are added up separately), and the source
is cut where the sum meets its budget. A budget above the source's size repeats the source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
EPOCHS = 2
# Documents that one hash range is meant to hold.
RANGE_ROWS = 16384


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            epochs: int = EPOCHS) -> DataFrame:
    """Budget of each source: from (source, source_size), one row per source, adds ``target``.

    Sources in order of code points, null last, weigh ``weights`` in turn. ``share`` of all sizes is dealt out by
    weight; a budget ends at ``epochs`` times the source's size and what is over is dealt to the others. In order of
    size per weight the full sources come first, so the level at which nothing is over is the highest
    that its own source is not filled by.
    """
    rank = F.row_number().over(W.Window.orderBy(F.col("source").asc_nulls_last()))
    everything = W.Window.partitionBy()
    full = W.Window.orderBy("__ratio", "__rank").rowsBetween(W.Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    levels = (sizes.withColumn("__rank", rank).withColumn("__weight", weight)
              .withColumn("__cap", F.col("source_size") * epochs)
              .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
              .withColumn("__left", share * F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("__cap").over(full), F.lit(0)))
              .withColumn("__open", F.sum("__weight").over(everything)
                          - F.coalesce(F.sum("__weight").over(full), F.lit(0.0)))
              .withColumn("__level", F.try_divide(F.col("__left"), F.col("__open"))))
    level = F.max(F.when(F.col("__level") <= F.col("__ratio"), F.col("__level"))).over(everything)
    return levels.select("source", "source_size",
                         F.least(F.col("__cap").cast("double"),
                                 F.coalesce(level, F.lit(float("inf"))) * F.col("__weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``.

    ``taken`` counts words, repeats included: the size once per whole epoch of the source, and in the last epoch all
    of the documents before the cut and the part of one document up to it. Sizes are whole numbers, so the taken words
    of a source add up to its target rounded down. Null texts have no words; a null source is a source; repeated rows
    count each. The key depends on doc_id and size only, so reruns agree.
    """
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    return mix_sizes(sized, weights, share, epochs, range_rows)


def mix_sizes(sized: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, range_rows=RANGE_ROWS) -> DataFrame:
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # The first 32 bits of the key choose the range. Ranges of one width hold about as many rows each.
    keyed = sized.withColumn("__key", key)
    totals = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    per_source = (targets(totals.select("source", "source_size"), weights, share, epochs)
                  .join(totals.select(F.col("source").alias("__s"), "__rows"), F.col("source").eqNullSafe(F.col("__s")))
                  .drop("__s").withColumn("__ranges", F.ceil(F.col("__rows") / range_rows).cast("long")))
    named = per_source.withColumnRenamed("source", "__s")
    ranged = (keyed.join(named, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
              .withColumn("__range", F.shiftright(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
                                                  * F.col("__ranges"), 32)))
    before = W.Window.partitionBy("__s").orderBy("__r").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(F.col("source").alias("__s"), F.col("__range").alias("__r")).agg(F.sum("size").alias("n"))
              .select("__s", "__r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
    inside = (W.Window.partitionBy("source", "__range").orderBy("__key", "doc_id", "size")
              .rowsBetween(W.Window.unboundedPreceding, -1))
    placed = (ranged.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r"))))
    budget = F.floor(F.col("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - (F.col("__before") + F.col("__in"))))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (whole * F.col("size") + part).cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words, one space between them."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), n.cast("int")), " ")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: a document comes once per whole taken copy, and the one
    at its source's cut also with its first words. Documents of which nothing is taken are gone.

    The decision belongs to doc_id, source and size; rows that agree in those share their taken words evenly by order.
    """
    names = docs.columns
    parts = ["__doc", "__source", "__size", "__nth"]
    nth = F.row_number().over(W.Window.partitionBy("__doc", "__source", "__size").orderBy("__tie"))
    taken = (mix(docs, **options).select(F.col("doc_id").alias("__doc"), F.col("source").alias("__source"),
                                         F.col("size").alias("__size"), F.col("taken").alias("__taken"))
             .withColumn("__tie", F.col("__taken")).withColumn("__nth", nth).drop("__tie"))
    sized = (docs.withColumns({"__d": F.col("doc_id"), "__s": F.col("source"), "__n": words(F.col("text")),
                               "__h": F.xxhash64("text")})
             .withColumn("__k", F.row_number().over(W.Window.partitionBy("__d", "__s", "__n").orderBy("__h"))))
    same = (F.col("__d").eqNullSafe(F.col("__doc")) & F.col("__s").eqNullSafe(F.col("__source"))
            & (F.col("__n") == F.col("__size")) & (F.col("__k") == F.col("__nth")))
    joined = sized.join(taken.where("__taken > 0"), same).drop(*parts)
    copies = F.floor(F.col("__taken") / F.col("__n")).cast("int")
    left = (F.col("__taken") - copies * F.col("__n")).cast("int")
    lengths = F.concat(F.array_repeat(F.col("__n").cast("int"), copies),
                       F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<int>")))
    out = joined.withColumn("__len", F.explode(lengths))
    cut = F.when(F.col("__len") < F.col("__n"), first_words(F.col("text"), F.col("__len"))).otherwise(F.col("text"))
    return out.withColumn("text", cut).select(*names)


@query(sql=r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM totals),
weighed AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM ranked),
ordered AS (SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS ratio FROM weighed),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::BIGINT
             - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
            / (sum(weight) OVER ()
               - coalesce(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS lev
  FROM ordered),
target AS (
  SELECT source, source_size,
         least(cap::DOUBLE, max(CASE WHEN lev <= ratio THEN lev END) OVER () * weight) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, floor(target)::BIGINT AS budget,
               CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM placed)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(0, budget - whole * source_size - before)))::BIGINT AS taken FROM cut
""")
def op3_weighted_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
