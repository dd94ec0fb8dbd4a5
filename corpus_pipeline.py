"""From raw documents to token files: five stages, each over everything the one before kept.

Every stage takes (spark, docs, folder of the tables) and returns a frame that is written as Parquet and read again as
the next one's documents. All but the last return the columns of ``documents``. Stages run one after the other in the
same executors, so each bounds the batches that its workers get: what a stage took stays with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, jaccard_join, mixing, quality, token_files
from millrace.session import bound_batches, stored
from millrace.llm.registry import table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    bound_batches(spark)
    return quality.drop_rejects(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join stays."""
    bound_batches(spark)
    return jaccard_join.drop_near_copies(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    bound_batches(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, repeated or cut at their source's budget."""
    bound_batches(spark)
    return mixing.apply_mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, as read back: one row per document of the mix."""
    bound_batches(spark)
    return token_files.encode_documents(docs)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]

# The classifier is trained, and the tokenizer is a library: neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs
