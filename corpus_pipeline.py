"""From raw documents to shards: the stages of :mod:`sievewatt.llm` one after the other.

Every stage takes the rows that its predecessor kept, and its result is written and read again before the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewatt.llm import decontaminate, mixing, partenum, sharding, toxicity
from sievewatt.llm.common import table
from sievewatt.runtime import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the score rejects go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts stays."""
    return partenum.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mixing.mixed(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; equal texts share a shard."""
    return sharding.shard(docs).select(F.col("id").alias("doc_id"), "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]

# The schedule of shards and a trained model are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
