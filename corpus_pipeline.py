"""A corpus pipeline: each stage works on what the one before it kept.

toxicity       drops documents that a classifier trained on ``labels`` rejects
near_dedup     keeps one document of each group whose SimHashes of 3-word shingles differ by at most 3 bits
decontaminate  drops documents in which a passage of ``benchmark`` occurs
mix            takes documents as often as the target weights of their sources say
shard          places the rows of the mix in 40 shards of nearly equal bytes
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import pareto, qgrams, ring, toxicity, vptree
from shelfmark.llm.common import table
from shelfmark.session import scratch_path

SHARDS = 40


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.without_toxic(docs, weights)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vptree.without_near_duplicates(docs, radius=3, words_per_shingle=3)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return qgrams.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto.mixed_documents(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ring.ring_shards(docs, SHARDS).withColumn("law", F.lit("bytes"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]

# Training a classifier and walking the ring are not SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
