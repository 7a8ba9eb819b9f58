"""One registered query per corpus operator, each over its whole table.

SQL twins exist where SQL can express the operator; the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import hosts, lines, merkle, pareto, phrases, qgrams, ring, surrogates, tokens, toxicity, vptree, whitening, windows
from shelfmark.llm.common import table
from shelfmark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(table(spark, sf_dir, "documents"), "production-key")


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgrams.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto.pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_against_next(table(spark, sf_dir, "documents"))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.ring_shards(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    scored = toxicity.toxicity_scores(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.coalesce(bad, F.lit(0)).alias("bad"))
    judged = hosts.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.substring_dedup(table(spark, sf_dir, "documents"), 50).drop("removed")


def op9_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vptree.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op11_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    tokens.write_shards(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), spaced=True)
    return tokens.read_documents(spark, folder)


QUERIES: dict[str, Query] = {
    "op1_surrogates": op1_surrogates,
    "op2_qgram_decontamination": op2_qgram_decontamination,
    "op3_pareto_mix": op3_pareto_mix,
    "op4_merkle_tree": op4_merkle_tree,
    "op5_ring_shards": op5_ring_shards,
    "op6_ftrl_toxicity": op6_ftrl_toxicity,
    "op7_host_reputation": op7_host_reputation,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash_vptree": op9_simhash_vptree,
    "op10_line_dedup": op10_line_dedup,
    "op11_lanczos_whitening": op11_lanczos_whitening,
    "op12_phrase_tries": op12_phrase_tries,
    "op13_token_shards": op13_token_shards,
}

ORACLE: dict[str, str] = {"op3_pareto_mix": pareto.SQL, "op7_host_reputation": hosts.SQL}
