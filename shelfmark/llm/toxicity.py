"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, pairs of neighbours, and pairs with one word between them, hashed to
``2**bits`` weights; a feature counts once per text.  Training is online: every coordinate has its
own learning rate, and an L1 threshold keeps the weight of a rare or useless feature at exactly
zero.  What is left is a short list of weights, at most ``2**bits``, that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import per_batch, text_of

BITS = 20
SAMPLE = 20_000  # most labelled documents to train on
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 15.0, 0.1, 5
POSITIVE = 3.0  # weight of a toxic document, of which there are few
STRIP = b".,;:!?*$%&#|\"'()[]{}<>~-_=+"
SLICE = 500_000  # words scored together


class Weights(NamedTuple):
    """Sorted feature numbers, their weights, and the bias."""

    features: np.ndarray
    values: np.ndarray
    bias: float


def words_of(text: str) -> list[bytes]:
    """Words in lower case without punctuation around them."""
    return [w for w in (x.strip(STRIP) for x in text.lower().encode("utf-8", "surrogatepass").split()) if w]


def word_hashes(words: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    for w in set(words).difference(seen):
        seen[w] = digest(w)
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def _mixed(values: np.ndarray, bits: int) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (values >> np.uint64(64 - bits)).astype(np.int32)


def features(hashes: np.ndarray, docs: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, their documents): words, then pairs, then pairs around one word."""
    with np.errstate(over="ignore"):
        yield _mixed(hashes, bits), docs
        for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            if len(hashes) > gap:
                same = docs[:-gap] == docs[gap:]
                pairs = hashes[:-gap] * np.uint64(factor) + hashes[gap:]
                yield _mixed(pairs[same], bits), docs[:-gap][same]


def document_features(text: str, seen: dict[bytes, int], bits: int) -> np.ndarray:
    """The distinct features of one text, sorted."""
    words = words_of(text)
    hashes = word_hashes(words, seen)
    return np.unique(np.concatenate([f for f, _ in features(hashes, np.zeros(len(words), np.int64), bits)]))


def ftrl(rows: list[np.ndarray], labels: np.ndarray, bits: int, epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal over the rows in the order given, ``epochs`` times; the last weight is the bias."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    l1 = L1
    for _ in range(epochs):
        for own, y in zip(rows, labels):
            at = np.append(own, 1 << bits)
            zs, ns = z[at], n[at]
            w = _weights(zs, ns, l1)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - y) * (POSITIVE if y else 1.0)
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            n[at] = ns + g * g
    w = _weights(z, n, l1)
    kept = np.flatnonzero(w[:-1])
    return Weights(kept.astype(np.int32), w[kept], float(w[-1]))


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    small = np.abs(z) <= l1
    w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[small] = 0.0
    return w


def train(docs: DataFrame, labels: DataFrame, *, bits: int = BITS, sample: int = SAMPLE, epochs: int = EPOCHS) -> Weights:
    """Fit the weights to (doc_id, toxic 0/1) and the texts of ``docs``.

    At most ``sample`` labelled documents, chosen and ordered by a hash of their doc_id, are used;
    they are the only part of the corpus that meets in one task, and as a short list of ids they
    are broadcast so that texts are not shuffled.  Rows with a null id, label or text do not count.
    Without any label the weights are empty and every score is one half.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.col("doc_id"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(order, "doc_id").limit(sample).collect()
    ids = spark.createDataFrame([(int(r["doc_id"]), r["toxic"]) for r in chosen], "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id").where("text IS NOT NULL").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(rank=[xxhash.xxh3_64_intdigest(str(d)) for d in group["doc_id"]]).sort_values(["rank", "doc_id"])
        seen: dict[bytes, int] = {}
        found = ftrl([document_features(t, seen, bits) for t in group["text"]], group["toxic"].to_numpy(float), bits, epochs)
        return pd.DataFrame({"feature": np.append(found.features, -1), "weight": np.append(found.values, found.bias)})

    fitted = rows.withColumn("everything", F.lit(0)).groupBy("everything").applyInPandas(fit, "feature int, weight double").collect()
    pairs = sorted((r["feature"], r["weight"]) for r in fitted if r["feature"] >= 0)
    bias = next((r["weight"] for r in fitted if r["feature"] < 0), 0.0)
    return Weights(np.array([p[0] for p in pairs], np.int32), np.array([p[1] for p in pairs], float), bias)


def scores(texts: list[str], weights: Weights, bits: int, seen: dict[bytes, int]) -> np.ndarray:
    """Probability of label 1 for each text."""
    dense = np.zeros(1 << bits, np.float32)
    dense[weights.features] = weights.values
    return _scores(texts, dense, weights.bias, bits, seen)


def _scores(texts: list[str], dense: np.ndarray, bias: float, bits: int, seen: dict[bytes, int]) -> np.ndarray:
    margin = np.full(len(texts), bias)
    words: list[bytes] = []
    counts: list[int] = []
    start = 0

    def settle() -> None:
        nonlocal words, counts, start
        docs = np.repeat(np.arange(len(counts)), counts)
        hashes = word_hashes(words, seen)
        found = []
        for f, d in features(hashes, docs, bits):
            weighed = np.flatnonzero(dense[f])
            found.append((d[weighed].astype(np.int64) << bits) | f[weighed])
        once = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        margin[start : start + len(counts)] += np.bincount(
            once >> bits, weights=dense[once & ((1 << bits) - 1)], minlength=len(counts)
        )
        start += len(counts)
        words, counts = [], []

    for text in texts:
        own = words_of(text)
        words += own
        counts.append(len(own))
        if len(words) >= SLICE:
            settle()
    if counts:
        settle()
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def _scored(weights: Weights, bits: int, text_at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batch without its text column (the last), and with the score."""
    dense = np.zeros(1 << bits, np.float32)
    dense[weights.features] = weights.values
    seen: dict[bytes, int] = {}
    for batch in batches:
        if len(seen) > 1_000_000:
            seen.clear()
        found = _scores(batch.column(text_at).to_pylist(), dense, weights.bias, bits, seen)
        kept = [batch.column(i) for i in range(text_at)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=[*batch.schema.names[:text_at], "score"])


def toxicity_scores(docs: DataFrame, weights: Weights, bits: int = BITS) -> DataFrame:
    """doc_id and score of every whole text; null and empty texts have the score of no feature."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", text_of().alias("text"))
    return narrow.mapInArrow(per_batch(_scored, weights, bits, 1), f"doc_id {kind}, score double")


def _kept(weights: Weights, bits: int, limit: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    dense = np.zeros(1 << bits, np.float32)
    dense[weights.features] = weights.values
    seen: dict[bytes, int] = {}
    for batch in batches:
        if len(seen) > 1_000_000:
            seen.clear()
        texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        yield batch.filter(pa.array(_scores(texts, dense, weights.bias, bits, seen) < limit))


def without_toxic(docs: DataFrame, weights: Weights, bits: int = BITS, limit: float = 0.5) -> DataFrame:
    """Whole rows of ``docs`` whose score is below ``limit``; texts are filtered where they lie."""
    return docs.mapInArrow(per_batch(_kept, weights, bits, limit), docs.schema)
