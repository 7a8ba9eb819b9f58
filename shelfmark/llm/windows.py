"""Substring deduplication: Rabin-Karp hashes of every window of ``length`` words.

Each task hashes its documents' words and all their windows, a polynomial in the word hashes that
is rolled in doubling steps with numpy.  Windows that repeat within a slice of a million words are
settled there: only the smallest doc_id of a window is dealt by its hash, so a passage in a third of
all documents reaches its reducer as one row per slice.  Spark then groups the windows by hash over the
whole corpus; all but the smallest document of a window are told to remove it.  Finally every
document marks its removed windows, merges them into maximal intervals, and drops their words.

Word and window hashes have 64 bits.  Exact copies of a text are found first, by a digest of the
whole text; they need no search, as all their windows start in the first of them. 
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, per_batch, text_of

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
NO_ID = -(1 << 63)  # stands for a null doc_id
SLICE = 1_000_000  # words hashed together


def word_hashes(words: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    """64-bit hash of each word; ``seen`` remembers them within a task."""
    digest = xxhash.xxh3_64_intdigest
    for w in set(words).difference(seen):
        seen[w] = digest(w)
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every ``length`` consecutive values, modulo 2**64, then mixed."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total, start = np.zeros(count, np.uint64), 0
    power, width, step = hashes, 1, BASE  # power: hashes of windows of ``width``, step: BASE**width
    rest = length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                total = total * step + power[start : start + count]
                start += width
            rest >>= 1
            if rest:
                power = power[:-width] * step + power[width:]
                step = step * step
                width *= 2
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    return total


def _slices(ids: list, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(doc_ids, word counts, all words) of consecutive documents, about SLICE words at a time."""
    own: list[int] = []
    counts: list[int] = []
    words: list[bytes] = []
    for doc_id, text in zip(ids, texts):
        found = text.encode("utf-8", "surrogatepass").split()  # splits at ASCII white space alone
        own.append(doc_id)
        counts.append(len(found))
        words += found
        if len(words) >= SLICE:
            yield np.array(own, np.int64), np.array(counts, np.int64), words
            own, counts, words = [], [], []
    if own:
        yield np.array(own, np.int64), np.array(counts, np.int64), words


def _starts(counts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which windows of the joined words lie in one document."""
    inside = np.repeat(np.cumsum(counts), counts) - np.arange(len(np.repeat(counts, counts))) >= length
    return inside[:total]


def _windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hash, doc_id, null) of the smallest document of each window of a slice, and one row
    (own key, doc_id, hashes) per other document: a smaller one in the slice has these windows.
    """
    seen: dict[bytes, int] = {}
    names = ["hash", "doc_id", "known"]
    for batch in batches:
        for ids, counts, words in _slices(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(seen) > 1_000_000:
                seen.clear()
            hashes = window_hashes(word_hashes(words, seen), length)
            inside = _starts(counts, length, len(hashes))
            docs, hashes = np.repeat(ids, counts)[: len(hashes)][inside], hashes[inside]
            order = np.lexsort((docs, hashes))
            hashes, docs = hashes[order].view(np.int64), docs[order]
            first = np.ones(len(hashes), bool)
            first[1:] = hashes[1:] != hashes[:-1]
            smallest = docs[np.maximum.accumulate(np.where(first, np.arange(len(docs)), 0))]
            again = docs != smallest
            # In the order of documents a partition's rows compress well.
            order = np.argsort(docs[first], kind="stable")
            fresh, owners = hashes[first][order], docs[first][order]
            nothing = pa.nulls(len(fresh), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(fresh), pa.array(owners), nothing], names=names)
            order = np.argsort(docs[again], kind="stable")
            known, owners = hashes[again][order], docs[again][order]
            each, starts = np.unique(owners, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(known)), pa.int32()), pa.array(known))
            yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(each), lists], names=names)


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, hashes) of the windows of each document whose words also start in a smaller doc_id.

    ``docs`` has (doc_id long, text string) without nulls.  All windows are dealt by hash once;
    counting them and finding the documents of the repeated ones read the same shuffle.
    """
    rows = docs.mapInArrow(per_batch(_windows, length), "hash long, doc_id long, known array<long>")
    # Both readers need the same columns and the same rows, so that one shuffle serves them.
    dealt = rows.where("hash IS NOT NULL AND doc_id IS NOT NULL").repartition("hash")
    fresh = F.when(F.col("known").isNull(), F.col("doc_id"))
    counted = dealt.groupBy("hash").agg(F.min(fresh).alias("smallest"), F.max(fresh).alias("largest"))
    repeated = counted.where("largest > smallest").select("hash", "smallest")
    later = dealt.join(repeated.hint("shuffle_hash"), "hash", "left").where(
        F.col("known").isNotNull() | (F.col("doc_id") > F.col("smallest"))
    )
    one = F.coalesce("known", F.array("hash"))
    return later.groupBy("doc_id").agg(F.flatten(F.collect_list(one)).alias("hashes"))


def removal_intervals(hashes: np.ndarray, repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal [start, end) in words that removed windows cover."""
    hit = np.flatnonzero(np.isin(hashes, repeated))
    if not len(hit):
        return []
    breaks = np.flatnonzero(np.diff(hit) > length)
    starts = hit[np.concatenate(([0], breaks + 1))]
    ends = hit[np.concatenate((breaks, [len(hit) - 1]))] + length
    return list(zip(starts.tolist(), ends.tolist()))


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>"


def _kept(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, int] = {}
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        if len(seen) > 1_000_000:
            seen.clear()
        out: list[tuple] = []
        texts, copies, found = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            words = texts[i].encode("utf-8", "surrogatepass").split()
            spans: list[tuple[int, int]] = []
            if copies[i]:
                spans = [(0, len(words))] if len(words) >= length else []
            elif found[i].is_valid:
                repeated = found[i].values.to_numpy(zero_copy_only=False)
                spans = removal_intervals(window_hashes(word_hashes(words, seen), length).view(np.int64), repeated, length)
            kept, at = [], 0
            for start, end in spans:
                kept += words[at:start]
                at = end
            kept += words[at:]
            marks = [{"start": a, "end": b} for a, b in spans]
            doc_id = None if doc_id == NO_ID else doc_id
            out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), marks))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), spans_type]
        columns = zip(*out) if out else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"]
        )


def exact_copies(rows: DataFrame) -> DataFrame:
    """(key, copy = true) of the documents whose whole text also belongs to a smaller key.

    Keys with several rows are left to the windows.
    """
    digests = cut(
        rows.select("key", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("digest"))
        .where("n = 1")
    )
    firsts = digests.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return cut(digests.join(firsts.select("digest", "first"), "digest").where("key > first").select("key", F.lit(True).alias("copy")))


def substring_dedup(docs: DataFrame, length: int = 50) -> DataFrame:
    """Remove every word in a window of ``length`` words that also starts in a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256 (kept words joined by a space) and the removed
    intervals in words, for every document.  Null texts have no words, and texts shorter than a
    window are kept.  doc_ids are unique; a null one counts as smaller than all others, and rows
    that share a doc_id are no reason to remove each other's windows.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("key"), text_of().alias("text"))
    copies = exact_copies(rows)
    # One shuffle of the texts serves both readers: what is searched and what is cut.
    dealt = rows.repartition("key")
    searched = dealt.join(copies, "key", "left").where(F.coalesce(~F.col("copy"), F.lit(True))).select(F.col("key").alias("doc_id"), "text")
    repeated = repeated_windows(searched, length).withColumnRenamed("doc_id", "key")
    joined = dealt.join(copies, "key", "left").join(repeated, "key", "left")
    return joined.select("key", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "hashes").mapInArrow(per_batch(_kept, length), KEPT)
