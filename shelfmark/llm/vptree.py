"""SimHash near-duplicates by a vantage-point tree over 64-bit fingerprints.

Distinct fingerprints are partitioned by their Hamming distance to vantage points: an inner child
has those nearer than a limit, an outer child the rest.  Two fingerprints within ``radius`` of each
other on different sides both lie within ``radius`` of the limit (triangle inequality), so one side
lends its boundary to the other and every pair meets in some leaf; a pair further apart than that
never needs to be compared across.  Leaves are shards that Spark groups.  In a leaf the same
pruning goes on in memory until blocks are small enough to compare directly.

The tree is fitted to a sample of bounded size; every fingerprint passes through it.  Leaves over a
size limit are dealt as pairs of blocks, so no task holds more than two blocks.  A leaf emits one
link per fingerprint of a group, not all pairs; groups are then joined by alternating large-star
and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, per_batch, text_of

SEED = 42
RADIUS = 3
SAMPLE = 65_536
# Smallest and largest size of a shard.  In a task the same pruning goes on in memory, so shards are
# as large as a task does quickly: smaller ones would only shuffle more lent points.
LEAF, LEAF_MOST = 32_768, 131_072
DIRECT = 512  # points compared pairwise

Node = tuple  # ("leaf", number) or (vantage, limit, lend_inner, inner, outer)


def simhash(text: str, words_per_shingle: int = 3) -> int:
    """64-bit fingerprint of a text as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII alone
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
    digests = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64)
    set_bits = np.unpackbits(digests.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(digests), bitorder="little").view("<u8")[0])


def _simhashes(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([simhash(t, words) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def simhashes(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every document, without a shuffle; fp is the signed form of the 64 bits."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(per_batch(_simhashes, words_per_shingle), "doc_id long, fp long")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def choose_split(points: np.ndarray, radius: int, tries: int = 6) -> tuple[np.uint64, int, bool, float]:
    """(vantage, limit, whether the inner side lends, share of pairs left) of the best split found."""
    best = (points[0], 0, True, 2.0)
    total = len(points)
    for vantage in points[np.linspace(0, total - 1, tries).astype(int)]:
        counts = np.bincount(_distance(points, vantage), minlength=65 + 2 * radius)
        below = np.concatenate(([0], np.cumsum(counts)))  # below[m]: points nearer than m
        for limit in range(1, 65):
            inner = below[limit]
            if not 0 < inner < total:
                continue
            lent_out = inner - below[max(0, limit - radius)]
            lent_in = below[limit + radius] - inner
            for lend_inner, size_in, size_out in ((True, inner, total - inner + lent_out), (False, inner + lent_in, total - inner)):
                left = (float(size_in) ** 2 + float(size_out) ** 2) / float(total) ** 2
                if left < best[3]:
                    best = (vantage, limit, lend_inner, left)
    return best


def sides(points: np.ndarray, vantage: np.uint64, limit: int, lend_inner: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the inner and the outer side, the lent boundary in both."""
    distance = _distance(points, vantage)
    if lend_inner:
        return distance < limit, distance >= limit - radius
    return distance < limit + radius, distance >= limit


def build_tree(sample: np.ndarray, leaf: int, radius: int) -> tuple[Node, int]:
    """A tree whose leaves hold about ``leaf`` points of the sample, and its number of leaves."""
    leaves = 0

    def grow(points: np.ndarray, depth: int) -> Node:
        nonlocal leaves
        if len(points) > max(leaf, 8) and depth < 40:
            vantage, limit, lend_inner, left = choose_split(points, radius)
            if left < 0.9:
                inner, outer = sides(points, vantage, limit, lend_inner, radius)
                return (vantage, limit, lend_inner, grow(points[inner], depth + 1), grow(points[outer], depth + 1))
        leaves += 1
        return ("leaf", leaves - 1)

    return grow(sample, 0), leaves


def route(node: Node, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, its points) for every leaf that some of ``points`` reach."""
    if not len(points):
        return
    if isinstance(node[0], str):
        yield node[1], points
        return
    vantage, limit, lend_inner, inner, outer = node
    to_inner, to_outer = sides(points, vantage, limit, lend_inner, radius)
    yield from route(inner, points[to_inner], radius)
    yield from route(outer, points[to_outer], radius)


def _routed(tree: Node, radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for leaf, own in route(tree, points, radius):
            numbers = pa.array(np.full(len(own), leaf, np.int32))
            yield pa.RecordBatch.from_arrays([numbers, pa.array(own.view(np.int64))], names=["leaf", "fp"])


def leaders(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``count`` points is connected with through links (a, b)."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def links_within(points: np.ndarray, radius: int, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) whose groups are those of all pairs of ``points`` within ``radius``."""
    if len(points) > DIRECT and depth < 60:
        vantage, limit, lend_inner, left = choose_split(points, radius, 3)
        if left < 0.9:
            inner, outer = sides(points, vantage, limit, lend_inner, radius)
            parts = [links_within(points[m], radius, depth + 1) for m in (inner, outer)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    found_a, found_b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    step = max(1, 4_000_000 // max(1, len(points)))
    for at in range(0, len(points), step):
        near = np.bitwise_count(points[at : at + step, None] ^ points[None, at:]) <= radius
        rows, columns = np.nonzero(near)
        rows, columns = rows[columns > rows], columns[columns > rows]
        # Of a point's many neighbours in this strip, a spanning set of links is enough.
        label = leaders(len(points) - at, rows, columns)
        linked = np.flatnonzero(label != np.arange(len(label)))
        found_a.append(points[at + linked])
        found_b.append(points[at + label[linked]])
    return np.concatenate(found_a), np.concatenate(found_b)


def _leaf_links(radius: int, group: pd.DataFrame) -> pd.DataFrame:
    points = np.unique(group["fp"].to_numpy(np.int64).view(np.uint64))
    a, b = links_within(points, radius)
    if len(a):
        places = leaders(len(points), np.searchsorted(points, a), np.searchsorted(points, b))
        linked = np.flatnonzero(places != np.arange(len(points)))
        a, b = points[linked], points[places[linked]]
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def near_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct values of ``fp``: their groups are those of all near pairs."""
    spark = fingerprints.sparkSession
    count = fingerprints.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaf = min(LEAF_MOST, max(LEAF, count // (2 * partitions)))
    rows = fingerprints.orderBy(F.xxhash64("fp")).limit(SAMPLE).select("fp").collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    tree, _ = build_tree(sample, int(leaf * len(sample) / max(1, count)), radius)
    routed = fingerprints.select("fp").mapInArrow(per_batch(_routed, tree, radius), "leaf int, fp long")
    routed = cut(routed)
    # One count per leaf, and the tree has at most as many leaves as the sample has points.
    most = 4 * leaf
    large = {r["leaf"]: -(-r["count"] // most) for r in routed.groupBy("leaf").count().where(F.col("count") > most).collect()}
    blocks = spark.createDataFrame(list(large.items()) or [(-1, 1)], "leaf int, blocks int")
    dealt = routed.join(F.broadcast(blocks), "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = dealt.withColumn("own", own).withColumn("other", other)
    keyed = paired.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")

    def leaf_links(group: pd.DataFrame) -> pd.DataFrame:
        return _leaf_links(radius, group)

    return keyed.groupBy("leaf", "i", "j").applyInPandas(leaf_links, "a long, b long")


def connected(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): the smallest node it is connected with.

    Alternates large-star and small-star until nothing changes; a round aggregates and joins links
    by node, so no group is gathered.  Only one row of figures per round reaches the driver.
    """
    links = cut(links.where("a <> b").distinct())
    figures = None
    for _ in range(most_rounds):
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("low"))
        kept = down.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = cut(kept.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == figures:
            break
        figures = now
    else:
        raise RuntimeError("links did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed), component_id: the smallest doc_id reachable over links of fingerprints.

    Fingerprints link if at most ``radius`` bits differ.  Null and empty texts have fingerprint 0
    and link like any other.  A null doc_id keeps its row but is nobody's component.
    """
    prints = cut(simhashes(docs, words_per_shingle))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut(connected(near_links(distinct, radius)))
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = grouped.join(smallest, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = 3) -> DataFrame:
    """Whole rows of ``docs`` with one document of each group, the one with the smallest doc_id.

    Rows without a doc_id cannot be told apart and all stay; of rows that share one, one stays.
    """
    found = near_duplicates(docs, radius, words_per_shingle)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.where("doc_id IS NOT NULL")
    chosen = named.join(kept, named["doc_id"].cast("long") == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(docs.where("doc_id IS NULL"))
