import random

import numpy as np
import xxhash
from corpus import edges, frame, nothing, prose
from pyspark.sql import functions as F

from shelfmark.llm import vptree


def plain_simhash(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(points, radius):
    """Smallest index each point is connected with."""
    label = list(range(len(points)))
    for a in range(len(points)):
        for b in range(a):
            if (points[a] ^ points[b]).bit_count() <= radius:
                x, y = label[a], label[b]
                if x != y:
                    low, high = min(x, y), max(x, y)
                    label = [low if v == high else v for v in label]
    return label


def cloud(seed, count):
    """Random points, pairs at growing distance, and a dense group."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(count)]
    for p in points[: count // 3]:
        points.append(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    for _ in range(count // 3):
        points.append(points[0] ^ sum(1 << b for b in rng.sample(range(12), 3)))
    return sorted(set(points))


def test_spark_has_the_same_shingle_hash(spark):
    found = spark.range(1).select(F.xxhash64(F.lit("a b é")).alias("h")).first()["h"]
    assert found & ((1 << 64) - 1) == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_against_brute_force(spark):
    rows = prose(150, 11) + [(1000, ""), (1001, ""), (1002, "One two")]
    rows.sort()
    prints = [plain_simhash(t) for _, t in rows]
    label = components(prints, 3)
    assert len(set(label)) < len(rows) - 20
    found = {r["doc_id"]: r for r in vptree.near_duplicates(frame(spark, rows)).collect()}
    for (doc_id, _), fp, low in zip(rows, prints, label):
        assert found[doc_id]["fp"] & ((1 << 64) - 1) == fp
        assert found[doc_id]["component_id"] == rows[low][0]
    kept = sorted(r["doc_id"] for r in vptree.without_near_duplicates(frame(spark, rows)).collect())
    assert len(kept) == len({x["component_id"] for x in vptree.near_duplicates(frame(spark, rows), words_per_shingle=3).collect()})


def test_links_in_memory_and_through_the_tree(monkeypatch):
    monkeypatch.setattr(vptree, "DIRECT", 20)
    for seed in range(4):
        points = np.array(cloud(seed, 300), np.uint64)
        expected = np.array(components([int(p) for p in points], 3))
        a, b = vptree.links_within(points, 3)
        assert np.array_equal(vptree.leaders(len(points), np.searchsorted(points, a), np.searchsorted(points, b)), expected)
        tree, leaves = vptree.build_tree(points, 30, 3)
        assert leaves > 4
        links = [vptree.links_within(own, 3) for _, own in vptree.route(tree, points, 3)]
        a, b = (np.searchsorted(points, np.concatenate([x[i] for x in links])) for i in (0, 1))
        assert np.array_equal(vptree.leaders(len(points), a, b), expected)


def test_shards_and_blocks_lose_no_group(spark, monkeypatch):
    """Small leaves, and leaves dealt as pairs of blocks."""
    points = np.array(cloud(9, 400), np.uint64)
    expected = components([int(p) for p in points], 3)
    frame_ = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    for leaf, most in ((40, 65536), (1, 10)):
        monkeypatch.setattr(vptree, "LEAF", leaf)
        monkeypatch.setattr(vptree, "LEAF_MOST", most)
        roots = {r["node"]: r["root"] for r in vptree.connected(vptree.near_links(frame_)).collect()}
        groups = {}
        for p, low in zip(points.view(np.int64).tolist(), expected):
            groups.setdefault(low, set()).add(roots.get(p, p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_connected_on_a_long_chain(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(59)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in vptree.connected(links).collect()}
    assert {found[i] for i in range(60)} == {0} and found[100] == found[101] == 100


def test_edges(spark):
    found = vptree.near_duplicates(edges(spark)).collect()
    assert len(found) == edges(spark).count()
    by_id = {r["doc_id"]: r["component_id"] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[5] == by_id[7] == 5
    kept = vptree.without_near_duplicates(edges(spark))
    assert kept.columns == edges(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-8, 1, 4, 5, 6] and ids.count(None) == 2
    assert vptree.near_duplicates(nothing(spark)).count() == 0
    assert vptree.without_near_duplicates(nothing(spark)).count() == 0
