import random
import zlib

import numpy as np
import pytest
from corpus import edges, nothing, prose

from shelfmark.llm import toxicity
from shelfmark.llm.common import table
from shelfmark.llm.queries import QUERIES


def test_ftrl_is_the_update_rule():
    """Against the rule written per coordinate."""
    rng = random.Random(1)
    rows = [np.array(sorted(rng.sample(range(16), 4)), np.int32) for _ in range(60)]
    labels = np.array([float(3 in r) for r in rows])
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - (1 if z[i] > 0 else -1) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for row, y in zip(rows, labels):
            own = [*row.tolist(), 16]
            p = 1 / (1 + np.exp(-sum(weight(i) for i in own)))
            g = (p - y) * (toxicity.POSITIVE if y else 1.0)
            for i, w in [(i, weight(i)) for i in own]:
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - s * w
                n[i] += g * g
    found = toxicity.ftrl(rows, labels, 4, 3)
    assert dict(zip(found.features.tolist(), found.values.tolist())) == pytest.approx({i: weight(i) for i in range(16) if weight(i)})
    assert found.bias == pytest.approx(weight(16))


def test_features_are_words_pairs_and_skips():
    seen = {}
    three = toxicity.document_features("Some, words here", seen, 20)
    assert len(three) == 3 + 2 + 1
    assert set(toxicity.document_features("some words", seen, 20)) <= set(three)
    assert len(toxicity.document_features("", seen, 20)) == 0


def test_scores_follow_the_weights():
    seen, rng = {}, random.Random(2)
    texts = [t for _, t in prose(40, 4)] + ["", "one"]
    weights = toxicity.Weights(np.arange(0, 1 << 12, 3, dtype=np.int32), np.array([rng.uniform(-1, 1) for _ in range(0, 1 << 12, 3)]), 0.3)
    dense = dict(zip(weights.features.tolist(), weights.values.tolist()))
    expected = [1 / (1 + np.exp(-0.3 - sum(dense.get(f, 0.0) for f in toxicity.document_features(t, seen, 12).tolist()))) for t in texts]
    assert toxicity.scores(texts, weights, 12, seen) == pytest.approx(expected, abs=1e-4)


def test_held_out_accuracy(spark):
    """Documents that no weight was learned from."""
    folder = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op6_ftrl_toxicity"](spark, folder).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    labels = [(rows[r["doc_id"]], r["toxic"]) for r in table(spark, folder, "labels").collect()]
    pos = [r["score"] for r, y in labels if r["held_out"] and y]
    neg = [r["score"] for r, y in labels if r["held_out"] and not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc > 0.95
    assert sum(q >= 0.5 for q in neg) <= 0.02 * len(neg)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int")
    weights = toxicity.train(edges(spark), labels)
    assert toxicity.toxicity_scores(edges(spark), weights).count() == edges(spark).count()
    kept = toxicity.without_toxic(edges(spark), weights)
    assert kept.columns == edges(spark).columns
    kept.count()
    assert toxicity.toxicity_scores(nothing(spark), weights).count() == 0
    empty = toxicity.train(nothing(spark), labels)
    assert {r["score"] for r in toxicity.toxicity_scores(edges(spark), empty).collect()} == {0.5}
    assert toxicity.train(edges(spark), labels.limit(0)).bias == 0.0
