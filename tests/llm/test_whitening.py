import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import whitening
from shelfmark.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, rows string, x string"


def frame_of(spark, vectors, first=0):
    rows = [(i + first, None if v is None else [None if c is None else float(c) for c in v], "x", "y") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def integers(vectors):
    return np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000


def check(found, vectors, ids, top=8):
    """Everything the contract states, against a dense eigendecomposition."""
    x = integers(vectors)
    n, sums = len(x), [int(s) for s in x.sum(0)]
    centred = x - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    k = min(top, int((values > 1e-12 * values[0]).sum()))
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[1]))
    assert [r[:2] for r in rows] == [(i, c) for i in sorted(ids) for c in range(1, k + 1)]
    exact = {i: sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for i, row in zip(ids, x)}
    assert all(r[2] == n and r[3] == exact[r[0]] for r in rows)
    got = np.array([r[4] for r in rows]).reshape(-1, k)
    want = (centred @ vectors_[:, :k] / np.sqrt(values[:k]))[np.argsort(ids)]
    apart = values[:k] - values[1 : k + 1] if len(values) > k else np.append(-np.diff(values[:k]), 1)
    for c in range(k):
        near = min(apart[c], apart[c - 1] if c else np.inf) / values[0]
        if near > 1e-6:
            sign = np.sign(got[:, c] @ want[:, c])
            assert np.allclose(got[:, c] * sign, want[:, c], atol=1e-9 / near, rtol=0)
    spread = got - got.mean(0)
    error = np.abs(spread.T @ spread / n - np.eye(k)).max()
    assert error < 1e-8 and all(abs(r[6] - error) < 1e-8 for r in rows) and len({r[6] for r in rows}) == 1
    assert np.allclose(np.array([r[5] for r in rows]).reshape(-1, k), values[:k] / np.trace(covariance), rtol=1e-9)


@pytest.mark.parametrize("n,d,seed", [(400, 24, 1), (60, 9, 2), (5, 12, 3), (300, 5, 4)])
def test_against_a_dense_decomposition(spark, monkeypatch, n, d, seed):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1000)
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((n, d)) * np.geomspace(1, 0.05, d) + 3
    check(whitening.whiten(frame_of(spark, vectors).repartition(4)), vectors, list(range(n)))


def test_early_stop_in_many_dimensions(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((300, 200)) * np.geomspace(30, 0.01, 200)
    rows = whitening.pack(frame_of(spark, vectors))
    assert len(whitening.bidiagonalise(rows).alpha) < 60
    check(whitening.whiten(frame_of(spark, vectors)), vectors, list(range(300)))


def test_repeated_deviation_is_found(spark):
    """Axes of equal length: every Krylov space has one direction of them only."""
    for d in (6, 140):
        lengths = [8.0, 8.0, 8.0, 5.0, 5.0, 2.0] + [0.25] * (d - 6)
        vectors = [s * length * np.eye(d)[i] for i, length in enumerate(lengths) for s in (1, -1)]
        found = whitening.components(whitening.pack(frame_of(spark, vectors)), 6)
        assert np.allclose(found.eigenvalues, [(1024 * v) ** 2 * 2 / (2 * d) for v in lengths[:6]], rtol=1e-12)
        assert np.allclose(found.vectors.T @ found.vectors, np.eye(6), atol=1e-12)


def test_vectors_are_double_precision(spark, sf_dir):
    vectors = [r["embedding"] for r in table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL").collect()]
    x = integers(vectors)
    centred = x - x.mean(0)
    covariance = centred.T @ centred / len(x)
    found = whitening.components(whitening.pack(table(spark, sf_dir, "embeddings")))
    for v, e in zip(found.vectors.T, found.eigenvalues):
        assert np.linalg.norm(covariance @ v - e * v) < 1e-11 * found.eigenvalues[0] and abs(v @ v - 1) < 1e-13


def test_what_is_dropped(spark):
    good = [[0.5, 1.0], [0.25, -2.0], [0.0, 3.0], [1.0, 1.0]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [1.0, float("inf")], [1.0, float("-inf")], [1e30, 1.0], [1.0], [1.0, 2.0, 3.0]]
    docs = frame_of(spark, good).unionByName(frame_of(spark, bad, 100))
    check(whitening.whiten(docs), good, [0, 1, 2, 3])


def test_repeated_rows_and_null_ids(spark):
    docs = frame_of(spark, [[1.0, 2.0], [2.0, 5.0], [2.0, 5.0]]).withColumn("vec_id", F.when(F.col("vec_id") > 0, 1))
    found = whitening.whiten(docs).collect()
    assert len(found) == 3 * 1 and [r["vec_id"] for r in found].count(None) == 1 and {r["n"] for r in found} == {3}
    assert len({(r["vec_id"], r["whitened"]) for r in found}) == 2


def test_no_variance_and_no_rows(spark):
    assert whitening.whiten(frame_of(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whiten(frame_of(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(frame_of(spark, [None, []])).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deviation_stays_exact_or_null():
    x = np.array([[100_000, 2**40], [99_999, 0], [5, -(2**40)]])
    for count in (3, 10**6):
        sums = [int(s) * (count // 3) + 1 for s in x.sum(0)]
        exact = [sum((count * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, count, sums) == [e if e < 1 << 63 else None for e in exact]
    assert whitening.deviations(x // 2**30, 3, [4, 5]) == [sum((3 * int(v) - s) ** 2 for v, s in zip(r, (4, 5))) for r in x // 2**30]


def test_sums_beyond_64_bits(spark):
    huge = 2.0**50
    rows = whitening.pack(frame_of(spark, [[huge, 1.0]] * 3000))
    assert rows.sums[0] == 3000 * (2**60 + 100_000) and rows.count == 3000


def test_registered_query(spark, sf_dir):
    from shelfmark.llm import queries

    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    rows = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    check(queries.op11_lanczos_whitening(spark, sf_dir), [v for _, v in rows], [i for i, _ in rows])
