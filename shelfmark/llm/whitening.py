"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, so sums and deviations are exact.  The centred rows X stay distributed as
packed blocks.  A step multiplies them with the newest right vector, p = X v - beta u, and with the
result of that, X'p, in one pass: a task holds p only block by block.  Earlier left vectors are not
stored either; u = X w for a short vector w that the recurrence yields, so a task computes its part
of them again to take the inner products that p must be freed of.  Right vectors live on the
driver and are orthogonalised against all earlier ones twice.  A step's figures are one number per
dimension and per earlier step, summed by Spark.

The singular values of the small bidiagonal matrix are the deviations, its right singular vectors
give the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import per_batch
from shelfmark.session import scratch_path

SCALE, SHIFT = 1024, 100_000
TOP = 8
BLOCK_BYTES = 4 << 20
WHOLE = 128  # up to so many dimensions the bidiagonalisation runs to its end
SETTLED = 1e-14  # residual of a component, relative to the largest deviation
GONE = 1e-12  # relative size under which a vector or a deviation counts as zero
LARGEST = 2.0**52  # entries beyond have no exact integer

# ---------------------------------------------------------------- blocks of integer rows


def valid_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that count.

    Dropped: null vectors, vectors with a null, non-finite or huge entry (2**52 and beyond), and
    vectors without the commonest length (of equally common ones the largest; empty ones never count).
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound)
    length = F.size("embedding").alias("length")
    commonest = rows.groupBy(length).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("embedding") == (commonest["length"] if commonest else 0))


BLOCKS = "rows long, ids binary, nulls binary, wide boolean, x binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, vectors = batch.column(0), batch.column(1)
        x = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, -1).astype(np.int64) + SHIFT
        step = max(1, BLOCK_BYTES // (8 * x.shape[1]))
        for at in range(0, len(x), step):
            own, some = ids[at : at + step], x[at : at + step]
            wide = bool(np.abs(some).max() >= 1 << 31)
            row = (
                len(some),
                own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                own.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                wide,
                some.astype("<i8" if wide else "<i4").tobytes(),
            )
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary())
            names = [c.split(" ")[0] for c in BLOCKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _integers(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The integer rows of each block of a batch."""
    for rows, wide, x in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("rows", "wide", "x"))):
        yield np.frombuffer(x, "<i8" if wide else "<i4").reshape(rows, -1).astype(np.int64)


class Rows(NamedTuple):
    """The packed rows of a table, their number, exact sums, and centre."""

    blocks: DataFrame
    count: int
    sums: list[int]

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.count for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        """What the mean has beyond ``floors``, at most 1, as a double."""
        return np.array([(s % self.count) / self.count for s in self.sums])


def _dimension_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    high = low = None
    rows = 0
    for batch in batches:
        for x in _integers(batch):
            rows += len(x)
            top, rest = (x >> 31).sum(0), (x & ((1 << 31) - 1)).sum(0)
            high, low = (top, rest) if high is None else (high + top, low + rest)
    if high is not None:
        columns = [pa.array(np.arange(len(high))), pa.array(high), pa.array(low), pa.array(np.full(len(high), rows))]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "high", "low", "rows"])


def pack(embeddings: DataFrame) -> Rows:
    """The valid rows as integer blocks in the shared folder."""
    spark = embeddings.sparkSession
    path = scratch_path(spark, "vectors")
    valid_rows(embeddings).mapInArrow(_packed, BLOCKS).write.parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "rows")]
    parts = blocks.select("rows", "wide", "x").mapInArrow(_dimension_sums, "at long, high long, low long, rows long")
    found = parts.groupBy("at").agg(*wide).orderBy("at").collect()
    return Rows(blocks, int(found[0]["rows"]) if found else 0, [(int(r["high"]) << 31) + int(r["low"]) for r in found])


# ---------------------------------------------------------------- products with the centred rows


def _centred(x: np.ndarray, floors: np.ndarray, rests: np.ndarray) -> np.ndarray:
    return (x - floors) - rests


def _totals(measure: Callable, floors, rests, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in _integers(batch):
            own = measure(_centred(x, floors, rests))
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])


def total(rows: Rows, measure: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """Sum over all blocks of ``measure`` (centred block -> vector of ``length`` doubles)."""
    parts = rows.blocks.select("rows", "wide", "x").mapInArrow(per_batch(_totals, measure, rows.floors, rows.rests), "at long, value double")
    out = np.zeros(length)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out


def _product(v: np.ndarray, back: np.ndarray, earlier: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """X'p, U'p, p'p and the trace for p = X v - X back, where U = X earlier."""

    def measure(x: np.ndarray) -> np.ndarray:
        p = x @ v - x @ back
        return np.concatenate((x.T @ p, (x @ earlier).T @ p, [p @ p, np.einsum("ij,ij->", x, x)]))

    return measure


class Bidiagonal(NamedTuple):
    right: np.ndarray  # columns: right vectors
    alpha: list[float]  # diagonal
    beta: list[float]  # above it; the last one is the coupling to the next right vector
    trace: float  # sum of squares of the centred rows


def _fresh(random: np.random.Generator, basis: np.ndarray) -> np.ndarray:
    """A random unit vector orthogonal to the columns of ``basis``."""
    v = random.standard_normal(len(basis))
    for _ in range(3):
        v -= basis @ (basis.T @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalise(rows: Rows, top: int = TOP, to_the_end: bool = False, avoid: np.ndarray | None = None, most: int | None = None) -> Bidiagonal:
    """Golub-Kahan-Lanczos with full reorthogonalisation of right and left vectors.

    Runs until the ``top`` leading components have settled, or to the end: always for up to 128
    dimensions.  Where a vector vanishes, a space is complete, and a fresh random vector goes on,
    so repeated singular values are found.  ``avoid`` holds right vectors to stay orthogonal to.
    """
    d = len(rows.sums)
    avoid = np.empty((d, 0)) if avoid is None else avoid
    most = min(most or d, d - avoid.shape[1])
    random = np.random.default_rng(7)
    right, weights, images = np.empty((d, 0)), np.empty((d, 0)), np.empty((d, 0))
    alpha: list[float] = []
    beta: list[float] = []
    v = _fresh(random, avoid)
    back, coupling, trace = np.zeros(d), 0.0, 0.0
    while len(alpha) < most:
        k = len(alpha)
        found = total(rows, _product(v, coupling * back, weights), d + k + 2)
        image, inner, square, trace = found[:d], found[d : d + k], found[d + k], found[d + k + 1]
        # Free p of the earlier left vectors: u = p - U (U'p), in terms of X: weights and images.
        weight = v - coupling * back - weights @ inner
        image = image - images @ inner
        length = np.sqrt(max(0.0, square - inner @ inner))
        right = np.column_stack((right, v))
        gone = length <= GONE * max([*alpha, *beta, np.sqrt(trace / d), 1e-300])
        back, image = (np.zeros(d), np.zeros(d)) if gone else (weight / length, image / length)
        weights, images = np.column_stack((weights, back)), np.column_stack((images, image))
        alpha.append(0.0 if gone else float(length))
        known = np.column_stack((avoid, right))
        rest = image - alpha[-1] * v
        for _ in range(2):
            rest -= known @ (known.T @ rest)
        coupling = float(np.linalg.norm(rest))
        if gone or coupling <= GONE * max(alpha):
            coupling = 0.0
        beta.append(coupling)
        if len(alpha) >= most:
            break
        if d > WHOLE and not to_the_end and len(alpha) > top:
            left, values, _ = np.linalg.svd(bidiagonal_matrix(alpha, beta))
            if (coupling * np.abs(left[-1, :top]) <= SETTLED * values[0]).all():
                break
        v = rest / coupling if coupling else _fresh(random, known)
    return Bidiagonal(right, alpha, beta, float(trace))


def bidiagonal_matrix(alpha: list[float], beta: list[float]) -> np.ndarray:
    return np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1)


class Components(NamedTuple):
    vectors: np.ndarray  # columns: unit eigenvectors of the covariance, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray  # share of the trace


def components(rows: Rows, top: int = TOP) -> Components:
    """Up to ``top`` leading components; those without deviation are left out.

    If the bidiagonalisation stopped early, a second one, kept orthogonal to all its vectors, looks
    for a deviation it cannot see, one that occurs twice; if there is such a one, it runs to the end.
    """
    if not rows.count:
        return Components(np.empty((0, 0)), np.empty(0), np.empty(0))
    found = bidiagonalise(rows, top)
    size = len(found.alpha)
    if size < len(rows.sums):
        _, values, _ = np.linalg.svd(bidiagonal_matrix(found.alpha, found.beta))
        other = bidiagonalise(rows, 1, avoid=found.right, most=16)
        if np.linalg.svd(bidiagonal_matrix(other.alpha, other.beta))[1][0] >= values[top - 1] * (1 - 1e-9):
            found = bidiagonalise(rows, top, to_the_end=True)
    _, values, turned = np.linalg.svd(bidiagonal_matrix(found.alpha, found.beta))
    kept = [i for i in range(min(top, len(values))) if values[i] > max(GONE * values[0], 0.0)]
    vectors = found.right @ turned.T[:, kept]
    eigenvalues = values[kept] ** 2 / rows.count
    return Components(vectors, eigenvalues, eigenvalues / (found.trace / rows.count))


# ---------------------------------------------------------------- results


def _moments(projection: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def measure(x: np.ndarray) -> np.ndarray:
        w = x @ projection
        return np.concatenate((w.sum(0), (w.T @ w).ravel()))

    return measure


def identity_error(rows: Rows, projection: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = projection.shape[1]
    found = total(rows, _moments(projection), k + k * k) / rows.count
    mean = found[:k]
    covariance = found[k:].reshape(k, k) - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, count: int, sums: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (count x - sum)^2, exact; None beyond 64 bits."""
    floors = np.array([s // count for s in sums], np.int64)
    rests = np.array([s % count for s in sums], np.int64)
    near = x - floors
    largest = float(count) * (float(np.abs(near).max(initial=0)) + 1.0)
    if largest * largest * x.shape[1] < 2.0**62:
        apart = count * near - rests
        return (apart * apart).sum(1).tolist()
    exact = [sum((count * int(v) - int(r)) ** 2 for v, r in zip(row, rests)) for row in near]
    return [e if e < 1 << 63 else None for e in exact]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whiten(count, sums, floors, rests, projection, explained, error, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = projection.shape[1]
    for batch in batches:
        ids, nulls = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for own, null, x in zip(ids, nulls, _integers(batch)):
            m = len(x)
            keys = pa.array(np.frombuffer(own, "<i8"), mask=np.frombuffer(null, np.uint8).astype(bool))
            columns = [
                keys.take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, count)),
                pa.array(deviations(x, count, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array((_centred(x, floors, rests) @ projection).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in WHITENED.split(", ")])


def whiten(embeddings: DataFrame, top: int = TOP) -> DataFrame:
    """One row per valid vector and component: its whitened coordinate and what is exact about it.

    Vectors that ``valid_rows`` leaves out have no row.  Repeated rows count and return as often as
    they occur, with a null vec_id too.  If the rows vary in fewer than ``top`` directions, there are
    only so many components; equal rows or a single one give none, and no rows give no rows.
    ``deviation`` is null where it needs more than 64 bits.
    """
    rows = pack(embeddings)
    spark: SparkSession = embeddings.sparkSession
    found = components(rows, top)
    if not len(found.eigenvalues):
        return spark.createDataFrame([], WHITENED)
    projection = found.vectors / np.sqrt(found.eigenvalues)
    error = identity_error(rows, projection)
    function = per_batch(_whiten, rows.count, rows.sums, rows.floors, rows.rests, projection, found.explained, error)
    return rows.blocks.mapInArrow(function, WHITENED)
