"""Embedding whitening by polarisation: covariances from variances of dimensions and of their sums.

For two dimensions i and j, 2 cov(i, j) = var(i + j) - var(i) - var(j). So squares are all that is
gathered: of every dimension and of the sum of every pair of dimensions. Entries are integers and
are centred without division, as n times the entry minus the dimension's sum; their squares are
added up in integers of any size, so neither large offsets nor the order of rows cost a digit. The
matrix that the differences form has a row per dimension and is taken apart by ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import bounded_batches, stage

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
_ROWS = 1024  # taken up together: the products of two limbs then add up within 63 bits
_LIMB = 26
_HALF = 1 << 60  # sums travel as high and low part, so that none exceeds a decimal's digits
_LEAST = 1e-13  # of the largest variance: what lies below is rounding, not a component


@dataclass
class Whitening:
    """``n`` rows with sums ``totals``; components in columns, their variances, and all variance."""

    n: int
    totals: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """Not NULL, not empty, and without NULL or non-finite entries."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & (F.size(vector) > 0), F.lit(False))


def integers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The batch's vectors as rows of integers."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * float(SCALE)) + OFFSET
    if len(scaled) and np.abs(scaled).max() >= 1 << 52:
        raise ValueError("an entry of an embedding is too large for exact integers")
    return scaled.astype(np.int64).reshape(-1, size)


def square_sums(values: np.ndarray) -> np.ndarray:
    """Exact sums of squares of each column, as Python integers; at most 1024 rows at a time."""
    limbs, rest = [], values
    while len(rest) and np.abs(rest).max() >= 1 << _LIMB:
        limbs.append(rest & ((1 << _LIMB) - 1))
        rest = rest >> _LIMB
    limbs.append(rest)
    total = np.zeros(values.shape[1], dtype=object)
    for a, left in enumerate(limbs):
        for b in range(a, len(limbs)):
            product = np.einsum("ij,ij->j", left, limbs[b]).astype(object)
            total += product * ((1 if a == b else 2) << (_LIMB * (a + b)))
    return total


def centred(rows: np.ndarray, n: int, totals: np.ndarray) -> np.ndarray:
    """n times each entry minus the dimension's sum."""
    if len(rows) and int(np.abs(rows).max()) * n >= 1 << 61:
        raise ValueError("too many rows for centred entries of 63 bits")
    return rows * n - totals


def _portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, integers(part, size)


def _parts(numbers: list[int]) -> list[pa.Array]:
    kind = pa.decimal128(38, 0)
    return [pa.array([x // _HALF for x in numbers], kind), pa.array([x % _HALF for x in numbers], kind)]


def _gathered(found: DataFrame, *keys: str) -> list:
    """One row per key with the exact ``total`` of all tasks' parts, on the driver."""
    rows = found.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).collect()
    return [(*(r[k] for k in keys), int(r["high"]) * _HALF + int(r["low"]), int(r["n"])) for r in rows]


def dimension_sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of each dimension; every task sends one row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, np.zeros(size, dtype=object)
        for _, rows in _portions(batches, size):
            n += len(rows)
            totals += rows.sum(axis=0).astype(object)
        if n:
            columns = [pa.array(range(size), pa.int32()), *_parts(totals.tolist()), pa.array([n] * size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["i", "high", "low", "n"])

    found = _gathered(vectors.select("vector").mapInArrow(run, "i int, high decimal(38,0), low decimal(38,0), n long"), "i")
    totals = [0] * size
    for i, total, _ in found:
        totals[i] = total
    return (found[0][2] if found else 0), totals


def squares(vectors: DataFrame, size: int, n: int, totals: list[int]) -> dict[tuple[int, int], int]:
    """Sum of squares of each centred dimension (i, i), and of each sum of two (i, j).

    A task adds up its own rows and sends one row per pair; the pairs are as many as dimensions
    allow, whatever the number of vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, any_rows = [np.zeros(size - i, dtype=object) for i in range(size)], False
        shift = np.array(totals, dtype=np.int64)
        for _, rows in _portions(batches, size):
            any_rows = True
            own = centred(rows, n, shift)
            for i in range(size):
                together = own[:, i:] + own[:, i : i + 1]
                together[:, 0] = own[:, i]
                sums[i] += square_sums(together)
        if any_rows:
            left = [i for i in range(size) for _ in range(i, size)]
            right = [j for i in range(size) for j in range(i, size)]
            columns = [pa.array(left, pa.int32()), pa.array(right, pa.int32()), *_parts(np.concatenate(sums).tolist())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([1] * len(left), pa.int64())], ["i", "j", "high", "low", "n"])

    parts = vectors.select("vector").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0), n long")
    return {(i, j): total for i, j, total, _ in _gathered(parts, "i", "j")}


def covariance(found: dict[tuple[int, int], int], size: int, n: int) -> np.ndarray:
    """The covariance matrix, each entry rounded once from its exact value."""
    out = np.zeros((size, size))
    for (i, j), total in found.items():
        exact = Fraction(total, n**3) if i == j else Fraction(total - found[i, i] - found[j, j], 2 * n**3)
        out[i, j] = out[j, i] = float(exact)
    return out


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """Learn the whitening from all rows of ``vectors`` (column ``vector``, all of one length)."""
    n, totals = dimension_sums(vectors, size)
    if not n:
        return Whitening(0, totals, np.zeros((size, 0)), np.zeros(0), 0.0)
    matrix = covariance(squares(vectors, size, n, totals), size, n)
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > max(values[0], 0) * _LEAST
    values, axes = values[kept], axes[:, kept]
    # Of the two signs, the one that makes the largest entry positive.
    largest = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return Whitening(n, totals, axes * np.sign(largest), values, float(np.trace(matrix)))


def _projected(model: Whitening, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.array(model.totals, dtype=np.int64)
        for part, rows in _portions(batches, size):
            own = centred(rows, model.n, shift)
            deviation = pa.array(square_sums_of_rows(own), pa.decimal128(38, 0))
            white = (own / float(model.n)) @ model.components / np.sqrt(model.variances)
            values = pa.array(list(white), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), deviation, values], ["vec_id", "deviation", "whitened"])

    return run


def square_sums_of_rows(values: np.ndarray) -> list[int]:
    """Exact sum of squares of each row; in portions, so that long vectors stay exact, too."""
    wide = values.T
    return sum(square_sums(wide[start : start + _ROWS]) for start in range(0, len(wide), _ROWS)).tolist()


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector: vec_id, n, deviation, ``whitened`` and ``explained`` (arrays), identity_error.

    Entries c become floor(1024 c) + 100000. ``deviation`` is the exact sum over dimensions of
    (n x - S)^2, ``whitened`` the projections on the first components, each of variance 1,
    ``explained`` each component's share of all variance, and ``identity_error`` the largest
    difference between the covariance of ``whitened`` and the identity.

    All usable vectors are fitted, repeated rows as often as they occur. Rows whose vector is NULL,
    empty, of another length than most (of equally frequent ones the shorter counts) or holds NULL
    or non-finite entries are left out; a NULL id stays NULL. Directions without variance are no
    components, so equal vectors or a single one give empty arrays and an error of 0. An empty table
    gives no rows. Other columns are not read. Entries beyond 2**42 raise.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector")))
    top = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    size = top["d"] if top else 1
    rows = rows.filter(F.size("vector") == size)
    model = fit(rows, size, components)
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    white = stage(rows.mapInArrow(_projected(model, size), schema), "whitened")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.variances]).cast("array<double>")
    return white.select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(identity_error(white, len(model.variances))).alias("identity_error"),
    )


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of column ``whitened`` minus the identity."""
    if not components:
        return 0.0
    value = lambda i: F.col("whitened")[i]
    means = white.agg(*[F.avg(value(i)).alias(f"m{i}") for i in range(components)]).first()
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    product = lambda i, j: (value(i) - means[i]) * (value(j) - means[j])
    found = white.agg(*[F.avg(product(i, j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))
