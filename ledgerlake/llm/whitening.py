"""Whitening of embeddings: the leading components of their covariance by contour integration, each scaled to variance one.

Vectors are put on a grid of whole numbers, so that sums and second moments are exact whatever the order in which tasks
add them up. The covariance, of a size that hangs on the dimension alone, is taken apart by FEAST: the inertia of shifted
matrices counts the eigenvalues above a bound and cuts the wanted ones into intervals at their widest gaps; for each
interval, a quadrature around it of complex shifted solves projects a few directions onto its eigenvectors, which
a Rayleigh-Ritz step extracts. An interval is done when as many are found as inertia counts, none missed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship, written

#: Steps of the grid to a unit, and its shift.
SCALE, SHIFT = 64, 1_000_000
#: Points of the quadrature on the upper half of a contour; rounds of an interval; eigenvalues of an interval; residual.
POINTS, ROUNDS, INTERVAL, TOLERANCE = 8, 60, 8, 1e-13
#: Share of the matrix's norm up to which an eigenvalue is none.
ZERO = 1e-12
#: Counts of eigenvalues among which a cut takes the one at the widest gap.
CHOICE = 4
#: Rows that are multiplied at a time.
ROWS = 1024


# ---- eigenvectors of one matrix -------------------------------------------------------------------------------------


class Inertia:
    """Counts the eigenvalues of a symmetric matrix above a shift, the positive part of the shifted matrix's inertia.

    Reflections make the matrix tridiagonal once; a shifted one is then reduced by
    pivots of one row, whose signs are counted.
    """

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, dtype=float)
        for k in range(len(a) - 2):
            v = a[k + 1 :, k].copy()
            v[0] += math.copysign(np.linalg.norm(v), v[0])
            if size := np.linalg.norm(v):
                v /= size
                a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
                a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        self.diagonal, beside = np.diag(a).tolist(), np.diag(a, 1)
        self.squares = [0.0, *(beside * beside).tolist()]
        self.tiny = np.finfo(float).eps * (max(map(abs, self.diagonal), default=0.0) + float(np.abs(beside).max(initial=0.0))) ** 2 * 1e-16

    def above(self, shift: float) -> int:
        positive, pivot = 0, 1.0
        for d, square in zip(self.diagonal, self.squares):
            pivot = d - shift - square / pivot
            if abs(pivot) <= self.tiny:
                pivot = -(self.tiny or 1e-300)  # an eigenvalue equal to the shift is not above it
            positive += pivot > 0
        return positive


def _gap(inertia: Inertia, low: float, high: float, wanted: int) -> tuple[float, float]:
    """Ends of a gap in (low, high) with `wanted` eigenvalues above it, or more if those next to it are equal."""
    narrow = 1e-13 * max(abs(high), abs(low))
    a, b = low, high  # above(a) >= wanted > above(b)
    while b - a > narrow:
        middle = (a + b) / 2
        n = inertia.above(middle)
        a, b = (middle, b) if n >= wanted else (a, middle)
        if n == wanted:
            break
    n = inertia.above(a)

    def end(inside: float, outside: float) -> float:
        """The end of the gap between a place in it and one beyond it."""
        for _ in range(10):
            middle = (inside + outside) / 2
            inside, outside = (middle, outside) if inertia.above(middle) == n else (inside, middle)
        return inside

    return end(a, low), end(a, high)


def _cut(inertia: Inertia, low: float, high: float, least: int, most: int) -> float:
    """The middle of the widest gap with `least` to `most` eigenvalues above it."""
    gaps = [_gap(inertia, low, high, n) for n in range(least, most + 1)]
    a, b = max(gaps, key=lambda gap: gap[1] - gap[0])
    return (a + b) / 2


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray  # columns


def feast(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> Pairs:
    """The eigenpairs with values in (low, high), of which inertia has counted `count`; raises if they are not all found."""
    d = len(matrix)
    center, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = math.pi / 2 * (nodes + 1)
    more = max(4, count // 2)
    size = min(d, count + more)
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((d, size)))[0]
    scale = float(np.abs(matrix).sum(axis=1).max()) or 1.0
    found, settled = Pairs(np.zeros(0), np.zeros((d, 0))), False
    for turn_no in range(1, ROUNDS + 1):
        image = np.zeros_like(basis)
        for angle, weight in zip(angles, weights):
            z = radius * complex(math.cos(angle), math.sin(angle))
            image += weight / 2 * (z * np.linalg.solve((center + z) * np.eye(d) - matrix, basis.astype(complex))).real
        basis = np.linalg.qr(image)[0]
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        basis = basis @ turn
        inside = (values > low) & (values < high)
        found = Pairs(values[inside], basis[:, inside])
        rest = np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0)
        small = inside.sum() == count and (rest <= TOLERANCE * scale).all()
        if small and settled:  # one round more brings vectors to rounding
            return found
        settled = small
        if turn_no % 4 == 0 and basis.shape[1] < d:  # slow, as eigenvalues lie close outside: more directions take them in
            fresh = rng.standard_normal((d, min(more, d - basis.shape[1])))
            basis, more = np.linalg.qr(np.hstack([basis, fresh]))[0], 2 * more
    raise ArithmeticError(f"{len(found.values)} of {count} eigenvalues between {low} and {high} found in {ROUNDS} rounds")


def leading(matrix: np.ndarray, most: int) -> Pairs:
    """The eigenpairs of the `most` greatest positive eigenvalues of a covariance, falling; fewer if its rank is less.

    Eigenvalues of up to ZERO times the matrix's norm are none: rounding leaves nothing certain there.
    """
    scale = float(np.abs(matrix).sum(axis=1).max()) if len(matrix) else 0.0
    if scale <= 0:
        return Pairs(np.zeros(0), np.zeros((len(matrix), 0)))
    matrix = matrix / scale
    inertia = Inertia(matrix)
    high, zero = 1.0 + 1e-9, ZERO
    rank = inertia.above(zero)
    if not rank:
        return Pairs(np.zeros(0), np.zeros((len(matrix), 0)))
    # bounds close to the greatest eigenvalue and amid a gap below the last one wanted keep the contours small
    top, over = 0.0, high
    while over - top > 0.01 * top:
        middle = (top + over) / 2
        top, over = (top, middle) if inertia.above(middle) == 0 else (middle, over)
    low = _cut(inertia, zero, over, min(rank, most), min(rank, most + CHOICE))
    cuts, left = [over], inertia.above(low)
    done = 0
    while done < left:
        if left - done <= INTERVAL:
            at = low
        else:
            at = _cut(inertia, low, cuts[-1], done + INTERVAL - CHOICE, done + INTERVAL)
        cuts.append(at)
        done = inertia.above(at)
    vectors = [
        feast(matrix, a, b, inertia.above(a) - inertia.above(b), seed=k).vectors for k, (b, a) in enumerate(zip(cuts, cuts[1:]))
    ]
    # one last Rayleigh-Ritz over all intervals makes vectors of neighbouring ones orthogonal to rounding
    basis = np.linalg.qr(np.hstack(vectors))[0]
    values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:most]
    return Pairs(values[order] * scale, (basis @ turn)[:, order])


# ---- exact sums over all tasks --------------------------------------------------------------------------------------


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], length: int, dtype: str) -> list:
    """The sum of what `part` gives for blocks of vectors `x`, arrays of `length` numbers, kept exact if whole.

    Every task sends one row for each number; Spark adds them up.
    """
    kind = "decimal(38,0)" if dtype == "whole" else "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, dtype=object if dtype == "whole" else float)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                total = total + part(_matrix(batch.column(0).slice(k, ROWS)))
        numbers = pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0)) if dtype == "whole" else pa.array(total)
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), numbers], names=["k", "v"])

    sums = rows.select("x").mapInArrow(add, f"k int, v {kind}").groupBy("k").agg(F.sum(F.col("v")).alias("v"))
    return [r["v"] for r in sorted(sums.collect())]  # as many rows as numbers, whatever the input


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _products(u: np.ndarray) -> np.ndarray:
    """Sums of products of all columns and sums of the columns, exact."""
    if not len(u):
        return np.zeros(u.shape[1] * (u.shape[1] + 1), dtype=object)
    if float(np.abs(u).max()) ** 2 * len(u) < 2**53:  # every sum is a whole number that a double holds
        exact = u.astype(float)
        both = np.rint(exact.T @ exact).astype(np.int64).astype(object)
    else:
        both = u.astype(object).T @ u.astype(object)
    return np.concatenate([both.ravel(), u.astype(object).sum(axis=0)])


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, in whole numbers."""
        fits = self.n * float(np.abs(x).max(initial=0)) < 2**61 and max(map(abs, self.sums)) < 2**61
        kind = np.int64 if fits else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(float) / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        y = self.scaled(x)
        if y.dtype != object and float(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2**62:
            return (y * y).sum(axis=1).tolist()
        y = y.astype(object)
        return (y * y).sum(axis=1).tolist()


def gridded(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """vectors with x, the vector on the grid, without rows whose vector is null, empty or holds null or non-finite entries."""
    c = F.col(vector_col)
    # null if an entry is null
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * F.lit(SCALE)) + F.lit(SHIFT))
    return vectors.filter(c.isNotNull() & (F.size(c) > 0)).filter(finite).withColumn("x", x)


def fit(rows: DataFrame, most: int) -> Whitening | None:
    """The whitening of the different vectors `x` of `rows`; None without any."""
    ship(rows.sparkSession)
    listed = written(rows.select("x").distinct(), "whitening-fit")
    shape = listed.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("d")).first()
    n, d = shape["n"], shape["d"]
    if not n:
        return None
    if shape["least"] != d:
        raise ValueError(f"vectors have {shape['least']} to {d} entries")
    sums = [int(v) for v in _summed(listed, lambda x: x.astype(object).sum(axis=0), d, "whole")]
    # centred at the whole numbers next to the mean, which leaves the products small; the rest of the mean is taken off exactly
    middle = [(2 * s + n) // (2 * n) for s in sums]
    center = np.array(middle, dtype=np.int64)
    moments = [int(v) for v in _summed(listed, lambda x: _products(x - center), d * (d + 1), "whole")]
    rest = moments[d * d :]
    covariance = np.array(
        [[(n * moments[i * d + j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)], dtype=float
    )
    covariance = (covariance + covariance.T) / 2
    pairs = leading(covariance, most)
    made = Whitening(n, sums, pairs.values, pairs.vectors, float(np.trace(covariance)), 0.0)
    k = len(pairs.values)
    if k:
        # measured on the whitened vectors themselves, whose mean is zero
        def spread(x: np.ndarray) -> np.ndarray:
            z = made.apply(x)
            return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

        found = np.array(_summed(listed, spread, k * (k + 1), "real"), dtype=float) / n
        mean = found[k * k :]
        made.identity_error = float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    return made


def whiten(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id_col, component, n, deviation, whitened, explained and identity_error of every row and component.

    Entries c become x = floor(64 * c) + 1000000. The covariance is that of the n
    different vectors x, with divisor n; components are its unit eigenvectors, numbered from 1
    by falling eigenvalue e, at most `most`. whitened is (x - mean) projected on the component, over sqrt(e);
    explained is e over the trace; deviation the squared length of n * x - sums, exact,
    a decimal(38,0); identity_error the largest entry of the whitened vectors' covariance minus the identity.

    Rows whose vector is null or empty or holds a null or non-finite entry are dropped;
    repeated rows are whitened each. Directions without variance are no
    components, so equal vectors, or one, give no rows, as does an empty table. Vectors of
    different lengths raise ValueError. The matrix and the components, whose size is that of the
    dimension, are all that the driver sees. Other columns are not read.
    """
    rows = gridded(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), "vector").select("id", "x")
    made = fit(rows, most)
    schema = (
        f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    if made is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(made.values)
    explained = made.values / made.trace if k else np.zeros(0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            m = len(x)
            deviation = pa.array([Decimal(v) for v in made.deviation(x)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, made.n)),
                    deviation.take(each), pa.array(made.apply(x).ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, made.identity_error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
