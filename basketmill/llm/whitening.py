"""Whitening of embeddings: components by FEAST contour integration of their covariance.

Spark sums the vectors exactly, as integers, and then the products of the centred vectors; what reaches the driver is one
number per pair of dimensions, however many vectors there are. There, a contour around an interval of eigenvalues is
integrated: complex shifted solves at the quadrature points filter a block of vectors, Rayleigh and Ritz's procedure takes the
eigenpairs out of what is left, and rounds of this converge. The interval's ends and the number of eigenvalues
inside are found beforehand from the inertia of the shifted covariance, so none can be missed unnoticed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Entries from here on do not fit the integers and count as not finite.
TOO_LARGE = 2.0**30
# The driver holds a few square matrices of this size at most.
MOST_DIMENSIONS = 4096
POINTS = 16
ROUNDS = 200
_ROWS = 1 << 16


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v[0] += length if v[0] >= 0 else -length
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k:]
        rest -= 2 * np.outer(v, v @ rest)
        rest = a[k:, k + 1 :]
        rest -= 2 * np.outer(rest @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    diagonal, off = tri
    tiny = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for i, value in enumerate(diagonal.tolist()):
        pivot = value - shift - (off[i - 1] * off[i - 1] / pivot if i else 0.0)
        pivot = pivot or -tiny
        above += pivot > 0
    return above


def _edge(tri, least: int, low: float, high: float) -> float:
    """Just below the eigenvalue number ``least`` from above."""
    for _ in range(60):
        middle = (low + high) / 2
        if count_above(tri, middle) >= least:
            low = middle
        else:
            high = middle
        if high - low <= 1e-10 * abs(high):
            break
    return low


def interval(tri, wanted: int, bound: float) -> tuple[float, float, int]:
    """An interval with the ``wanted`` largest eigenvalues, its ends away from all others, and how many it has."""
    size = len(tri[0])
    wanted = min(wanted, count_above(tri, size * np.finfo(float).eps * bound))
    if not wanted:
        return 0.0, 0.0, 0
    high = _edge(tri, 1, 0.0, bound)
    inside, last = wanted, _edge(tri, wanted, 0.0, bound)
    while inside < size:
        after = _edge(tri, inside + 1, -bound, bound)
        if last - after > 1e-6 * high:
            break
        inside, last = inside + 1, after
    else:
        after = -high
    return max((last + after) / 2, last - high), high + max(0.05 * (high - last), 0.05 * high), inside


def feast(matrix: np.ndarray, wanted: int, points: int = POINTS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Eigenvalues that rounding cannot tell from zero are left out. Raises if the inertia counts find
    another number of eigenvalues in the interval than the contour did.
    """
    size = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not bound:
        return np.zeros(0), np.zeros((size, 0))
    tri = tridiagonal(matrix)
    low, high, inside = interval(tri, wanted, bound * (1 + 1e-12))
    if not inside:
        return np.zeros(0), np.zeros((size, 0))
    middle, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (np.arange(points) + 0.5) / points)
    block = np.random.default_rng(0).standard_normal((size, min(size, 2 * inside + 8)))
    identity = np.eye(size)
    best, stuck = np.inf, 0
    for _ in range(rounds):
        # The lower half of the circle gives the complex conjugates.
        block = sum((radius * t * np.linalg.solve((middle + radius * t) * identity - matrix, block)).real for t in turns) / points
        basis = np.linalg.qr(block)[0]
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turned
        chosen = np.flatnonzero(values > low)
        error = np.abs(matrix @ block[:, chosen] - block[:, chosen] * values[chosen]).max(initial=0.0)
        stuck = 0 if error < best / 2 and len(chosen) == inside else stuck + 1
        best = min(best, error)
        if stuck >= 2 and error <= 1e-13 * bound or stuck >= 8 and error <= 1e-10 * bound:
            break
    if len(chosen) != count_above(tri, low) or error > 1e-10 * bound:
        raise ArithmeticError(f"{len(chosen)} components found of {inside}, residual {error}")
    order = chosen[::-1][:wanted]
    vectors = block[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


@dataclass
class Fit:
    """Counts and exact sums of the fit list, and its components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off as an integer, so nothing is lost to its size."""
    whole = [s // n for s in sums]
    rest = np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])
    return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest


def _usable(vector: Column) -> Column:
    # A NaN is greater than every number.
    bad = F.exists(vector, lambda c: c.isNull() | (F.abs(c) >= F.lit(TOO_LARGE)))
    return vector.isNotNull() & ~bad & (F.size(vector) > 0)


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
    x = np.floor(SCALE * values).astype(np.int64) + SHIFT
    return x.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), dtype=np.int64)


def _table(place, value, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(value, kind)], ["place", "value"])


def _sums(batches):
    """Sums per dimension; the sums of at most so many rows fit a long."""
    held, rows = None, 0
    for batch in batches:
        x = _integers(batch)
        if not len(x):
            continue
        held = x.sum(axis=0) + (0 if held is None else held)
        rows += len(x)
        if rows >= _ROWS:
            yield _table(np.arange(len(held)), held, pa.int64())
            held, rows = None, 0
    if held is not None:
        yield _table(np.arange(len(held)), held, pa.int64())


def _products(centre: Callable[[np.ndarray], np.ndarray]):
    """Sums of products of every two columns of what ``centre`` makes of the rows."""

    def add(batches):
        held = None
        for batch in batches:
            x = _integers(batch)
            if len(x):
                z = centre(x)
                held = z.T @ z + (0 if held is None else held)
        if held is not None:
            i, j = np.triu_indices(len(held))
            yield _table(i * len(held) + j, held[i, j], pa.float64())

    return add


def _covariance(rows: DataFrame, centre: Callable[[np.ndarray], np.ndarray], n: int, size: int) -> np.ndarray:
    sums = rows.select("vec").mapInArrow(_products(centre), "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = sums.toArrow()
    matrix = np.zeros((size, size))
    matrix.reshape(-1)[found["place"].to_numpy()] = found["value"].to_numpy() / n
    return np.triu(matrix) + np.triu(matrix, 1).T


def fit(rows: DataFrame, size: int, n: int, components: int = COMPONENTS) -> Fit:
    """Components of the covariance of ``rows``, whose ``vec`` has ``size`` usable entries each."""
    sums = rows.select("vec").mapInArrow(_sums, "place bigint, value bigint").groupBy("place")
    sums = sums.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("place").collect()
    exact = [int(row["value"]) for row in sums]
    covariance = _covariance(rows, lambda x: _centred(x, n, exact), n, size)
    values, vectors = feast(covariance, min(components, size))
    return Fit(n, exact, values, vectors, float(np.trace(covariance)))


def _deviations(x: np.ndarray, fitted: Fit) -> pa.Array:
    """Exact sums of (n x - S) squared; null where such a sum exceeds a long."""
    n, limit = fitted.n, 1 << 63
    if n * (int(np.abs(x).max(initial=0)) + 1) < limit // 2:
        away = n * x - np.array(fitted.sums, dtype=np.int64)
        about = np.square(away.astype(np.float64)).sum(axis=1)
        exact = np.square(away).sum(axis=1)
        sure, unsure = about < limit * (1 - 1e-9), np.flatnonzero(about < limit * (1 + 1e-9))
        unsure = unsure[~sure[unsure]]
        found = pa.array(exact, pa.int64(), mask=~sure)
        if not len(unsure):
            return found
        whole = found.to_pylist()
    else:
        whole, unsure = [None] * len(x), range(len(x))
    for row in unsure:
        total = sum((n * int(v) - s) ** 2 for v, s in zip(x[row], fitted.sums, strict=True))
        whole[row] = total if total < limit else None
    return pa.array(whole, pa.int64())


def _projected(fitted: Fit, identity_error: float):
    k = len(fitted.values)
    explained = fitted.values / fitted.total

    def project(batches):
        for batch in batches:
            x = _integers(batch)
            if not len(x):
                continue
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(row), fitted.n), pa.int64()),
                    _deviations(x, fitted).take(pa.array(row)),
                    pa.array(fitted.whitened(x).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(row), identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return project


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component: vec_id, component, n, deviation, whitened, explained and identity_error.

    Vectors that are null or empty, hold null or non-finite entries (or any from ``TOO_LARGE`` on) or differ in length from
    most (ties: the longest) are left out. Components without variance are left out, so equal vectors, a single one or none
    give no rows. Equal eigenvalues share their space in any way. Repeated rows count and return each; a null id is kept.
    A deviation that does not fit a long is null. Columns other than the two named are not read, whatever their names.
    """
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.where(_usable(F.col("vec")))
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    size = F.size("vec")
    most = rows.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if not most:
        return rows.sparkSession.createDataFrame([], schema)
    if most["size"] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {most['size']} dimensions, at most {MOST_DIMENSIONS} are supported")
    rows = rows.where(size == most["size"])
    fitted = fit(rows, most["size"], most["n"], components)
    k = len(fitted.values)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    identity_error = float(np.abs(_covariance(rows, fitted.whitened, fitted.n, k) - np.eye(k)).max())
    return rows.mapInArrow(_projected(fitted, identity_error), schema)
