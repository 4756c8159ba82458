"""Embedding whitening by FEAST contour integration.

Vectors become integers, floor(scale * c).  Spark sums the fit list (each distinct
integer vector once) in two passes: its size and sums, then its covariance, which
is centred before it is multiplied: at the nearest integers to the means,
so that every sum is exact and no order of tasks changes a digit.  What is left
is a matrix as wide as the vectors, whatever the number of rows.

``leading`` finds its largest eigenvalues with FEAST.  Inertia counts (signs of
the pivots of a shifted factorisation) say how many eigenvalues lie above a number, and
bisection finds a cut below the wanted ones that no eigenvalue is near.  A
quadrature over a circle around the interval, of solves with complex shifted
covariances, projects a block of vectors onto the interval's eigenvectors;
Rayleigh-Ritz extracts the components; this repeats until residuals are at
rounding.  The inertia count must equal the number found, or it fails.

Defined cases: a vector that is null or holds a null or non-finite entry is
dropped; a null vec_id stays as any other; repeated vec_ids and vectors give
rows each, but a vector counts once in the fit; shorter vectors are filled with
zeros; components whose eigenvalue is zero (to rounding: constant or dependent
dimensions) do not exist, so one distinct vector, empty vectors and an empty table
give no rows; other columns are dropped; entries beyond 2**53 / scale are refused
by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm.shared import stored

SCALE = 256
COMPONENTS = 4
#: Points of the upper half of the contour.
POINTS = 8
ROUNDS = 100
#: Steps of a bisection by inertia, and the gap (as part of the largest eigenvalue) that ends the search for a cut.
STEPS, GAP = 16, 0.01
#: Largest integer that a sum in a task may reach before it is handed on.
_FULL = 1 << 62
_EXACT = 1 << 53


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<long>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c")).where(F.col("c").isNotNull())
    rows = rows.where(F.forall("c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    large = F.raise_error(F.lit(f"an entry is beyond 2**53 / {scale}")).cast("long")
    return rows.select("vec_id", F.transform("c", lambda c: F.when(F.abs(c) <= _EXACT // scale, F.floor(c * scale)).otherwise(large)).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as integers, filled with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _sums(width: int, centre: np.ndarray | None):
    """Sums of a task's x (or of products of x - centre), by cell; a cell is
    handed on before it can pass 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(width)
        cells = np.arange(width) if centre is None else upper[0] * width + upper[1]
        held, reach = np.zeros(len(cells), np.int64), 0

        def rows(values: np.ndarray) -> pa.RecordBatch:
            # 62 bits and their carry apart: Spark adds both without loss
            high, low = np.array([v >> 31 for v in values.tolist()], object), np.array([v & (2**31 - 1) for v in values.tolist()], object)
            return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(high.tolist(), pa.decimal128(38)), pa.array(low.tolist(), pa.int64())], names=["cell", "high", "low"])

        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), 4096):
                part = x[at : at + 4096]
                part = part if centre is None else part - centre
                most = int(np.abs(part).max(initial=0))
                more = len(part) * (most if centre is None else most * most)
                if more >= _FULL:  # few large vectors: in whole numbers of any size
                    big = part.astype(object)
                    yield rows(big.sum(axis=0) if centre is None else (big.T @ big)[upper])
                    continue
                if reach + more >= _FULL:
                    yield rows(held)
                    held, reach = np.zeros(len(cells), np.int64), 0
                reach += more
                held += part.sum(axis=0) if centre is None else (_gram(part, more))[upper]
        if reach:
            yield rows(held)

    return run


def _gram(part: np.ndarray, bound: int) -> np.ndarray:
    if bound < _EXACT:  # doubles hold every sum on the way
        wide = part.astype(np.float64)
        return (wide.T @ wide).astype(np.int64)
    return part.T @ part


def _totals(fit: DataFrame, width: int, centre: np.ndarray | None = None) -> dict[int, int]:
    """The sums of all tasks, by cell: as many as the width has, or its square."""
    parts = fit.select("x").mapInArrow(_sums(width, centre), "cell long, high decimal(38,0), low long")
    rows = parts.groupBy("cell").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    return {r.cell: (int(r.high) << 31) + int(r.low) for r in rows.collect()}


class Fit(NamedTuple):
    n: int
    sums: list[int]
    covariance: np.ndarray


def fitted(fit: DataFrame) -> Fit:
    """Size, sums and covariance (exact, then rounded once) of distinct integer vectors."""
    n, width = fit.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = width or 0
    if not width:
        return Fit(n, [], np.zeros((0, 0)))
    totals = _totals(fit, width)
    sums = [totals.get(i, 0) for i in range(width)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _totals(fit, width, np.array(centre, np.int64))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            covariance[i, j] = covariance[j, i] = float(Fraction(n * products.get(i * width + j, 0) - rest[i] * rest[j], n * n))
    return Fit(n, sums, covariance)


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger: positive pivots of matrix - shift, taken
    one or two at a time from the largest entry left (Sylvester's law)."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        on, off = np.abs(np.diag(a)), np.abs(a - np.diag(np.diag(a)))
        size = 1 if on.max() >= 0.6404 * off.max(initial=0) else 2
        take = [int(on.argmax())] if size == 1 else list(divmod(int(off.argmax()), len(a)))
        rest = np.setdiff1d(np.arange(len(a)), take)
        pivot = a[np.ix_(take, take)]
        if not pivot.any():
            break  # nothing but zeros is left
        positive += int(pivot[0, 0] > 0) if size == 1 else int(np.linalg.det(pivot) < 0) or 2 * int(np.trace(pivot) > 0)
        across = a[np.ix_(rest, take)]
        a = a[np.ix_(rest, rest)] - across @ np.linalg.solve(pivot, across.T)
    return positive


def _bracket(matrix: np.ndarray, count: int, low: float, high: float, steps: int) -> tuple[float, float]:
    """Around the eigenvalue that has ``count`` larger ones: above(low) > count >= above(high)."""
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if above(matrix, middle) > count else (low, middle)
    return low, high


def _interval(matrix: np.ndarray, wanted: int, floor: float, bound: float) -> tuple[float, float]:
    """An interval with the ``wanted`` largest eigenvalues (or all above the floor) whose
    lower end lies in the widest gap found below them; the floor, if all is close."""
    positive = above(matrix, floor)
    top = _bracket(matrix, 0, floor, bound, STEPS)[1]
    best, room = floor, 0.0
    count = min(wanted, positive)
    here = _bracket(matrix, count - 1, floor, top, STEPS)[0]  # just below the last one wanted
    while count < positive and count < 2 * wanted + 8 and room < GAP * top:
        count = above(matrix, here)
        under, over = (floor, floor) if count >= positive else _bracket(matrix, count, floor, here, STEPS)
        if here - over > room:
            best, room = (here + over) / 2, here - over
        here = under
    if count >= positive and here - floor > room:
        best, room = floor, here - floor
    if room < GAP * top / 16:  # too close to part: all of them
        best = floor
    return best, top + max(room / 2, 1e-3 * top)


def _project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part along eigenvectors of (low, high): quadrature of the resolvent on a circle."""
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for point, weight in zip(points, weights, strict=True):
        turn = np.exp(1j * np.pi * (point + 1) / 2)  # the lower half is its mirror image
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += 0.5 * weight * (radius * turn * solved).real
    return out


class Components(NamedTuple):
    values: np.ndarray  # falling
    vectors: np.ndarray  # a column each


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> Components:
    """The largest eigenvalues above rounding, at most ``wanted``, and unit eigenvectors."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))  # no eigenvalue is larger
    floor = 16 * size * np.finfo(float).eps * scale
    if not scale or not above(matrix, floor):
        return Components(np.zeros(0), np.zeros((size, 0)))
    low, high = _interval(matrix, wanted, floor, 1.01 * scale)
    count = above(matrix, low)
    block = np.random.default_rng(0).standard_normal((size, min(size, count + count // 2 + 4)))
    best, left = np.inf, ROUNDS
    while True:
        basis = np.linalg.qr(_project(matrix, block, low, high))[0]
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turn
        inside = values > low
        found = matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]
        residual = np.linalg.norm(found, axis=0).max() if inside.sum() == count else np.inf
        if residual <= 8 * np.finfo(float).eps * scale or residual > best / 2 and best <= 1e-11 * scale:
            break
        left -= 1
        if not left:
            raise RuntimeError("the contour's components did not converge")
        best, block = min(best, residual), vectors
    if int(inside.sum()) != above(matrix, low):
        raise RuntimeError("the inertia count differs from the components found")
    order = np.argsort(-values[inside], kind="stable")[:wanted]
    return Components(values[inside][order], vectors[:, inside][:, order])


_WHITE = "vec_id long, deviation decimal(38,0), whitened array<double>"


def _whitening(fit: Fit, found: Components):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, n = len(fit.sums), fit.n
        weights = found.vectors / np.sqrt(found.values)
        # x - S/n without loss: whole part first
        whole = np.array([s // n for s in fit.sums], np.int64)
        part = np.array([float(Fraction(s % n, n)) for s in fit.sums])
        sums = np.array(fit.sums, object)
        for batch in batches:
            x = _matrix(batch.column(1), width)
            white = ((x - whole).astype(np.float64) - part) @ weights
            most = n * int(np.abs(x).max(initial=0)) + max(map(abs, fit.sums))
            if most * most * width < _FULL:
                deviation = ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = ((n * x.astype(object) - sums) ** 2).sum(axis=1).tolist()
            k = white.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k, dtype=np.int32)), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.decimal128(38)), lists], names=["vec_id", "deviation", "whitened"])

    return run


class Whitening(NamedTuple):
    fit: Fit
    components: Components
    rows: DataFrame  # vec_id, deviation, whitened (an entry for each component)
    fit_rows: DataFrame  # the same of each distinct vector, vec_id null


def whiten(vectors: DataFrame, scale: int = SCALE, wanted: int = COMPONENTS) -> Whitening:
    """Fit on the distinct integer vectors, and whiten every row."""
    rows = integer_vectors(vectors, scale)
    listed = rows.select("x").distinct()
    fit_list = stored(listed, "fit")
    fit = fitted(fit_list)
    if fit.sums:  # vectors that differ in closing zeros only are one
        short = fit_list.where(F.size("x") < len(fit.sums)).limit(1).count()
        if short:
            fill = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(len(fit.sums)) - F.size("x")))
            rows = rows.withColumn("x", fill)
            fit_list = stored(fit_list.select(fill.alias("x")).distinct(), "fit")
            fit = fitted(fit_list)
    found = leading(fit.covariance, wanted)
    if not len(found.values):
        rows, fit_list = rows.limit(0), fit_list.limit(0)
    white = _whitening(fit, found)
    none = F.lit(None).cast("long").alias("vec_id")
    return Whitening(fit, found, rows.select("vec_id", "x").mapInArrow(white, _WHITE), fit_list.select(none, "x").mapInArrow(white, _WHITE))


def identity_error(done: Whitening) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity."""
    k = len(done.components.values)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    if not cells:
        return 0.0
    # covar_pop merges centred co-moments, task by task
    row = done.fit_rows.agg(*(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in cells)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, cells, strict=True))


def whitening_report(vectors: DataFrame) -> DataFrame:
    """A row for each remaining vector and component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    done = whiten(vectors)
    trace = float(np.trace(done.fit.covariance))
    explained = [float(v) / trace for v in done.components.values]
    rows = done.rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(done.fit.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        (F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1) if explained else F.lit(None).cast("double")).alias("explained"),
        F.lit(identity_error(done)).alias("identity_error"),
    )
