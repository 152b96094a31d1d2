"""Whitening of embeddings by spectrum slicing.

Spark sums the distinct vectors and their products about an integer centre, exactly. The
covariance, whose size depends on the dimension alone, is then sliced on the driver: the
LDL' factors of the shifted matrix tell by their signs how many eigenvalues lie above the
shift (Sylvester's law of inertia). Bisection by these counts isolates each leading
eigenvalue, Rayleigh quotient iteration converges to it cubically, and counts on both sides
of the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import written

COMPONENTS = 4
EPS = np.finfo(np.float64).eps
_GROWTH = (1 + 17**0.5) / 8
_LONG = (1 << 63) - 1
_EXACT_IN_DOUBLE = float(1 << 53)


# --- the spectrum of one symmetric matrix


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int, int]:
    """How many eigenvalues lie above, at and below the shift, by a pivoted LDL' factorisation.

    Pivots are single entries or symmetric 2x2 blocks chosen so that the factors stay bounded.
    """
    m = matrix - shift * np.eye(len(matrix))
    above = zero = below = 0
    while n := len(m):
        step, corner = 1, abs(m[0, 0])
        largest = np.abs(m[1:, 0]).max(initial=0.0)
        if max(corner, largest) == 0.0:
            zero, m = zero + 1, m[1:, 1:]
            continue
        if corner < _GROWTH * largest:
            r = 1 + int(np.argmax(np.abs(m[1:, 0])))
            beside = np.abs(m[r]).copy()
            beside[r] = 0.0
            reach = beside.max()
            if corner * reach < _GROWTH * largest * largest:
                target = 0 if abs(m[r, r]) >= _GROWTH * reach else 1
                step += target
                order = np.arange(n)
                order[[target, r]] = order[[r, target]]
                m = m[np.ix_(order, order)]
        if step == 1:
            pivot, column = m[0, 0], m[1:, 0]
            above, below = above + (pivot > 0), below + (pivot < 0)
            m = m[1:, 1:] - np.outer(column / pivot, column)
        else:
            block, columns = m[:2, :2], m[2:, :2]
            signs = np.linalg.eigvalsh(block)
            above, below = above + int((signs > 0).sum()), below + int((signs < 0).sum())
            m = m[2:, 2:] - columns @ np.linalg.solve(block, columns.T)
    return above, zero, below


class Slices:
    """Counts of eigenvalues above shifts, kept for all eigenvalues of one matrix."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        low, high = (np.diag(matrix) - radius).min(), (np.diag(matrix) + radius).max()
        self.scale = max(abs(low), abs(high))
        self.least = max(4 * len(matrix) * EPS * self.scale, 1e-140)
        self.known = {low - self.least: len(matrix), high + self.least: 0}

    def above(self, shift: float) -> int:
        """Eigenvalues above the shift; one at the shift itself counts as above."""
        if shift not in self.known:
            more, same, _ = inertia(self.matrix, shift)
            self.known[shift] = more + same
        return self.known[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of this number."""
        low = max(s for s, n in self.known.items() if n >= number)
        return low, min(s for s, n in self.known.items() if n < number and s > low)

    def halve(self, number: int) -> tuple[float, float]:
        low, high = self.around(number)
        self.above(low + (high - low) / 2)
        return self.around(number)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(matrix - shift)^-1 right, normalised; a shift that hits an eigenvalue is moved a little."""
    for move in (0.0, least / 16, -least / 16, least, 3 * least):
        try:
            y = np.linalg.solve(matrix - (shift + move) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(y)
        if np.isfinite(length) and length > 0:
            return y / length
    return right


def _refined(slices: Slices, start: np.ndarray, shift: float, found: list[np.ndarray]):
    """Rayleigh quotient iteration: (eigenvalue, vector, length of the residual)."""
    matrix = slices.matrix
    apart = lambda v: v - sum((f * (f @ v) for f in found), np.zeros(len(v)))
    v = apart(start)
    v = _solved(matrix, shift, v / np.linalg.norm(v), slices.least)
    best = None
    for _ in range(12):
        v = apart(v)
        v /= np.linalg.norm(v)
        value = v @ matrix @ v
        residual = float(np.linalg.norm(matrix @ v - value * v))
        if best is not None and residual >= best[2]:
            break
        best = (float(value), v, residual)
        if residual <= EPS * slices.scale:
            break
        v = _solved(matrix, value, v, slices.least)
    return best


def leading(matrix: np.ndarray, count: int) -> list[tuple[float, np.ndarray]]:
    """The `count` largest eigenvalues in falling order, with unit eigenvectors.

    Eigenvalues that no shift can tell apart in doubles get orthonormal vectors of their
    common space. A vector's entry of largest size is positive.
    """
    slices, out = Slices(matrix), []
    noise = np.random.default_rng(0)
    for number in range(1, min(count, len(matrix)) + 1):
        found = [v for _, v in out]
        low, high = slices.around(number)
        unlucky = 0
        while True:
            alone = slices.above(low) == number and slices.above(high) == number - 1
            narrow = high - low <= 4 * slices.least
            if alone or narrow:
                value, v, residual = _refined(slices, noise.normal(size=len(matrix)), low + (high - low) / 2, found)
                margin = max(2 * residual, slices.least)
                certified = slices.above(value - margin) >= number > slices.above(value + margin)
                if certified or (narrow and low - margin <= value <= high + margin):
                    break
                if narrow and unlucky < 8:  # another start, at random
                    unlucky += 1
                    continue
                if narrow:
                    break
            low, high = slices.halve(number)
        out.append((value, v if v[np.argmax(np.abs(v))] > 0 else -v))
    return out


# --- sums over the vectors


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dims)


def _exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    reach = float(np.abs(x.astype(np.float64)).max(initial=0)) * len(x)
    return (x if reach < 2.0**62 else x.astype(object)).sum(axis=0).astype(object)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers."""
    reach = float(np.abs(y.astype(np.float64)).max(initial=0)) ** 2 * len(y)
    if reach < _EXACT_IN_DOUBLE:
        values = y.astype(np.float64)
        return (values.T @ values).astype(np.int64).astype(object)
    whole = y if reach < 2.0**62 else y.astype(object)
    return (whole.T @ whole).astype(object)


_NUMBER = pa.decimal128(38, 0)


def _pairs(names: tuple[str, ...], keys: list[np.ndarray], values: np.ndarray) -> pa.RecordBatch:
    numbers = pa.array([Decimal(int(v)) for v in values], _NUMBER)
    return pa.RecordBatch.from_arrays([*[pa.array(k.astype(np.int32)) for k in keys], numbers], names=[*names, "s"])


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and sums by dimension, exact. One line per dimension leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for batch in batches:
            total, n = total + _exact_sum(_matrix(batch.column(0), dims)), n + batch.num_rows
        yield _pairs(("i",), [np.arange(dims + 1)], np.append(total, n))

    found = fit.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    by = {r.i: int(r.s) for r in found.collect()}  # dims + 1 rows
    return by.get(dims, 0), [by.get(i, 0) for i in range(dims)]


def _products(fit: DataFrame, dims: int, centre: list[int]) -> np.ndarray:
    """Sums of products of all pairs of dimensions about an integer centre, exact."""
    rows, columns = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            total = total + _exact_products(_matrix(batch.column(0), dims) - np.array(centre, np.int64))
        step = 1 << 16
        for s in range(0, len(rows), step):
            i, j = rows[s : s + step], columns[s : s + step]
            yield _pairs(("i", "j"), [i, j], total[i, j])

    found = fit.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((dims, dims), object)
    for r in found.toLocalIterator():  # half of dims * dims rows
        out[r.i, r.j] = out[r.j, r.i] = int(r.s)
    return out


def covariance(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, sums and covariance (divisor n) of the vectors in the only column of `fit`.

    Products are taken about the integers next to the means and put right by what is left,
    in whole numbers: every entry is the exact covariance rounded once.
    """
    n, sums = _sums(fit, dims)
    if not n:
        return 0, sums, np.zeros((dims, dims))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    left = np.array([s - n * c for s, c in zip(sums, centre)], object)
    exact = n * _products(fit, dims, centre) - np.outer(left, left)
    return n, sums, np.array([[int(v) / (n * n) for v in line] for line in exact], np.float64).reshape(dims, dims)


# --- the operator


class _Projection:
    """What a task needs: sums, and the components scaled to unit variance."""

    def __init__(self, n: int, sums: list[int], spectrum: list[tuple[float, np.ndarray]], least: float):
        self.n, self.sums = n, sums
        self.flat = [e <= least for e, _ in spectrum]
        scaled = [v * 0.0 if e <= least else v / e**0.5 for e, v in spectrum]
        self.axes = np.stack(scaled, axis=1)

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Squared distances from the mean in units of 1/n^2, and whitened coordinates."""
        reach = self.n * float(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, self.sums), default=0)
        small = reach**2 * x.shape[1] < 2.0**62
        kind = np.int64 if small else object
        offset = x.astype(kind) * self.n - np.array(self.sums, kind)
        squares = (offset * offset).sum(axis=1)
        squares = [int(s) if s <= _LONG else None for s in squares]
        return squares, (offset.astype(np.float64) / self.n) @ self.axes


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "vector", components: int = COMPONENTS
) -> DataFrame:
    """One row per row of `vectors` and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    `vectors` has integer vectors (array<long>) without null entries. Each distinct vector
    counts once for mean and covariance, n of them in all. deviation is the squared distance
    from the mean times n^2, exact; null where a long cannot hold it. whitened is the
    coordinate along the component over the root of its eigenvalue, explained the
    eigenvalue's share of the trace, identity_error how far the whitened fit vectors are
    from unit covariance at most.

    A component without variance has null coordinates and is left out of identity_error.
    Rows without a vector, with an empty one, or of another length than the commonest (the
    longest of several) are left out. Repeated rows and null ids stay. No rows give no rows.
    """
    named = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<long>").alias("x"))
    named = named.where(F.size("x") > 0)
    length = named.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    kind = vectors.schema[id_col].dataType.simpleString()
    if length is None:
        schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    dims = length.dims
    named = named.where(F.size("x") == dims)
    fit = written(named.select("x").distinct(), "whitening")
    n, sums, matrix = covariance(fit, dims)
    spectrum = leading(matrix, components)
    trace = float(np.trace(matrix))
    least = 4 * dims * EPS * trace
    projection = _Projection(n, sums, spectrum, least)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squares, w = projection.apply(_matrix(batch.column("x"), dims))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
            rest = [c for c in batch.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(squares, pa.int64()), lists], names=[*rest, "deviation", "w"]
            )

    error = _identity_error(fit.mapInArrow(projected, "deviation long, w array<double>"), projection.flat)
    explained = F.array(*[F.lit(e / trace if trace else None).cast("double") for e, _ in spectrum])
    values = named.mapInArrow(projected, f"id {kind}, deviation long, w array<double>")
    values = values.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    flat = F.array(*[F.lit(f) for f in projection.flat])
    return values.select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(~F.get(flat, F.col("at")), F.col("whitened")).alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(whitened: DataFrame, flat: list[bool]) -> float | None:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    live = [i for i, f in enumerate(flat) if not f]
    if not live:
        return None
    w = whitened.select(*[F.col("w")[i].alias(f"w{i}") for i in live])
    mean = w.agg(*[F.avg(f"w{i}").alias(f"w{i}") for i in live]).first()
    centred = w.select(*[(F.col(f"w{i}") - F.lit(mean[f"w{i}"])).alias(f"w{i}") for i in live])
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = centred.agg(*[F.avg(F.col(f"w{i}") * F.col(f"w{j}")) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))
