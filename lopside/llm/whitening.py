"""Embedding whitening: eigenvectors of the covariance by spectrum slicing.

The covariance is summed in Spark over integers, so it is exact whatever the partitions.
Its leading eigenpairs are found in a matrix as small as the vectors are wide: an LDL' factorisation
of the shifted matrix tells by its signs how many eigenvalues lie above the shift
(Sylvester's law of inertia). Bisection by these counts isolates each leading eigenvalue,
Rayleigh quotient iteration converges to it, and two more counts beside it certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import offsets_of

FARTHEST = 4e18  # entries beyond it, which no long could hold after the shift, count as this
_EXACT = 1 << 53  # doubles hold all integers up to here


@dataclass
class Slicer:
    """Eigenvalues of a symmetric, positive semidefinite matrix by counts, from the largest down."""

    matrix: np.ndarray
    points: list[tuple[float, int]] = field(default_factory=list)  # shifts and how many eigenvalues are larger

    def __post_init__(self):
        self.size = len(self.matrix)
        self.norm = float(np.abs(self.matrix).sum(axis=1).max(initial=0))
        self.noise = 8 * max(self.size, 1) * np.finfo(float).eps * self.norm

    def above(self, shift: float) -> int:
        """How many eigenvalues are larger than ``shift``."""
        n = negatives(shift * np.eye(self.size) - self.matrix)
        self.points.append((shift, n))
        return n

    def isolate(self, k: int) -> tuple[float, float, int]:
        """An interval with the k-th largest eigenvalue, and how many lie in it (several only within rounding errors)."""
        low = max((s for s, n in self.points if n >= k), default=None)
        if low is None:
            low = -self.noise - 1e-300
            self.points.append((low, self.size))
        high = min((s for s, n in self.points if n < k and s > low), default=self.norm + self.noise)
        if not any(s == high for s, _ in self.points):
            self.points.append((high, 0))
        while True:
            held = max(n for s, n in self.points if s == low) - min(n for s, n in self.points if s == high)
            if held == 1 or high - low <= self.noise:
                return low, high, held
            low, high = self._halve(k, low, high)

    def _halve(self, k: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) >= k else (low, middle)

    def pair(self, k: int, found: list[tuple[float, np.ndarray]]) -> tuple[float, np.ndarray]:
        """The k-th eigenvalue with a unit vector, orthogonal to those ``found`` before."""
        close = [v for e, v in found]
        low, high, held = self.isolate(k)
        for attempt in range(80):
            value, vector, error = self._iterate((low + high) / 2, k + attempt, close)
            slack = max(self.noise, 2 * error)
            inside = low - slack <= value <= high + slack
            if inside and error <= 64 * self.noise and self.above(value + slack) < k <= self.above(value - slack):
                return value, vector
            if high - low <= self.noise:
                if held > 1 and inside:  # equal eigenvalues: any orthogonal vectors of their space do
                    return value, vector
                raise ArithmeticError(f"eigenvalue {k} did not settle between {low} and {high}")
            low, high = self._halve(k, low, high)
        raise ArithmeticError(f"eigenvalue {k} did not settle between {low} and {high}")

    def _iterate(self, shift: float, seed: int, close: list[np.ndarray]) -> tuple[float, np.ndarray, float]:
        def settled(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                for v in close:
                    x = x - v * (v @ x)
            return x / np.linalg.norm(x)

        x = settled(np.random.default_rng(seed).normal(size=self.size))
        value, least = shift, (np.inf, shift, x)
        for step in range(24):
            try:
                y = np.linalg.solve(self.matrix - value * np.eye(self.size), x)
            except np.linalg.LinAlgError:
                y = np.linalg.solve(self.matrix - (value + self.noise) * np.eye(self.size), x)
            if not np.isfinite(y).all() or not np.linalg.norm(y):
                break
            x = settled(y / np.abs(y).max())
            product = self.matrix @ x
            quotient = float(x @ product)
            error = float(np.linalg.norm(product - quotient * x))
            if error < least[0]:
                least = error, quotient, x
            elif step > 4:
                break
            if step >= 2:  # the first steps keep the interval's middle as their shift
                value = quotient
        error, value, x = least
        return value, x, error


def negatives(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are negative: signs of D in LDL', with pivots of one or two rows."""
    a, k, count, n = a.copy(), 0, 0, len(a)
    grow = (1 + 17 ** 0.5) / 8  # bounds the growth of the entries (a fixed value of the pivoting rule)

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        most = below.max(initial=0)
        if not most:
            count += a[k, k] < 0
            k += 1
            continue
        two = False
        if abs(a[k, k]) < grow * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            if abs(a[k, k]) * row.max() < grow * most * most:
                if abs(a[r, r]) >= grow * row.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            block, rest = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            count += int((np.linalg.eigvalsh(block) < 0).sum())
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            count += a[k, k] < 0
            rest = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(rest, rest / a[k, k])
            k += 1
    return int(count)


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; none that rounding cannot tell from zero."""
    slicer = Slicer(matrix)
    if not len(matrix) or slicer.norm == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    found: list[tuple[float, np.ndarray]] = []
    for k in range(1, min(most, slicer.above(slicer.noise)) + 1):
        found.append(slicer.pair(k, found))
    return np.array([e for e, _ in found]), np.array([v for _, v in found]).reshape(len(found), len(matrix)).T


@dataclass
class Model:
    """What whitening needs: as large as the vectors are wide, whatever their number."""

    n: int
    middle: list[int]  # the integer nearest to each mean
    rest: list[int]  # per dimension, the sum of the entries less the middle
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    fill: int
    identity_error: float = 0.0


def entries(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): entries as floor(scale * c) + shift. Vectors that are null or hold null or non-finite entries are left out."""
    x = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("x"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                     & (F.abs(v.cast("double")) < F.lit(float("inf"))))

    def moved(v: Column) -> Column:
        return F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), v.cast("double") * scale))) + F.lit(shift)

    return x.filter(F.col("x").isNotNull()).filter(sound).withColumn("x", F.transform("x", moved))


def dense(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """Lists of longs as one matrix; shorter vectors end with ``fill``."""
    offsets = offsets_of(column)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), fill, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def products(y: np.ndarray) -> np.ndarray:
    """y' y in exact integers, as int64 or, where these are too small, as Python's."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < _EXACT:
        z = y.astype(float)
        return (z.T @ z).astype(np.int64)
    rows = max(1, min(len(y), (_EXACT - 1) // (most * most)))
    if rows >= 16:
        return sum(products(y[a:a + rows]).astype(object) for a in range(0, len(y), rows))
    z = y.astype(object)
    return z.T @ z


def _summed(rows: DataFrame, run, kind: str) -> list:
    """Tasks give (i, j, value) of their own rows; Spark adds them up. As many rows as the matrix has entries."""
    return rows.mapInArrow(run, f"i int, j int, value {kind}").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()


def _triples(i: np.ndarray, j: np.ndarray, values: list) -> pa.RecordBatch:
    if values and isinstance(values[0], float):
        column = pa.array(values, pa.float64())
    else:
        column = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), column], ["i", "j", "value"])


def _sums(rows: DataFrame, fill: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension; vectors that end early go on with ``fill``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, held = 0, np.zeros(0, object), np.zeros(0, object)
        for batch in batches:
            column = batch.column("x")
            sizes = np.diff(offsets_of(column))
            width = int(sizes.max(initial=0))
            x = dense(column, width, 0)
            if width > len(sums):
                sums, held = (np.concatenate((a, np.zeros(width - len(a), object))) for a in (sums, held))
            high = (x >> 32).sum(axis=0).astype(object)  # halves, so that no sum leaves 64 bits
            sums[:width] += (high << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            held[:width] += (np.arange(width) < sizes[:, None]).sum(axis=0).astype(object)
            n += len(sizes)
        places = np.arange(len(sums))
        yield _triples(places, np.zeros(len(sums)), list(sums))
        yield _triples(places, np.ones(len(sums)), list(held))
        yield _triples(np.array([-1]), np.array([0]), [n])

    total = {(r.i, r.j): int(r.value) for r in _summed(rows, run, "decimal(38,0)")}
    n = total.pop((-1, 0), 0)
    return n, [total[k, 0] + (n - total[k, 1]) * fill for k in range(len(total) // 2)]


def fit(rows: DataFrame, components: int = 32, fill: int = 1_000_000) -> Model:
    """Means, covariance (divisor n) and leading eigenpairs of ``entries``, then how far the whitened covariance is from the identity.

    Three passes, of sums that do not grow with the rows. Vectors of unequal length go on with
    ``fill`` (the entry that zero becomes). Repeated rows count as often as they stand there. Eigenvalues that are
    zero but for rounding have no component. No rows or no dimensions: a model without components.
    """
    n, sums = _sums(rows, fill)
    width = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    at, upper = np.array(middle, np.int64), np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total = total + products(dense(batch.column("x"), width, fill) - at)
        yield _triples(*upper, total[upper].tolist())

    square = np.zeros((width, width))
    for r in _summed(rows, multiply, "decimal(38,0)") if width else ():
        square[r.i, r.j] = square[r.j, r.i] = (n * int(r.value) - rest[r.i] * rest[r.j]) / (n * n)
    values, vectors = leading(square, components)
    model = Model(n, middle, rest, values, vectors, float(np.trace(square)), fill)
    model.identity_error = _identity_error(rows, model)
    return model


def _projected(model: Model, column: pa.Array) -> np.ndarray:
    y = dense(column, len(model.middle), model.fill) - np.array(model.middle, np.int64)
    centred = y.astype(float) - np.array([r / model.n for r in model.rest])
    return centred @ (model.vectors / np.sqrt(model.values))


def _identity_error(rows: DataFrame, model: Model) -> float:
    k = len(model.values)
    if not k:
        return 0.0
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _projected(model, batch.column("x"))
            sums += w.sum(axis=0)
            square += w.T @ w
        yield _triples(np.arange(k), np.full(k, -1), sums.tolist())
        yield _triples(*upper, square[upper].tolist())

    mean, square = np.zeros(k), np.zeros((k, k))
    for r in _summed(rows, run, "double"):
        if r.j < 0:
            mean[r.i] = r.value / model.n
        else:
            square[r.i, r.j] = square[r.j, r.i] = r.value / model.n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, model: Model) -> DataFrame:
    """(vec_id, deviation, whitened): each row's projections over the roots of the eigenvalues.

    ``deviation`` is the sum over dimensions of (n * x - S)^2, exact; null where it does not fit in a long.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])
    n, middle, rest = model.n, np.array(model.middle, np.int64), np.array(model.rest, np.int64)
    widest = max((abs(r) for r in model.rest), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = dense(batch.column("x"), len(middle), model.fill) - middle
            most = n * int(np.abs(y).max(initial=0)) + widest
            if most * most * max(len(middle), 1) < 1 << 63:
                deviation = pa.array(((n * y - rest) ** 2).sum(axis=1), pa.int64())
            else:
                exact = [sum((n * int(v) - r) ** 2 for v, r in zip(row, model.rest)) for row in y.tolist()]
                deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            w = _projected(model, batch.column("x"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, lists], schema=schema)

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def component_rows(vectors: DataFrame, components: int = 32) -> DataFrame:
    """One row for each vector and component, with what the model says of it."""
    rows = entries(vectors)
    model = fit(rows, components)
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if len(model.values) else F.array().cast("array<double>")
    long = whitened(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return long.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", share[F.col("k")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))
