"""Whitening of embeddings on the leading components of their covariance, by spectrum slicing.

Entries become integers, ``floor(scale * entry)``; each distinct integer vector counts once in the fit. The
covariance V is summed from centred vectors. Its leading eigenvalues are found one by one: the matrix V - s I is
factored as L D Lᵀ (Bunch-Kaufman pivots), and by Sylvester's law the positive part of D counts the eigenvalues
above s. Bisection on these counts leaves an interval that holds the k-th eigenvalue alone; Rayleigh quotient
iteration inside it, with the same factors as solver, converges cubically; counts just below and above the
result certify that it is the k-th. Equal eigenvalues get any orthonormal vectors of their space.

Scale: the distinct vectors are stored once. Three passes over them leave one row a task and dimension: sums,
centred products, the covariance of the result. What reaches the driver, and is sent to the tasks, is the
covariance and four vectors, of a size that depends on the dimension alone.

Defined results: rows whose vector is null, or holds null, NaN or an infinity, are dropped, and so are rows whose
vector has not the commonest length (of equally common ones the longest) or no entries. An entry beyond a long
becomes the nearest long. ``deviation`` beyond a long is null. Components whose eigenvalue is at most 1e-12 of the
trace are rounding and have no rows: none for one distinct vector, at most r of rank r. Null ids stay; repeated
rows are scored again; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import materialize

SCALE = 256
COMPONENTS = 4
#: Eigenvalues of at most this share of the trace are rounding.
LEAST_SHARE = 1e-12
#: Bunch and Kaufman's bound between pivots of one and of two rows.
_PIVOT = (1 + 17**0.5) / 8
_LONG = 1 << 63


# ---- the spectrum of one symmetric matrix ----


@dataclass(frozen=True)
class Factors:
    """P A Pᵀ = L D Lᵀ with unit lower L and blocks of one or two rows in D."""

    lower: np.ndarray
    diagonal: np.ndarray
    beside: np.ndarray  # D's entry below each diagonal entry
    order: np.ndarray

    def positive(self) -> int:
        """How many eigenvalues of A are above 0."""
        n, count, k = len(self.diagonal), 0, 0
        while k < n:
            if k + 1 < n and self.beside[k]:
                a, b, c = self.diagonal[k], self.beside[k], self.diagonal[k + 1]
                # Such a pivot is indefinite but for rounding; its two signs follow from determinant and trace.
                count += 1 if a * c - b * b < 0 else 2 * int(a + c > 0)
                k += 2
            else:
                count += int(self.diagonal[k] > 0)
                k += 1
        return count

    def solve(self, right: np.ndarray, least: float) -> np.ndarray:
        """x with A x = right; pivots below ``least`` count as that, as A may be singular."""
        n, y = len(right), right[self.order].astype(float)
        for k in range(n):
            y[k + 1 :] -= self.lower[k + 1 :, k] * y[k]
        k = 0
        while k < n:
            if k + 1 < n and self.beside[k]:
                a, b, c = self.diagonal[k], self.beside[k], self.diagonal[k + 1]
                det = a * c - b * b or least * least
                y[k], y[k + 1] = (c * y[k] - b * y[k + 1]) / det, (a * y[k + 1] - b * y[k]) / det
                k += 2
            else:
                d = self.diagonal[k]
                y[k] /= d if abs(d) > least else least
                k += 1
        for k in range(n - 1, -1, -1):
            y[k] -= self.lower[k + 1 :, k] @ y[k + 1 :]
        x = np.empty(n)
        x[self.order] = y
        return x


def factor(matrix: np.ndarray) -> Factors:
    """L D Lᵀ of a symmetric matrix with Bunch-Kaufman pivots."""
    a = np.array(matrix, float)
    n = len(a)
    lower, beside, order = np.eye(n), np.zeros(n), np.arange(n)
    # What is smaller is left over from rounding, and its products would underflow.
    least = np.finfo(float).eps ** 2 * float(np.abs(a).max(initial=0.0))

    def swap(i: int, j: int, done: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            lower[[i, j], :done] = lower[[j, i], :done]
            order[[i, j]] = order[[j, i]]

    k = 0
    while k < n:
        two, largest = False, 0.0
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            largest = column[r - k - 1]
            if largest > least and abs(a[k, k]) < _PIVOT * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(a[k, k]) * widest >= _PIVOT * largest * largest:
                    pass
                elif abs(a[r, r]) >= _PIVOT * widest:
                    swap(k, r, k)
                else:
                    two = True
                    swap(k + 1, r, k)
        if two:
            block = a[k : k + 2, k : k + 2].copy()
            rest = a[k + 2 :, k : k + 2]
            (p, q), (_, s) = block
            det = p * s - q * q
            own = rest @ (np.array([[s, -q], [-q, p]]) / det)
            made = own @ rest.T
            a[k + 2 :, k + 2 :] -= (made + made.T) / 2  # stays symmetric to the last bit
            lower[k + 2 :, k : k + 2] = own
            beside[k] = q
            k += 2
        else:
            if largest > least:
                below = a[k + 1 :, k]
                lower[k + 1 :, k] = below / a[k, k]
                a[k + 1 :, k + 1 :] -= np.outer(below, below) / a[k, k]
            k += 1
    return Factors(lower, np.diag(a).copy(), beside, order)


@dataclass(frozen=True)
class Eigenpair:
    """The k-th eigenvalue from above with its unit vector, the residual of the two, and the counts of
    eigenvalues above points just below and just above it: at least k and at most k - 1."""

    number: int
    value: float
    vector: np.ndarray
    residual: float
    above_lower: int
    above_upper: int

    @property
    def certified(self) -> bool:
        return self.above_lower >= self.number > self.above_upper


class Slicer:
    """Counts of eigenvalues above points of the line, each point factored once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = (matrix + matrix.T) / 2
        self.size = len(matrix)
        radius = np.abs(self.matrix).sum(axis=1) - np.abs(np.diag(self.matrix))
        self.low = float((np.diag(self.matrix) - radius).min())
        self.high = float((np.diag(self.matrix) + radius).max())
        self.scale = max(abs(self.low), abs(self.high))
        self.noise = np.finfo(float).eps * self.scale * self.size or np.finfo(float).tiny
        self._known: dict[float, int] = {}

    def shifted(self, point: float) -> Factors:
        return factor(self.matrix - point * np.eye(self.size))

    def above(self, point: float) -> int:
        if point not in self._known:
            self._known[point] = self.shifted(point).positive()
        return self._known[point]

    def isolate(self, k: int) -> tuple[float, float]:
        """An interval with the k-th eigenvalue: alone, or with others that rounding cannot part from it."""
        low, high = self.low - self.noise, self.high + self.noise
        for point in self._known:  # what earlier eigenvalues have found out
            if self._known[point] >= k:
                low = max(low, point)
            else:
                high = min(high, point)
        while high - low > 2 * self.noise and (self.above(low) != k or self.above(high) != k - 1):
            low, high = self.halve(low, high, k)
        return low, high

    def halve(self, low: float, high: float, k: int) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) >= k else (low, middle)


def leading_eigenpairs(matrix: np.ndarray, count: int, least_share: float = LEAST_SHARE) -> list[Eigenpair]:
    """The first ``count`` eigenpairs by falling eigenvalue, without those that are rounding."""
    found: list[Eigenpair] = []
    if not len(matrix) or not np.any(matrix):
        return found
    slicer = Slicer(matrix)
    trace = float(np.trace(matrix))
    for k in range(1, min(count, slicer.size) + 1):
        pair = _kth(slicer, k, np.array([p.vector for p in found]).reshape(len(found), slicer.size))
        if pair.value <= least_share * trace:
            break
        found.append(pair)
    return found


def _kth(slicer: Slicer, k: int, before: np.ndarray) -> Eigenpair:
    low, high = slicer.isolate(k)
    start = np.random.default_rng(k).standard_normal(slicer.size)
    while True:
        value, vector, residual = _rayleigh(slicer, (low + high) / 2, start, before)
        inside = low - slicer.noise <= value <= high + slicer.noise
        if (inside and residual <= 64 * slicer.noise) or high - low <= 2 * slicer.noise:
            break
        low, high = slicer.halve(low, high, k)
    # The residual bounds the distance to an eigenvalue.
    margin = max(4 * residual, 8 * slicer.noise)
    return Eigenpair(k, value, vector, residual, slicer.above(value - margin), slicer.above(value + margin))


def _rayleigh(slicer: Slicer, shift: float, start: np.ndarray, before: np.ndarray) -> tuple[float, np.ndarray, float]:
    """Two steps of inverse iteration at ``shift``, then Rayleigh quotient iteration while it gets better;
    the iterate is kept orthogonal to the vectors found before."""
    matrix, least = slicer.matrix, slicer.noise * 1e-3

    def clean(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - before.T @ (before @ x)
        return x / np.linalg.norm(x)

    x = clean(start)
    fixed = slicer.shifted(shift)
    for _ in range(2):
        x = clean(fixed.solve(x, least))
    best = (np.inf, shift, x)
    for _ in range(30):
        value = float(x @ (matrix @ x))
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if residual >= best[0]:  # in exact arithmetic it never grows
            break
        best = (residual, value, x)
        if residual <= slicer.noise / slicer.size:
            break
        x = clean(slicer.shifted(value).solve(x, least))
    residual, value, x = best
    return value, x * (1 if x[np.abs(x).argmax()] > 0 else -1), residual


# ---- the fit over a table ----


@dataclass(frozen=True)
class Whitening:
    """What a fit leaves: ``sums`` are exact, ``identity_error`` is measured over the fit's vectors."""

    n: int
    sums: list[int]
    pairs: list[Eigenpair]
    trace: float
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [p.value / self.trace for p in self.pairs]

    @property
    def projection(self) -> np.ndarray:
        """Dimension x components: a centred vector's product with it is whitened."""
        columns = [p.vector / p.value**0.5 for p in self.pairs]
        return np.stack(columns, axis=1) if columns else np.empty((self.dimension, 0))


def integers(rows: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``rows`` whose vectors are usable, with ``x`` as ``array<long>`` in place of the vector."""
    values = F.col(vector_col).cast("array<double>")
    bad = F.exists(values, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.filter(values.isNotNull() & (F.size(values) > 0) & ~bad).withColumn(
        vector_col, F.transform(values, lambda e: F.floor(e * F.lit(float(scale))))
    )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs if they all fit, else as Python's integers."""
    most = max((abs(int(x.max())), abs(int(x.min()))), default=0) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(y: np.ndarray) -> list[int | None]:
    """Exact sums of squares by row; None beyond a long."""
    most = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
    if most * most * y.shape[1] < _LONG:
        return (y * y).sum(axis=1).tolist()
    exact = y.astype(object)
    return [v if v < _LONG else None for v in (exact * exact).sum(axis=1)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _deviations(x, n, sums).astype(float) / n


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    return fit_integers(integers(rows, vector_col, scale), vector_col, components)


def fit_integers(usable: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The fit of vectors that ``integers`` has made."""
    lengths = usable.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = lengths.first()
    if first is None:
        return Whitening(0, [], [], 0.0, 0.0)
    d = first["d"]
    distinct = materialize(usable.filter(F.size(vector_col) == d).select(F.col(vector_col).alias("x")).distinct())
    n, sums = _sums(distinct, d)
    matrix = _products(distinct, d, lambda x: _centred(x, n, sums)) / n
    pairs = leading_eigenpairs(matrix, components)
    trace = float(np.trace(matrix))
    whole = Whitening(n, sums, pairs, trace, 0.0)
    if not pairs:
        return whole
    projection = whole.projection
    white = _products(distinct, len(pairs), lambda x: _centred(x, n, sums) @ projection, d) / n
    return Whitening(n, sums, pairs, trace, float(np.abs(white - np.eye(len(pairs))).max()))


def _sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are and their sum by dimension, exactly: high and low halves are summed apart,
    so that no sum of fewer than 2^31 vectors leaves a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            place = pa.array(np.arange(d), pa.int32())
            yield pa.record_batch(
                [place, pa.array(np.full(d, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"]
            )

    parts = distinct.select("x").mapInArrow(run, "i int, n long, high long, low long")
    whole = parts.groupBy("i").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")))
    found = whole.orderBy("i").collect()  # a row a dimension
    return int(found[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


def _products(distinct: DataFrame, width: int, made, d: int | None = None) -> np.ndarray:
    """The sum of v vᵀ over the vectors v that ``made`` makes of a batch, ``width`` x ``width``."""
    d = d or width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((width, width)), False
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                v = made(_matrix(batch.column(0).slice(at, 1024), d))
                total += v.T @ v
                any_row = True
        if any_row:
            row, column = np.triu_indices(width)
            yield pa.record_batch(
                [pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(total[row, column])],
                names=["i", "j", "v"],
            )

    parts = distinct.select("x").mapInArrow(run, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # half the matrix
    matrix = np.zeros((width, width))
    matrix[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return matrix + np.triu(matrix, 1).T


def transform(
    rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """``id_col``, ``deviation`` and ``whitened`` (one entry a component) of every usable row."""
    return transform_integers(integers(rows, vector_col, scale), model, id_col, vector_col)


def transform_integers(
    usable: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """As ``transform``, for rows that ``integers`` has made."""
    n, sums, d, projection = model.n, model.sums, model.dimension, model.projection
    own = usable.select(F.col(id_col), F.col(vector_col).alias("x")).filter(F.size("x") == d)
    id_type = usable.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, deviation long, whitened array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = projection.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                y = _deviations(_matrix(part.column(1), d), n, sums)
                white = np.ascontiguousarray((y.astype(float) / n) @ projection).ravel()
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * np.int32(width)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(_squares(y), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(white)),
                    ],
                    names=[id_col, "deviation", "whitened"],
                )

    return own.mapInArrow(run, schema)


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """One row a usable vector and component: ``id_col, component, n, deviation, whitened, explained,
    identity_error``."""
    usable = integers(rows.select(id_col, vector_col), vector_col, scale)
    model = fit_integers(usable, vector_col, components)
    flat = transform_integers(usable, model, id_col, vector_col).select(
        F.col(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    explained = F.array(*map(F.lit, model.explained)) if model.pairs else F.array().cast(T.ArrayType(T.DoubleType()))
    return flat.select(
        F.col(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
