"""Embedding whitening: vectors projected on the leading eigenvectors of their
covariance, each component divided by the root of its eigenvalue.

**Method: spectrum slicing.**  For a symmetric matrix V the factorisation
V - s I = L D L' (symmetric pivots of one or two rows) has as many positive
eigenvalues in D as V has above s, so one factorisation counts the eigenvalues
above any s.  Counts halve an interval until it holds the k-th eigenvalue alone,
Rayleigh quotient iteration from its middle converges to it cubically, and the
counts on both sides of the value found certify that it is number k.  Values
that no count tells apart (closer than rounding allows) form a group whose
vectors are iterated together and made orthogonal.

Entries c become the whole numbers x = floor(scale * c) + offset, all vectors
are the fit list, the covariance's divisor is n and vectors are centred before
they are multiplied.  Sums of x and the deviation are exact: x is split into
its dimension's floor of the mean and a small rest, and what might not fit into
64 bits is summed as decimals or Python integers.

At scale: two passes over the vectors, sums and then products; a task emits
its sums or its dims x dims products once, Spark adds them up, and the driver
solves for the eigenvectors of a matrix whose size is the dimension's, whatever
the number of rows.  The third pass projects.  The whitened covariance is one
partial aggregate over the written projections.

Defined cases: vectors that are null, empty, or hold a null or non-finite entry
are left out, and so are vectors whose length is not the commonest one (the
longest of several); entries whose x lies beyond 2^53 are taken as +-2^53.  A
deviation too large for a long is null, ``deviation_exact`` (decimal) holds
it up to 38 digits.  Components whose eigenvalue is 0 up to rounding (fewer
vectors or dimensions than components, equal vectors) have no whitened value and
no rows; an empty table gives none.  Repeated rows and null ids are rows like
any other.  Eigenvectors' signs are fixed by the largest entry being positive.
Columns other than the id and the vector are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, written

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
_LARGEST = 1 << 53
_EPS = np.finfo(float).eps


# --- eigenvalues --------------------------------------------------------------------

def positive_count(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, read off the
    pivots of its LDL' factorisation (Bunch-Kaufman pivots of size 1 or 2)."""
    a, n, k, positive = a.copy(), len(a), 0, 0
    ratio = (1 + 17 ** 0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = below.max() if len(below) else 0.0
        size = 1
        if max(abs(a[k, k]), most) == 0:
            k += 1
            continue
        if abs(a[k, k]) < ratio * most:
            column = np.abs(a[k:, r])
            column[r - k] = 0
            other = column.max()
            if abs(a[k, k]) * other >= ratio * most * most:
                pass
            elif abs(a[r, r]) >= ratio * other:
                swap(k, r)
            else:
                swap(k + 1, r)
                size = 2
        pivot, side = a[k:k + size, k:k + size].copy(), a[k + size:, k:k + size].copy()
        if size == 1:
            positive += pivot[0, 0] > 0
            a[k + 1:, k + 1:] -= np.outer(side[:, 0] / pivot[0, 0], side[:, 0])
        else:  # a 2 x 2 pivot is indefinite: one value of each sign
            positive += 1
            a[k + 2:, k + 2:] -= side @ np.linalg.solve(pivot, side.T)
        k += size
    return int(positive)


class Slices:
    """Counts of a matrix's eigenvalues above points, kept for further use."""

    def __init__(self, v: np.ndarray) -> None:
        self.v, self.n = v, len(v)
        around = np.abs(v).sum(1) - np.abs(v.diagonal())
        self.low, self.high = float((v.diagonal() - around).min()), float((v.diagonal() + around).max())
        self.norm = max(abs(self.low), abs(self.high))
        self.known = {np.nextafter(self.low, -np.inf): self.n, np.nextafter(self.high, np.inf): 0}

    def above(self, s: float) -> int:
        if s not in self.known:
            self.known[s] = positive_count(self.v - s * np.eye(self.n))
        return self.known[s]

    def around(self, k: int) -> tuple[float, float]:
        """(low, high] with eigenvalue number k (from 1, falling), alone in it
        unless its neighbours are equal up to rounding."""
        while True:
            low = max(s for s, c in self.known.items() if c >= k)
            high = min(s for s, c in self.known.items() if c < k and s > low)
            if self.known[low] - self.known[high] == 1:
                return low, high
            if high - low <= 8 * self.n * _EPS * self.norm:
                return low, high
            self.above(low + (high - low) / 2)

    def halve(self, k: int) -> None:
        low, high = self.around(k)
        self.above(low + (high - low) / 2)


def _rayleigh(v: np.ndarray, low: float, high: float, found: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval, kept
    orthogonal to the vectors found before."""
    def clean(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    identity = np.eye(len(v))
    x, value = clean(start), (low + high) / 2
    for turn in range(60):
        try:
            y = np.linalg.solve(v - value * identity, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
            y = np.linalg.solve(v - (value + _EPS * max(abs(high), abs(low), 1e-300)) * identity, x)
        x = clean(y)
        rest = v @ x
        value = float(x @ rest) if turn else value  # one step at the middle first
        if turn and np.linalg.norm(rest - value * x) <= 4 * _EPS * len(v) ** 0.5 * max(abs(high), abs(low)):
            break
    return float(x @ (v @ x)), x


def leading_eigenpairs(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues above rounding, falling, and their unit
    vectors as columns.  Raises if the counts do not certify a number."""
    slices, n = Slices(v), len(v)
    rng = np.random.default_rng(11)
    zero = 16 * n * _EPS * max(float(v.trace()), 0.0)
    count = min(count, slices.above(zero))
    values, vectors = np.zeros(count), np.zeros((n, count))
    for k in range(1, count + 1):
        for _ in range(100):
            low, high = slices.around(k)
            value, x = _rayleigh(v, low, high, vectors[:, :k - 1], rng.normal(size=n))
            slack = 8 * n * _EPS * slices.norm
            if low - slack <= value <= high + slack:
                break
            slices.halve(k)  # it went to a neighbour: a smaller interval
        if not slices.above(value - slack) >= k > slices.above(value + slack):
            raise ArithmeticError(f"eigenvalue {k} could not be numbered")
        values[k - 1], vectors[:, k - 1] = value, x
    return values, vectors


# --- on tables ----------------------------------------------------------------------

def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def _whole(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    """x of a batch's vectors, (rows, dims)."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    x = np.clip(np.floor(scale * values), -_LARGEST, _LARGEST).astype(np.int64) + offset
    return np.clip(x, -_LARGEST, _LARGEST).reshape(len(column), -1)


@dataclass
class Fit:
    n: int
    sums: list[int]
    #: floor of the mean and n * mean - n * floor, by dimension
    floors: np.ndarray
    rests: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floors) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - sum)^2, exactly."""
        y = x - self.floors
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * y.shape[1] < 1 << 62:
            return ((self.n * y - self.rests) ** 2).sum(1).tolist()
        if most * most * y.shape[1] < 1 << 62 and most * self.n * y.shape[1] < 1 << 62:
            squares, products = (y * y).sum(1).tolist(), (y * self.rests).sum(1).tolist()
        else:
            squares = [sum(int(v) ** 2 for v in row) for row in y]
            products = [sum(int(v) * int(r) for v, r in zip(row, self.rests)) for row in y]
        last = sum(int(r) ** 2 for r in self.rests)
        return [self.n * self.n * s - 2 * self.n * p + last for s, p in zip(squares, products)]


def _column_sums(partials: DataFrame, kind: str) -> list:
    """Element-wise sums of all rows' arrays, which have one length."""
    each = partials.select(F.posexplode("part").alias("i", "v"))
    added = each.groupBy("i").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    return [r.v for r in added.orderBy("i").collect()]


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Fit | None:
    """Covariance and leading components of ``vector`` (all of one length);
    None if there are none."""
    vectors = vectors.select("vector")
    first = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).first()
    if not first.n:
        return None
    n, dims = first.n, first.dims

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(dims, np.int64), 0
        for batch in batches:
            x = _whole(batch.column("vector"), scale, offset)
            room = int(np.abs(x).max(initial=0)) * len(x)
            if held + room >= 1 << 62:
                yield pa.RecordBatch.from_pydict({"part": [total]})
                total, held = np.zeros(dims, np.int64), 0
            total, held = total + x.sum(0), held + room
        if held:
            yield pa.RecordBatch.from_pydict({"part": [total]})

    found = [int(s) for s in _column_sums(vectors.mapInArrow(sums, "part array<long>"), "decimal(38,0)")]
    floors = np.array([s // n for s in found], np.int64)
    rests = np.array([s % n for s in found], np.int64)
    upper = np.triu_indices(dims)
    fitted = Fit(n, found, floors, rests, np.zeros(0), np.zeros((dims, 0)), 0.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            c = fitted.centred(_whole(batch.column("vector"), scale, offset))
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total[upper]]})

    covariance = np.zeros((dims, dims))
    covariance[upper] = np.array(_column_sums(vectors.mapInArrow(products, "part array<double>"), "double")) / n
    covariance = covariance + np.triu(covariance, 1).T
    fitted.trace = float(covariance.trace())
    values, directions = leading_eigenpairs(covariance, min(components, dims)) if fitted.trace > 0 else (np.zeros(0), np.zeros((dims, 0)))
    if len(values):
        directions = directions * np.sign(np.take_along_axis(directions, np.abs(directions).argmax(0)[None], 0))
    fitted.values, fitted.vectors = values, directions
    return fitted


def of_one_length(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the usable vectors of the commonest length."""
    document_batches(table.sparkSession)
    rows = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    rows = rows.where(_usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("dims")).count()
    commonest = lengths.orderBy(F.col("count").desc(), F.col("dims").desc()).first()
    return rows.where(F.size("vector") == commonest.dims) if commonest else rows


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, n, deviation, deviation_exact, whitened array, explained array):
    one row a vector, see the module docstring."""
    rows = of_one_length(table, id_col, vector_col)
    fitted = fit(rows, components, scale, offset)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, n long, deviation long, deviation_exact decimal(38,0), whitened array<double>, explained array<double>"
    if fitted is None:
        return table.sparkSession.createDataFrame([], schema)
    shares = (fitted.values / fitted.trace if fitted.trace else fitted.values).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch.column("vector"), scale, offset)
            whitened = fitted.centred(x) @ fitted.vectors / np.sqrt(fitted.values)
            exact = fitted.deviations(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array([fitted.n] * len(x), pa.int64()),
                pa.array([d if d < 1 << 63 else None for d in exact], pa.int64()),
                pa.array([Decimal(d) if d < 10 ** 38 else None for d in exact], pa.decimal128(38, 0)),
                pa.array(list(whitened), pa.list_(pa.float64())), pa.array([shares] * len(x), pa.list_(pa.float64()))],
                ["vec_id", "n", "deviation", "deviation_exact", "whitened", "explained"])

    return rows.mapInArrow(project, schema)


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the
    identity; None without components."""
    if not components:
        return None
    part = [F.element_at("whitened", i + 1) for i in range(components)]
    row = whitened.agg(*[F.covar_pop(part[i], part[j]) - float(i == j) for i in range(components) for j in range(i, components)]).first()
    return max(abs(e) for e in row)


def whitening_report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component with the fit's explained share and the
    check that the whitened covariance is the identity."""
    rows = written(whiten(table, id_col, vector_col, components), "whitened")
    some = rows.select(F.size("whitened").alias("k")).head()
    error = identity_error(rows, some.k if some else 0)
    each = rows.select("vec_id", "n", "deviation", "deviation_exact", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained",
                       F.lit(error).cast("double").alias("identity_error"), "deviation_exact")
