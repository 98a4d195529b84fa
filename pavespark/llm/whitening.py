"""Whitening of embeddings by spectrum slicing (operator 11).

Vectors become integers (``floor(scale * c) + offset``). Their sums, and then the products of
what is left after taking off the nearest whole mean, are added up exactly: double products
of blocks small enough to be exact, then Spark's decimals, so neither the order of the
partitions nor a lost executor changes a digit. The covariance, dimensions x dimensions, is
all that reaches the driver. There an eigenvalue is isolated by slicing: the LDL^T factors of
the covariance less a shift have as many positive pivots as eigenvalues lie above the shift.
Rayleigh quotient iteration ends the search in cubic steps, each step's own factors
narrowing the slice should it stray, and two more counts certify the number of the value.

Rows whose vector is null, empty or holds a null or non-finite entry are dropped, and so are
vectors of another length than the commonest one (of equally common ones, the shortest).
Entries beyond 2**52 after scaling count as 2**52. Repeated rows, rows without an id and rows
that share an id each count and are each returned. A component whose eigenvalue is zero to
rounding has explained 0 and a null whitened (there is nothing to divide by), and is left out
of identity_error; if no vector differs from another, explained and identity_error are null.
A deviation beyond a long is null. No vectors, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.topk_bnb import usable

EPS, TINY = float(np.finfo(np.float64).eps), 1e-140
LARGEST = float(1 << 52)
SMALL = 1 << 20  # products of entries below this add up exactly in doubles over BLOCK rows
BLOCK = 1 << 12
LONG = (1 << 63) - 1
PIVOT = (1 + math.sqrt(17)) / 8


# ------------------------------------------------------------------ inertia and solving
class Factors:
    """LDL^T of a symmetric matrix with pivots of order one and two, both chosen as the
    largest left (Bunch and Parlett)."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, np.float64)
        n = len(a)
        self.order, self.lower, self.pivots = np.arange(n), np.eye(n), []
        self.tiny = max(EPS * float(np.abs(a).max(initial=0)), TINY)
        k = 0
        while k < n:
            rest = np.abs(a[k:, k:])
            diagonal = rest.diagonal()
            at = int(diagonal.argmax())
            np.fill_diagonal(rest := rest.copy(), 0)
            i, j = divmod(int(rest.argmax()), n - k)
            if diagonal[at] >= PIVOT * rest[i, j]:
                self._swap(a, k, k + at)
                size, pivot = 1, a[k:k + 1, k:k + 1].copy()
            else:
                self._swap(a, k, k + min(i, j))
                self._swap(a, k + 1, k + max(i, j))
                size, pivot = 2, a[k:k + 2, k:k + 2].copy()
            end = k + size
            if end < n and pivot.any():
                column = a[end:, k:end].copy()
                factor = column / pivot[0, 0] if size == 1 else column @ np.linalg.inv(pivot)
                a[end:, end:] -= factor @ column.T
                self.lower[end:, k:end] = factor
            self.pivots.append((k, pivot))
            k = end

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            self.lower[[i, j], :i] = self.lower[[j, i], :i]

    def positive(self) -> int:
        """Positive eigenvalues of the matrix; a pivot of order two has one of each sign."""
        return sum(1 if len(p) == 2 else int(p[0, 0] > 0) for _, p in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """The matrix's inverse times ``b``; a vanishing pivot counts as a tiny one."""
        x = b[self.order].astype(np.float64)
        for i in range(1, len(x)):
            x[i] -= self.lower[i, :i] @ x[:i]
        for k, pivot in self.pivots:
            if len(pivot) == 2:
                x[k:k + 2] = np.linalg.solve(pivot, x[k:k + 2])
            else:
                d = pivot[0, 0]
                x[k] /= d if abs(d) > self.tiny else math.copysign(self.tiny, d)
        for i in range(len(x) - 2, -1, -1):
            x[i] -= self.lower[i + 1:, i] @ x[i + 1:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Spectrum:
    """The leading eigenpairs of a symmetric matrix, numbered from the largest value down."""

    def __init__(self, matrix: np.ndarray, count: int):
        self.matrix, self.n = matrix, len(matrix)
        radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
        self.norm = float((np.abs(matrix.diagonal()) + radius).max(initial=0))
        self.noise = 4 * self.n * EPS * self.norm + TINY
        edge = 2 * self.norm + self.noise
        self.counts = {-edge: self.n, edge: 0}  # eigenvalues above a shift
        self.values, self.vectors, self.within = [], [], []
        for k in range(1, min(count, self.n) + 1):
            self._find(k)

    def above(self, shift: float) -> tuple[int, Factors]:
        factors = Factors(self.matrix - shift * np.eye(self.n))
        self.counts[shift] = factors.positive()
        return self.counts[shift], factors

    def slice(self, k: int) -> tuple[float, float]:
        """The narrowest known interval that holds the k-th value."""
        return (max(s for s, c in self.counts.items() if c >= k),
                min(s for s, c in self.counts.items() if c < k))

    def _apart(self, v: np.ndarray, value: float) -> np.ndarray:
        """``v`` without its part along vectors found before whose values lie close."""
        for w, other in zip(self.vectors, self.values, strict=True):
            if abs(other - value) <= 1e-3 * self.norm + self.noise:
                v = v - (w @ v) * w
        size = float(np.linalg.norm(v))
        return v / size if size else v

    def _find(self, k: int) -> None:
        low, high = self.slice(k)
        while high - low > self.noise and (self.counts[low], self.counts[high]) != (k, k - 1):
            middle = (low + high) / 2
            if not low < middle < high:
                break
            self.above(middle)
            low, high = self.slice(k)
        start = np.random.default_rng(k).normal(size=self.n)
        shift = (low + high) / 2
        v, best = self._apart(start, shift), None
        for _ in range(100):
            count, factors = self.above(shift)
            low, high = self.slice(k)
            v = self._apart(factors.solve(v), shift)
            value = float(v @ self.matrix @ v)
            residual = float(np.linalg.norm(self.matrix @ v - value * v))
            inside = low - self.noise <= value <= high + self.noise
            if inside and (best is None or residual < best[0]):
                best, better = (residual, value, v), True
            else:
                better = False
            if best and best[0] <= self.noise and (not better or best[0] <= self.noise / 64):
                break
            # the quotient is the next shift; outside the slice, its middle halves it instead
            shift = value if low < value < high and better else (low + high) / 2
        residual, value, v = best or (residual, (low + high) / 2, v)
        slack, edge = 2 * residual + self.noise, 2 * self.norm + self.noise
        while slack < edge and not (self.above(value - slack)[0] >= k > self.above(value + slack)[0]):
            slack *= 8
        self.values.append(value)
        self.vectors.append(v * (1 if v[int(np.abs(v).argmax())] > 0 else -1))
        self.within.append(slack)


# --------------------------------------------------------------------------- in tasks
def integers(vectors: pa.Array, dims: int, scale: float) -> np.ndarray:
    """floor(scale * c) of equally long vectors, one row each."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype(np.int64).reshape(-1, dims)


def cells(totals: dict[int, int]) -> Iterator[pa.RecordBatch]:
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             pa.array([Decimal(int(v)) for v in totals.values()], pa.decimal128(38, 0))], ["cell", "total"])


def summed(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray], dims: int,
           scale: float) -> dict[int, int]:
    """Exact sums over all rows of a vector of integers that ``part`` makes of a block of rows.

    Returns them by position, with the number of rows at -1.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, None
        for batch in batches:
            x = integers(batch.column(0), dims, scale)
            for at in range(0, len(x), BLOCK):
                own = part(x[at:at + BLOCK]).astype(object)
                total = own if total is None else total + own
            rows += len(x)
        if total is not None:
            yield from cells({-1: rows} | dict(enumerate(total)))

    found = vectors.select("v").mapInArrow(sums, "cell int, total decimal(38,0)")
    return {r["cell"]: int(r["total"]) for r in
            found.groupBy("cell").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()}


def products(d: np.ndarray) -> np.ndarray:
    """Sums of the products of all pairs of columns, exact."""
    large = np.abs(d).max(axis=1, initial=0) >= SMALL
    small = d[~large].astype(np.float64)
    out = (small.T @ small).astype(np.int64).ravel()
    if large.any():  # as Python's integers
        rest = d[large].astype(object)
        out = out.astype(object) + (rest.T @ rest).ravel()
    return out


def deviations(d: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sums of (n * d - rest) ** 2 over each row, exact; null beyond a long."""
    most = (n * (int(np.abs(d).max(initial=0)) + 1)) ** 2 * max(d.shape[1], 1)
    if most <= LONG:
        return ((n * d - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    far = n * d.astype(object) - np.array(rest, object)
    return [v if v <= LONG else None for v in (int(x) for x in (far * far).sum(axis=1))]


# -------------------------------------------------------------------------- on Spark
class Fit:
    """Means, covariance and leading eigenpairs of all usable vectors."""

    def __init__(self, vectors: DataFrame, dims: int, components: int, scale: float, offset: int):
        self.dims, self.scale, self.offset = dims, scale, offset
        sums = summed(vectors, lambda x: x.sum(axis=0), dims, scale) if dims else {}
        self.n = n = sums.get(-1, 0)
        self.mean, self.rest = [], []  # the nearest whole means; the sums of what is left
        self.values, self.roots, self.axes, self.trace, self.spectrum = [], [], None, 0.0, None
        if not n:
            return
        # x - mean is the same before the offset is added and after
        self.mean = [(2 * sums[i] + n) // (2 * n) for i in range(dims)]
        self.rest = [sums[i] - n * m for i, m in enumerate(self.mean)]
        mean = np.array(self.mean, np.int64)
        g = summed(vectors, lambda x: products(x - mean), dims, scale)
        covariance = np.empty((dims, dims))
        for i in range(dims):
            for j in range(i + 1):
                exact = n * g[i * dims + j] - self.rest[i] * self.rest[j]
                covariance[i, j] = covariance[j, i] = exact / (n * n)
        self.covariance, self.trace = covariance, float(covariance.trace())
        self.spectrum = Spectrum(covariance, components)
        self.values = self.spectrum.values
        self.axes = np.stack(self.spectrum.vectors, axis=1)
        # a value that is zero to rounding cannot be divided by
        self.roots = [math.sqrt(v) if v > max(16 * self.spectrum.noise, 0) else None for v in self.values]

    def coordinates(self, d: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole differences from ``mean``; nan where there is no root."""
        left = d - np.array(self.rest, np.float64) / self.n
        with np.errstate(invalid="ignore"):
            return left @ self.axes / np.array([r or math.nan for r in self.roots])


def identity_error(vectors: DataFrame, fit: Fit) -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    live = [i for i, r in enumerate(fit.roots) if r]
    if not live:
        return None
    k, mean = len(live), np.array(fit.mean, np.int64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = fit.coordinates(integers(batch.column(0), fit.dims, fit.scale) - mean)[:, live]
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                         ["cell", "total"])

    found = vectors.select("v").mapInArrow(sums, "cell int, total double").groupBy("cell").agg(F.sum("total"))
    total = np.array([t for _, t in sorted(found.collect())]) / fit.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def usable_vectors(embeddings: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that take part, and the length of their vectors."""
    rows = embeddings.select(F.col(id_column).alias("vec_id"),
                             F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(usable("v") & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = lengths[0]["n"] if lengths else 0
    return rows.where(F.size("v") == dims), dims


def whitened(embeddings: DataFrame, components: int = 8, scale: float = 1024.0, offset: int = 100_000,
             id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error."""
    vectors, dims = usable_vectors(embeddings, id_column, vector_column)
    fit = Fit(vectors, dims, components, scale, offset)
    error = identity_error(vectors, fit) if fit.n else None
    schema = (f"vec_id {dict(vectors.dtypes)['vec_id']}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if not fit.n:
        return embeddings.sparkSession.createDataFrame([], schema)
    k, mean = len(fit.values), np.array(fit.mean, np.int64)
    shares = [(v / fit.trace if r else 0.0) if fit.trace > 0 else None
              for v, r in zip(fit.values, fit.roots, strict=True)]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = integers(batch.column(1), fit.dims, fit.scale) - mean
            rows = np.repeat(np.arange(len(d)), k)
            w = fit.coordinates(d).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(d))),
                 pa.array(np.full(len(rows), fit.n, np.int64)),
                 pa.array(deviations(d, fit.n, fit.rest), pa.int64()).take(pa.array(rows)),
                 pa.array(w, mask=np.isnan(w)),
                 pa.array(shares * len(d), pa.float64()),
                 pa.array([error] * len(rows), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(projected, schema)
