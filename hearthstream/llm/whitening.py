"""Whitening of vectors by eigenvectors refined in mixed precision.

A vector's components become whole numbers x = floor(64 c) + 1000000.  Each
distinct x vector counts once: the fit list.  Over it Spark sums the dimensions
exactly and then the products of the centred components; tasks keep one matrix each,
and a fixed number of merging tasks adds them up, in the order of the parts, so that a
repeated task repeats its sum.

The covariance's eigenvectors are found in single precision and corrected by
Ogita-Aishima iterations: from R = I - X'X and S = X'VX each sweep takes a first-order
correction of X, by matrix products in double precision and at the end in extended
precision, where the hardware has it.  Eigenvalues too close for their vectors to be
told apart are a cluster: its vectors are only made orthogonal by the correction, and a small
eigenproblem of the shifted matrix inside their span separates them.

The identity error is measured, not assumed: the fit list is whitened and its covariance
computed in a pass of its own.

Defined results: a vector that is null, empty, or holds a null, a non-finite number or
one of 2^53 or more is dropped, whatever its id; repeated rows and rows without an
id are kept.  Vectors of different lengths are whitened apart, each length by its own fit
list.  Components have a variance above 1e-12 of the largest one: a fit list of one
vector has none and gives no rows, and fewer than 16 dimensions give fewer rows.  A
deviation beyond 64 bits is null.  The sign of a component makes its largest
coordinate positive.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, stage

SCALE = 64
BASE = 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 53)  # components from here on are not exact in double precision
LEAST_VARIANCE = 1e-12
SWEEPS = 12
MERGING_TASKS = 32
SAFE = 1 << 62


# Vectors on the grid


def grid_vectors(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row its dimension (0: unusable) and first value, and floor(scale * c) of all values."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    bad = ~(np.abs(flat) < LARGEST)  # null and NaN compare false
    dims = lengths.copy()
    dims[rows[bad]] = 0
    values = np.floor(np.where(bad, 0, flat) * scale).astype(np.int64)
    return dims, np.cumsum(lengths) - lengths, values


def of_dimension(grid: tuple[np.ndarray, np.ndarray, np.ndarray], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and the matrix of the usable vectors of one length."""
    dims, starts, values = grid
    rows = np.flatnonzero(dims == dim)
    return rows, values[starts[rows][:, None] + np.arange(dim)]


def _pack(y: np.ndarray) -> bytes:
    """Whole numbers in the smallest width that holds them all: equal vectors, equal bytes."""
    most = int(np.abs(y).max())
    return y.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _unpack(raws: list[bytes], dim: int) -> np.ndarray:
    if len({len(r) for r in raws}) == 1:
        width = len(raws[0]) // dim
        return np.frombuffer(b"".join(raws), f"<i{width}").reshape(-1, dim).astype(np.int64)
    return np.stack([np.frombuffer(r, f"<i{len(r) // dim}").astype(np.int64) for r in raws])


def fit_list(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(dim, y): every distinct usable vector once, as packed whole numbers x - BASE.

    Rows are distinct within a task before the shuffle, so a vector with a third of all
    rows is one row per task.
    """
    schema = pa.schema([("dim", pa.int32()), ("y", pa.binary())])

    def work(batches):
        for batch in batches:
            dims, starts, values = grid_vectors(batch.column(0))
            rows = np.flatnonzero(dims)
            yield batch_of(
                schema,
                [dims[rows].tolist(), [_pack(values[s : s + d]) for s, d in zip(starts[rows], dims[rows], strict=True)]],
            )

    return map_batches(vectors.select(vector), work, "dim int, y binary").distinct()


def numerators(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exactly: in 64 bits where they are enough, else as Python numbers."""
    if not y.size:
        return y
    if n * int(np.abs(y).max()) + max(map(abs, sums)) < SAFE:
        return n * y - np.array(sums, np.int64)
    return n * y.astype(object) - np.array(sums, object)


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (numerators(y, n, sums) / n).astype(np.float64)


def squared_deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exactly; null beyond 64 bits."""
    d = numerators(y, n, sums)
    if d.size and d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] >= SAFE:
        d = d.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


# Sums over all tasks


@dataclass
class Moments:
    """Number, mean and centred products of rows, mergeable."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        off = rows - mean
        return cls(len(rows), mean, off.T @ off)

    @classmethod
    def read(cls, raw: bytes) -> Moments:
        flat = np.frombuffer(raw, "<f8")
        k = round((np.sqrt(4 * len(flat) - 3) - 1) / 2)  # 1 + k + k * k numbers
        return cls(int(flat[0]), flat[1 : k + 1], flat[k + 1 :].reshape(k, k))

    def bytes(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.products.ravel()]).astype("<f8").tobytes()

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            n, self.mean + gap * (other.n / n),
            self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n),
        )


class Sums(list):
    """Exact sums of whole numbers per dimension."""

    @classmethod
    def of(cls, y: np.ndarray) -> Sums:
        small = int(np.abs(y).max()) * len(y) < SAFE
        return cls(int(v) for v in (y if small else y.astype(object)).sum(axis=0))

    @classmethod
    def read(cls, raw: bytes) -> Sums:
        return cls(map(int, raw.split()))

    def bytes(self) -> bytes:
        return " ".join(map(str, self)).encode()

    def __add__(self, other: Sums) -> Sums:
        return Sums(a + b for a, b in zip(self, other, strict=True))


def total(fit: DataFrame, dim: int, kind: type, of: Callable[[np.ndarray], object]):
    """Sum of ``of(y)`` over the fit list's vectors of one length.

    Each task sends one row, a fixed number of tasks adds these up, and their rows
    meet on the driver.
    """
    schema = pa.schema([("part", pa.int32()), ("body", pa.binary())])

    def row(part: int, state) -> pa.RecordBatch:
        return batch_of(schema, [[part], [state.bytes()]])

    def add(batches):
        state = None
        for batch in batches:
            if batch.num_rows:
                more = of(_unpack(batch.column(0).to_pylist(), dim))
                state = more if state is None else state + more
        if state is not None:
            yield row(TaskContext.get().partitionId(), state)

    def merge(batches):
        state, first = None, 0
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = part if state is None else first
                state = kind.read(body) if state is None else state + kind.read(body)
        if state is not None:
            yield row(first, state)

    parts = map_batches(fit.where(F.col("dim") == dim).select("y"), add, "part int, body binary")
    merged = map_batches(
        parts.repartition(MERGING_TASKS, "part").sortWithinPartitions("part"), merge, "part int, body binary"
    ).collect()  # at most one row per merging task
    states = [kind.read(bytes(r.body)) for r in sorted(merged, key=lambda r: r.part)]
    out = states[0]
    for state in states[1:]:
        out = out + state
    return out


# Eigenvectors


def correction(a: np.ndarray, x: np.ndarray, kind=np.float64) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima sweep: better vectors, their values, what counts as close, and the step taken."""
    a, x = a.astype(kind), x.astype(kind)
    r = np.eye(len(a), dtype=kind) - x.T @ x
    s = x.T @ (a @ x)
    # Rounding apart, both are symmetric; the step then keeps the vectors orthogonal.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = (s - np.diag(values)).astype(np.float64)
    close = 2 * (np.linalg.norm(off, 2) + np.linalg.norm(a.astype(np.float64), 2) * np.linalg.norm(r.astype(np.float64), 2))
    gaps = values[None, :] - values[:, None]
    far = np.abs(gaps) > close
    step = np.where(far, (s + values[None, :] * r) / np.where(far, gaps, 1), r / 2)
    return x + x @ step, values, float(close), float(np.abs(step).max())


def clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Index sets of two or more eigenvalues that are linked by gaps of at most ``close``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def separate(a: np.ndarray, x: np.ndarray, values: np.ndarray, close: float) -> np.ndarray:
    """Vectors of every cluster turned inside its span, by the eigenvectors of the shifted matrix there."""
    x = x.copy()
    for own in clusters(values, close):
        basis = np.linalg.qr(x[:, own].astype(np.float64))[0].astype(np.longdouble)
        shift = values[own].mean()
        inner = basis.T @ (a.astype(np.longdouble) @ basis - shift * basis)
        size = float(np.abs(inner).max())
        if size:
            inner = ((inner + inner.T) / (2 * size)).astype(np.float64)
            x[:, own] = basis @ np.linalg.eigh(inner)[1].astype(np.longdouble)
    return x


def eigenvectors(matrix: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, largest first, and their unit vectors as columns."""
    size = float(np.abs(matrix).max()) if matrix.size else 0.0
    if not size:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    a = matrix / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    for kind in (np.float64, np.longdouble):
        before = np.inf
        for _ in range(sweeps):
            x, values, close, step = correction(a, x, kind)
            x = separate(a, x, values, close).astype(kind)
            # A step leaves an error of about its square.
            if step * step < np.finfo(kind).eps or step >= before / 2:
                break
            before = step
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((x * (a.astype(np.longdouble) @ x)).sum(axis=0) * size).astype(np.float64)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    largest = np.abs(x).argmax(axis=0)
    return values[order], x * np.where(x[largest, np.arange(len(order))] < 0, -1.0, 1.0)


# Whitening


@dataclass
class Whitening:
    """What whitens the vectors of one length."""

    n: int
    sums: list[int]  # of x - BASE
    axes: np.ndarray  # columns, divided by the square root of their variance
    explained: np.ndarray
    identity_error: float

    def apply(self, y: np.ndarray) -> np.ndarray:
        return centred(y, self.n, self.sums) @ self.axes


def fit_whitening(fit: DataFrame, dim: int, n: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of a fit list's ``n`` vectors of length ``dim``."""
    sums = total(fit, dim, Sums, Sums.of)
    moments = total(fit, dim, Moments, lambda y: Moments.of(centred(y, n, sums)))
    covariance = moments.products / n
    values, axes = eigenvectors((covariance + covariance.T) / 2)
    some = int((values[:components] > LEAST_VARIANCE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    found = Whitening(
        n, sums, axes[:, :some] / np.sqrt(values[:some]), values[:some] / np.trace(covariance) if some else values[:0], 0.0
    )
    if some:
        white = total(fit, dim, Moments, lambda y: Moments.of(found.apply(y)))
        found.identity_error = float(np.abs(white.products / n - np.eye(some)).max())
    return found


def whiten_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Per usable row and component: ``whitened`` and what describes the fit."""
    fit = stage(fit_list(vectors, vector), "fit-list")
    # One small model per vector length.
    models = {
        r.dim: fit_whitening(fit, r.dim, r["count"], components)
        for r in fit.groupBy("dim").count().orderBy("dim").collect()
    }
    chosen = vectors.select(F.col(id_column).alias("_id"), F.col(vector).alias("_vector"))
    numbers = ["whitened", "explained", "identity_error"]

    def work(batches):
        for batch in batches:
            grid = grid_vectors(batch.column(1))
            for dim, model in models.items():
                rows, y = of_dimension(grid, dim)
                k = model.axes.shape[1]
                if not len(rows) or not k:
                    continue
                each = len(rows)
                values = [
                    batch.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), each)),
                    pa.array(np.full(each * k, model.n, np.int64)),
                    pa.array([d for d in squared_deviations(y, model.n, model.sums) for _ in range(k)], pa.int64()),
                    pa.array(model.apply(y).ravel()),
                    pa.array(np.tile(model.explained, each)),
                    pa.array(np.full(each * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(values, names=["_id", "component", "n", "deviation", *numbers])

    kind = chosen.schema["_id"].dataType.simpleString()
    return map_batches(
        chosen, work,
        f"_id {kind}, component int, n bigint, deviation bigint, " + ", ".join(f"{c} double" for c in numbers),
    ).withColumnRenamed("_id", id_column)
