"""Embedding whitening by an incremental eigendecomposition.

A spectrum is the eigendecomposition of the scatter of the vectors seen so far, with their number and mean. A partition
takes its vectors in by centred rank-one updates: ``Q diag(d) Q' + r v v'`` has eigenvalues that are the roots of the
secular equation ``1 + r sum z_i^2 / (d_i - x) = 0`` with ``z = Q' v``; entries of ``z`` that are negligible, and all but one
of equal eigenvalues, are deflated. Spectra are combined by as many rank-one updates as one of them has eigenvalues,
and one for the difference of the means, in a tree over the partitions. The combined eigenvectors then span the
space in which the exact covariance is taken in a second pass (Rayleigh-Ritz), which gives the components.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from talklake.llm.common import written

#: Entries are multiplied by this and floored.
GRID = 256
#: Vectors that are turned into as many centred rows as there are dimensions before they are taken in.
BLOCK = 2048
#: Spectra that one task combines.
FAN_IN = 16
#: Largest size of a vector; the spectrum, its square, is sent to every task.
MAX_SIZE = 2048
COMPONENTS = 4
EPS = np.finfo(float).eps
SPECTRUM = "part bigint, size int, n bigint, sums binary, mean binary, eigenvalues binary, vectors binary"


# --- one rank-one update --------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + rho sum z_i^2 / (d_i - x)``, each as the nearest pole's place and the distance from it.

    ``d`` is ascending and distinct, ``z`` has no zeros, ``rho > 0``; one root lies above each pole. Distances keep the digits
    that a root close to its pole would lose. All roots are iterated together: a rational function with the
    two neighbouring poles is fitted to value and slope, and halving keeps each root in its bracket.
    """
    n = len(d)
    weight = rho * z * z
    upper = np.append(d[1:], d[-1] + weight.sum())
    gap = upper - d
    half = gap / 2
    at_half = 1 + (weight / (d[None, :] - (d + half)[:, None])).sum(axis=1)
    place = np.arange(n)
    right = (at_half < 0) & (place < n - 1)
    origin = place + right
    low = np.where(right, -half, np.where(at_half < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(at_half < 0, gap, half))
    delta = d[None, :] - d[origin][:, None]
    lower_part = place[None, :] <= place[:, None]
    left_pole = d - d[origin]
    right_pole = upper - d[origin]
    x = (low + high) / 2
    for _ in range(120):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            away = delta - x[:, None]
            term = weight / away
            slope = term / away
            psi, phi = np.where(lower_part, term, 0).sum(axis=1), np.where(lower_part, 0, term).sum(axis=1)
            dpsi, dphi = np.where(lower_part, slope, 0).sum(axis=1), np.where(lower_part, 0, slope).sum(axis=1)
            value = 1 + psi + phi
            low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
            settled = (np.abs(value) <= 4 * n * EPS * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
            if settled.all():
                break
            a, b = left_pole - x, right_pole - x
            s, t = a * a * dpsi, b * b * dphi
            c = value - a * dpsi - b * dphi
            # c + s / (a - y) + t / (b - y) = 0, for the step y.
            p, q = c * (a + b) + s + t, c * a * b + s * b + t * a
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            step = np.where(p > 0, 2 * q / (p + root), np.where(c != 0, (p - root) / (2 * c), q / p))
            new = x + step
            halved = (low + high) / 2
            x = np.where(settled, x, np.where(np.isfinite(new) & (new > low) & (new < high), new, halved))
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The eigendecomposition of ``Q diag(values) Q' + rho v v'``, ascending; ``rho`` is not negative."""
    z = vectors.T @ v
    norm = float(np.linalg.norm(z))
    if not rho * norm * norm > 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    small = 8 * EPS * max(np.abs(values).max(), rho)
    values, vectors = values.copy(), vectors.copy()
    # Deflation: of neighbours that are equal, all weight goes to the last one by a rotation.
    active: list[int] = []
    for i in range(len(values)):
        if rho * abs(z[i]) <= small:
            z[i] = 0.0
            continue
        if active and values[i] - values[active[-1]] <= small:
            j = active.pop()
            r = np.hypot(z[j], z[i])
            c, s = z[i] / r, z[j] / r
            keep = vectors[:, j].copy()
            vectors[:, j] = c * keep - s * vectors[:, i]
            vectors[:, i] = s * keep + c * vectors[:, i]
            z[i], z[j] = r, 0.0
        active.append(i)
    if not active:
        return values, vectors
    at = np.array(active)
    d, za = values[at], z[at]
    origin, x = secular_roots(d, za, rho)
    # Poles minus roots, from the distances; weights that fit the computed roots exactly keep vectors orthogonal.
    away = (d[None, :] - d[origin][:, None]) - x[:, None]
    k = len(d)
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1.0)
    ratio = -away / np.where(np.eye(k, dtype=bool), 1.0, between.T)
    fitted = np.sign(za) * np.sqrt(np.abs(np.prod(ratio, axis=0)) / rho)
    turn = fitted[None, :] / away
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    values[at] = d[origin] + x
    vectors[:, at] = vectors[:, at] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


# --- spectra --------------------------------------------------------------------------


@dataclass
class Spectrum:
    """Number, exact sums, mean, and eigenvalues and vectors of the scatter about the mean."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, [0] * size, np.zeros(size), np.zeros(size), np.eye(size))

    def _shift(self, n: int, mean: np.ndarray) -> None:
        """The rank-one update for ``n`` vectors whose mean is another."""
        apart = mean - self.mean
        total = self.n + n
        self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * n / total)
        self.mean = self.mean + apart * (n / total)
        self.n = total

    def add(self, rows: np.ndarray) -> None:
        """Take whole-number vectors in, a block at a time.

        A block's rows, less the block's mean, become as many rows with the same scatter (the triangle of a QR
        decomposition) as there are dimensions at most; each of these is a rank-one update.
        """
        self.sums = [a + b for a, b in zip(self.sums, column_sums(rows), strict=True)]
        for start in range(0, len(rows), BLOCK):
            part = rows[start : start + BLOCK].astype(np.float64)
            mean = part.mean(axis=0)
            part -= mean
            for row in np.linalg.qr(part, mode="r") if len(part) > part.shape[1] else part:
                self.values, self.vectors = rank_one(self.values, self.vectors, row, 1.0)
            self._shift(len(part), mean)

    def merge(self, other: Spectrum) -> None:
        """Combine with another spectrum, one rank-one update for each of its eigenvalues."""
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self._shift(other.n, other.mean)
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]

    def row(self, part: int) -> list:
        arrays = (np.ascontiguousarray(x, np.float64).tobytes() for x in (self.mean, self.values, self.vectors))
        return [part, len(self.mean), self.n, json.dumps(self.sums).encode(), *arrays]

    @classmethod
    def from_row(cls, size: int, n: int, sums: bytes, mean: bytes, values: bytes, vectors: bytes) -> Spectrum:
        a, b, c = (np.frombuffer(x, np.float64) for x in (mean, values, vectors))
        return cls(n, json.loads(sums), a.copy(), b.copy(), c.reshape(size, size).copy())


def column_sums(rows: np.ndarray) -> list[int]:
    """Exact sums of whole numbers per column."""
    if not len(rows):
        return [0] * rows.shape[1]
    if int(np.abs(rows.astype(np.float64)).max()) * len(rows) < 2**62:
        return rows.sum(axis=0).tolist()
    return [sum(column) for column in rows.T.tolist()]


# --- rows -----------------------------------------------------------------------------


def on_grid(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole-number vectors of the rows that count; see ``gridded``."""
    column = column.cast(pa.list_(pa.float64()))
    fits = pc.equal(pc.list_value_length(column), size).fill_null(False).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(fits)
    flat = column.take(pa.array(places)).flatten()
    values = np.floor(GRID * flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size))
    good = (np.abs(values) < 2.0**62).all(axis=1)
    return places[good], values[good].astype(np.int64)


def gridded(rows: DataFrame, size: int, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, x``: the whole-number vectors of the rows that count.

    Left out are null vectors, those with a null or non-finite entry (also one beyond 2**62 on the grid), and those
    of another size.
    """
    schema = T.StructType([T.StructField("vec_id", rows.schema[vec_id].dataType), T.StructField("x", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = on_grid(batch.column(1), size)
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, size, dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), lists], names=["vec_id", "x"])

    return rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("x")).mapInArrow(run, schema)


def common_size(rows: DataFrame, vector: str) -> int:
    """The size most vectors have; of equally frequent ones the largest, 0 if there is none."""
    sizes = rows.select(F.size(F.col(f"`{vector}`")).alias("size")).where("size > 0").groupBy("size").count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _by_tree(rows: DataFrame, join_up) -> list:
    """Combine rows ``(part, ...)`` until one is left; ``join_up`` is an ``applyInPandas`` function on a few of them.

    A task combines ``FAN_IN`` rows, so neither a task nor the driver holds more, whatever the number of partitions.
    """
    while True:
        count = rows.count()
        if count <= 1:
            return rows.collect()
        grouped = rows.withColumn("part", F.floor(F.col("part") / FAN_IN))
        rows = written(grouped.groupBy("part").applyInPandas(join_up, rows.schema), "tree")


def _spectrum(points: DataFrame, size: int) -> Spectrum | None:
    """The combined spectrum of all rows of ``points (x)``."""
    schema = T.StructType.fromDDL(SPECTRUM)

    def take_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, waiting, held = Spectrum.empty(size), [], 0
        for batch in batches:
            waiting.append(_matrix(batch, size))
            held += len(waiting[-1])
            if held >= BLOCK:
                own.add(np.concatenate(waiting))
                waiting, held = [], 0
        if held:
            own.add(np.concatenate(waiting))
        if own.n:
            columns = [pa.array([v]) for v in own.row(TaskContext.get().partitionId())]
            types = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())

    def join_up(pdf):
        import pandas as pd

        parts = [Spectrum.from_row(size, *r[2:]) for r in pdf.sort_values(["n", "mean"]).itertuples(index=False)]
        whole = parts[-1]
        for other in parts[:-1]:
            whole.merge(other)
        return pd.DataFrame([whole.row(int(pdf["part"].iloc[0]))], columns=schema.fieldNames())

    found = _by_tree(written(points.mapInArrow(take_in, schema), "spectra"), join_up)
    return Spectrum.from_row(*found[0][1:]) if found else None


def _moments(points: DataFrame, size: int, centre: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum of ``y y'`` over all rows, ``y = (x - centre) basis``: centred before anything is multiplied."""
    schema = T.StructType.fromDDL("part bigint, moments binary")
    width = basis.shape[1]
    # The basis is MAX_SIZE squared at most.
    sent = points.sparkSession.sparkContext.broadcast((centre, basis))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        centre, basis = sent.value
        total = np.zeros((width, width))
        for batch in batches:
            y = (_matrix(batch, size) - centre) @ basis
            total += y.T @ y
        columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    def join_up(pdf):
        import pandas as pd

        total = sum(np.frombuffer(m, np.float64) for m in sorted(pdf["moments"]))
        return pd.DataFrame([(int(pdf["part"].iloc[0]), total.tobytes())], columns=schema.fieldNames())

    found = _by_tree(written(points.mapInArrow(add_up, schema), "moments"), join_up)
    return np.frombuffer(found[0]["moments"], np.float64).reshape(width, width).copy()


# --- the operator ---------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``components`` has one unit eigenvector per column, by falling eigenvalue."""

    size: int
    n: int
    sums: tuple[int, ...]
    centre: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def scale(self) -> np.ndarray:
        """What projections are divided by; a component without variance has none."""
        floor = self.size * EPS * max(self.eigenvalues.max(initial=0.0), 0.0)
        return np.sqrt(np.where(self.eigenvalues > floor, self.eigenvalues, np.nan))


def fit(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int | None = None, components: int = COMPONENTS) -> Whitening | None:
    """Learn a whitening from the distinct whole-number vectors of ``rows``; None if no row counts.

    Rows that count are those of ``gridded``; ``size`` is that of most vectors unless given. Equal vectors are
    merged before they are shuffled, so a vector with a third of all rows costs no more than another.
    """
    size = common_size(rows, vector) if size is None else size
    if size > MAX_SIZE:
        raise ValueError(f"vectors of more than {MAX_SIZE} entries")
    if not size:
        return None
    points = written(gridded(rows, size, vec_id, vector).select("x").distinct(), "points")
    whole = _spectrum(points, size)
    if whole is None:
        return None
    centre = np.array([s / whole.n for s in whole.sums])
    # Eigenvectors lose orthogonality in the last digits over many updates.
    basis, _ = np.linalg.qr(whole.vectors)
    in_basis = _moments(points, size, centre, basis) / whole.n
    values, turn = np.linalg.eigh((in_basis + in_basis.T) / 2)
    trace = float(np.trace(in_basis))
    best = np.argsort(-values, kind="stable")[: min(components, size)]
    axes = basis @ turn[:, best]
    # Of both signs, the one that makes the largest entry positive.
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(best))])
    found = Whitening(size, whole.n, tuple(whole.sums), centre, axes, np.maximum(values[best], 0.0), trace, 0.0)
    scale = found.scale()
    used = np.isfinite(scale)
    error = 0.0
    if used.any():
        white = _moments(points, size, centre, found.components[:, used] / scale[used]) / whole.n
        error = float(np.abs(white - np.eye(int(used.sum()))).max())
    return Whitening(found.size, found.n, found.sums, centre, found.components, found.eigenvalues, trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum over the dimensions of ``(n x - S)^2``; null where a long cannot hold it."""
    if not len(x):
        return []
    largest = n * int(np.abs(x).max()) + max(map(abs, sums))
    if largest < 2**31 and largest * largest * x.shape[1] < 2**63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [e if e < 2**63 else None for e in exact]


def whiten(rows: DataFrame, model: Whitening | None, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row that counts and each component.

    Components count from 1. ``whitened`` is null for a component without variance, whose ``explained`` is 0;
    ``deviation`` is null where a long cannot hold it. Repeated rows and ids each have their own results; other
    columns of ``rows`` do not matter. Without a model, or with vectors that were left out, there are none.
    """
    names = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = T.StructType([T.StructField("vec_id", rows.schema[vec_id].dataType), *T.StructType.fromDDL(names).fields])
    own = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("x"))
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)

    # The model travels with the function; it has MAX_SIZE times the number of components entries at most.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = model.components.shape[1]
        scale = model.scale()
        explained = np.where(np.isfinite(scale), model.eigenvalues / model.trace if model.trace > 0 else 0.0, 0.0)
        for batch in batches:
            places, x = on_grid(batch.column(1), model.size)
            white = ((x - model.centre) @ model.components) / scale
            columns = [
                batch.column(0).take(pa.array(np.repeat(places, width))),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(places))),
                pa.array(np.full(white.size, model.n, np.int64)),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(places)), width))),
                pa.array(white.ravel(), from_pandas=True),
                pa.array(np.tile(explained, len(places))),
                pa.array(np.full(white.size, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return own.mapInArrow(run, schema)
