"""Whitening of embeddings: spectra grown by rank-one updates, combined, and refined over all rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, grouped, store, tasks_for

_EPS = np.finfo(float).eps
#: Vectors of the fit list that one task grows a spectrum from, and spectra that one task combines.
PART, FAN = 8192, 8
_SPECTRUM = "id long, n long, mean binary, values binary, vectors binary"


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho * z z', and the matrix of d[j] - eigenvalue[i] in row i. d rises strictly, no entry of
    z is zero, rho is positive; z has unit length. Each root lies between its entry of d and the next one and is told as
    its distance from the nearer of the two, so that close ones keep their digits. The sums over the entries on either
    side of a root are replaced by a simple fraction each that has the same value and slope, and the quadratic that
    this leaves is solved, until the equation holds to rounding; a step out of the bracket halves it."""
    k = len(d)
    w = rho * z * z
    low, high = np.zeros(k), np.append(np.diff(d), rho)
    below = np.tri(k, dtype=float) * w  # entries up to the root's own
    above = w - below
    half = high / 2
    gap = d[None, :] - d[:, None]
    at_half = 1 + (w / (gap - half[:, None])).sum(axis=1)
    far = at_half < 0  # the root is nearer to the next entry
    far[-1] = False
    origin = np.where(far, np.append(d[1:], d[-1]), d)
    delta = d[None, :] - origin[:, None]
    low, high = np.where(far, -half, 0.0), np.where(far, 0.0, half)
    if at_half[-1] < 0:
        low[-1], high[-1] = half[-1], rho
    own, nxt = delta[np.arange(k), np.arange(k)], np.append(delta[np.arange(k - 1), np.arange(1, k)], np.inf)
    eta = (low + high) / 2
    for _ in range(60):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            t = 1 / (delta - eta[:, None])
            psi, phi = np.einsum("ij,ij->i", below, t), np.einsum("ij,ij->i", above, t)
            f = 1 + psi + phi
            up = f < 0
            low, high = np.where(up, np.maximum(low, eta), low), np.where(up, high, np.minimum(high, eta))
            there = np.abs(f) <= 2 * k * _EPS * (1 + np.abs(psi) + np.abs(phi))
            if there.all():
                break
            a, b = own - eta, nxt - eta
            t *= t
            slope_l, slope_r = np.einsum("ij,ij->i", below, t), np.einsum("ij,ij->i", above, t)
            q, r = slope_l * a * a, np.where(np.isinf(b), 0.0, slope_r * b * b)
            c = f - slope_l * a - np.where(np.isinf(b), 0.0, slope_r * b)
            b = np.where(np.isinf(b), 0.0, b)
            # c + q / (a - s) + r / (b - s) = 0 for the step s
            one, two = c * (a + b) + q + r, c * a * b + q * b + r * a
            root = np.sqrt(np.maximum(one * one - 4 * c * two, 0))
            step = np.where(one > 0, 2 * two / (one + root), (one - root) / (2 * c))
            step[-1] = a[-1] + q[-1] / c[-1]  # the topmost root has no entry above it
            new = eta + step
            new = np.where((new >= low) & (new <= high), new, (low + high) / 2)
        eta = np.where(there, eta, new)
    return origin + eta, delta - eta[:, None]


@dataclass
class Spectrum:
    """n vectors with their mean; `values` rise and `vectors` has the unit eigenvectors of their scatter matrix (the sum
    of squares about the mean, not divided by n) in its columns."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(d: int) -> Spectrum:
        return Spectrum(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray) -> None:
        """One more vector: a rank-one update by its distance from the mean so far."""
        away = x - self.mean
        self.n += 1
        if self.n > 1:
            self.update(away, (self.n - 1) / self.n)
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The other's vectors as well: one rank-one update for each of its eigenvectors and one for the two means."""
        if not other.n or not self.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        away = other.mean - self.mean
        both = self.n + other.n
        self.update(away, self.n * other.n / both)
        self.mean = self.mean + away * (other.n / both)
        self.n = both

    def update(self, v: np.ndarray, rho: float) -> None:
        """The eigensystem of scatter + rho * v v'. Directions that v doesn't touch keep their pair, and of eigenvalues
        that are equal but for rounding all but one are turned out of v's way; both are deflated. The others are the
        roots of the secular equation; their vectors come from the z that has exactly these roots, which keeps them
        orthogonal."""
        z = self.vectors.T @ v
        size = float(np.sqrt(z @ z))
        if not size or not rho:
            return
        z /= size
        rho = rho * size * size
        d, q = self.values, self.vectors
        tol = 8 * _EPS * max(d[-1], rho)
        close = np.diff(d) <= tol
        if close.any():
            edges = np.flatnonzero(np.concatenate([[True], ~close, [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                norm = float(np.sqrt(z[a:b] @ z[a:b]))
                if b - a < 2 or rho * norm <= tol:
                    continue
                h = z[a:b].copy()  # reflect z onto the last of the equal ones
                h[-1] += norm if h[-1] >= 0 else -norm
                q[:, a:b] -= np.outer(q[:, a:b] @ h, 2 * h / (h @ h))
                z[a : b - 1], z[b - 1] = 0.0, -norm if z[b - 1] >= 0 else norm
        live = np.flatnonzero(rho * np.abs(z) > tol)
        if not len(live):
            return
        whole = len(live) == len(d)
        dl, zl = (d, z) if whole else (d[live], z[live])
        roots, minus = secular_roots(dl, zl, rho)
        apart = dl[:, None] - dl[None, :]
        np.fill_diagonal(apart, 1.0)
        ratio = np.prod(-minus / apart, axis=0)
        made = np.sqrt(np.abs(ratio)) * np.sign(zl)
        w = made[:, None] / minus.T
        w /= np.sqrt(np.einsum("ij,ij->j", w, w))
        if whole:
            self.values, self.vectors = roots, q @ w
            return
        d = d.copy()
        d[live], q[:, live] = roots, q[:, live] @ w
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], q[:, order]

    def row(self, key: int) -> dict[str, list]:
        return {"id": [key], "n": [self.n], "mean": [self.mean.tobytes()], "values": [self.values.tobytes()], "vectors": [np.ascontiguousarray(self.vectors).tobytes()]}


def _spectra(rows: pa.Table) -> Iterator[Spectrum]:
    for n, mean, values, vectors in zip(*(rows.column(c).to_pylist() for c in ("n", "mean", "values", "vectors"))):
        d = len(mean) // 8
        yield Spectrum(n, np.frombuffer(mean), np.frombuffer(values), np.frombuffer(vectors).reshape(d, d).copy())


_ROW = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("values", pa.binary()), ("vectors", pa.binary())])


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists of d whole numbers as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def grow(fit: DataFrame, d: int) -> Spectrum:
    """The spectrum of all rows of fit(x): each task grows one from its rows, FAN of these are combined by one task, level
    by level, and the last one comes to the driver (d * d numbers)."""
    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key = Spectrum.empty(d), -1
        for batch in batches:
            key = batch.column("part")[0].as_py() if key < 0 and batch.num_rows else key
            for x in matrix(batch.column("x"), d).astype(float):
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_pydict(own.row(key), schema=_ROW)

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(batches, "gid"):
            total = Spectrum.empty(d)
            for one in _spectra(rows):
                total.merge(one)
            yield pa.RecordBatch.from_pydict(total.row(key), schema=_ROW)

    made = fit.select("x", F.spark_partition_id().cast("long").alias("part"))
    level = store(made.mapInArrow(grown, _SPECTRUM), "spectra")
    while (left := level.count()) > 1:
        numbered = level.withColumn("gid", F.floor(F.col("id") / FAN)) if left > FAN else level.withColumn("gid", F.lit(0).cast("long"))
        dealt = numbered.repartition(tasks_for(level.sparkSession, left // FAN), "gid").sortWithinPartitions("gid", "id")
        level, last = store(dealt.mapInArrow(combined, _SPECTRUM), "spectra"), level
        discard(last)
    row = level.first()
    discard(level)
    return Spectrum(row.n, np.frombuffer(row.mean), np.frombuffer(row["values"]), np.frombuffer(row.vectors).reshape(d, d).copy())


def total(fit: DataFrame, d: int, width: int, of) -> np.ndarray:
    """of(rows) summed over all rows of fit(x), d by width: each task sums its own, line by line these are added up in
    the order of the tasks, so that a rerun gives the same digits."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = None, -1
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                for at in range(0, batch.num_rows, 4096):
                    more = of(matrix(batch.column("x").slice(at, 4096), d))
                    out = more if out is None else out + more
        if out is not None:
            yield pa.RecordBatch.from_pydict({"line": pa.array(range(len(out)), pa.int64()), "part": pa.array([part] * len(out), pa.int64()), "v": [r.tobytes() for r in out]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for line, rows in grouped(batches, "line"):
            out = None
            for v in rows.column("v").to_pylist():
                more = np.frombuffer(v, dtype=kind)
                out = more.copy() if out is None else out + more
            yield pa.RecordBatch.from_pydict({"line": pa.array([line], pa.int64()), "v": pa.array([out.tobytes()], pa.binary())})

    sample = of(np.zeros((1, d), dtype=np.int64))
    kind = sample.dtype
    made = fit.select("x", F.spark_partition_id().cast("long").alias("part")).mapInArrow(own, "line long, part long, v binary")
    lines = made.repartition(min(len(sample), 64), "line").sortWithinPartitions("line", "part").mapInArrow(added, "line long, v binary").collect()
    out = np.zeros((len(sample), width), dtype=kind)
    for r in lines:
        out[r.line] = np.frombuffer(r.v, dtype=kind)
    return out


@dataclass
class Whitening:
    """n vectors of the fit list with their sums; components in columns, unit length, their eigenvalues and their shares
    of the trace; error: the largest entry of the whitened fit list's covariance less the identity."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.sums / self.n) @ self.components) / np.sqrt(self.values)


def whole_vectors(table: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null and has finite entries alone, with x: floor(256 * entry) of each, as long. Entries
    beyond 2^54 don't fit and count as not finite."""
    c = F.col(column).cast("array<double>")
    sound = F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(c, lambda v: v.isNotNull() & (F.abs(F.coalesce(v, F.lit(0.0))) < float(1 << 54)))
    return table.filter(sound).withColumn("x", F.transform(c, lambda v: F.floor(v * 256).cast("long")))


def fit(rows: DataFrame, d: int, n: int, *, most: int = 4) -> Whitening | None:
    """Fit on each different x of the n rows once. The spectrum that the updates give is refined once over all rows: the
    covariance between its vectors, centred before it is multiplied, is summed up by all tasks, and its own (nearly
    diagonal) eigensystem turns the vectors (Rayleigh-Ritz). None without variance; components whose
    eigenvalue is not above 1e-12 of the largest are left out."""
    distinct = rows.select("x").distinct()
    listed = store(distinct.repartition(tasks_for(rows.sparkSession, -(-n // PART)), "x"), "fit-list")
    n = listed.count()
    sums = total(listed, d, 1, lambda x: x.sum(axis=0).reshape(-1, 1))[:, 0]
    basis = grow(listed, d).vectors
    mean = sums / n

    def between(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ basis
        return y.T @ y

    small = total(listed, d, d, between) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > 1e-12 * max(values[-1], 0)] if values[-1] > 0 else order[:0]
    if not len(order):
        discard(listed)
        return None
    components = basis @ turn[:, order]
    components /= np.sqrt((components * components).sum(axis=0))
    model = Whitening(n, sums, components, values[order], values[order] / np.trace(small), 0.0)
    k = len(order)

    def spread(x: np.ndarray) -> np.ndarray:
        y = np.column_stack([model.project(x), np.ones(len(x))])
        return y.T @ y

    both = total(listed, d, k + 1, spread) / n
    off = both[k, :k]
    model.error = float(np.abs(both[:k, :k] - np.outer(off, off) - np.eye(k)).max())
    discard(listed)
    return model


def whiten(table: DataFrame, *, column: str = "embedding", key: str = "vec_id", most: int = 4) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each row with a sound vector and
    each of the first `most` components.

    Rows with a null vector, with null, NaN or infinite entries, or without entries are left out. Vectors of another
    length than the most frequent one (of equally frequent ones the shorter) are left out too, as no covariance joins
    them. Repeated rows count once in the fit and are given out each; a null key stays null; equal eigenvalues have any
    base of their space, the same for all rows. An empty table, or one without variance, gives no rows; fewer components
    than `most` are given where fewer have variance. Other columns, whatever their names, are ignored. deviation is null
    where it doesn't fit into a long. A spectrum takes d * d numbers, and each update time in proportion to d cubed."""
    rows = whole_vectors(bounded(table).select(F.col(key).alias("vec_id"), F.col(column).alias("v")), "v").select("vec_id", "x")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = f"vec_id {table.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return table.sparkSession.createDataFrame([], schema)
    d = lengths.d
    rows = rows.filter(F.size("x") == d)
    model = fit(rows, d, lengths["count"], most=most)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix(part.column("x"), d)
                white = model.project(x)
                rough = ((x * float(model.n) - model.sums) ** 2).sum(axis=1)
                fits = rough < 2.0**62
                away = ((np.where(fits[:, None], x, 0) * model.n - np.where(fits[:, None], model.sums, 0)) ** 2).sum(axis=1)
                m = len(x)
                deviation = pa.array(np.repeat(away, k), pa.int64(), mask=np.repeat(~fits, k))
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n), pa.int64()),
                    deviation, pa.array(white.reshape(-1)), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(told, schema)
