"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are laid on an integer lattice (``floor(64 c) + 1000000``), so that counts, sums and
deviations are exact.  The fit list holds each distinct lattice vector once, written as
Parquet; V is its covariance (divisor n, centred before multiplying).  V is never formed:
all that is needed of it are products V Q with a narrow block Q, and each is one distributed
pass in which every task centres its rows and adds up Xᵀ(X Q) (``Covariance.times``).

1. A short Lanczos run finds the lower end of the spectrum.
2. A block wider than the wanted components is filtered: a Chebyshev polynomial of V, built by its
   three-term recurrence from such passes, is small on the unwanted interval (lower end to the
   least Ritz value of the block) and grows fast above it.  QR and Rayleigh-Ritz follow.
3. This repeats until every wanted pair is certified: its residual is at rounding level, and a
   fresh block, filtered in the same way orthogonally to the found vectors, has no larger Ritz
   value than the least wanted one.

How it scales: a pass reads the fit list once and shuffles one d x k block per task, added up by Spark's
partial aggregation; what reaches the driver is d x k numbers, whatever the number of rows or tasks.
Copies of a vector collapse before the fit list's shuffle.

Defined results
* rows with a null vector or a null or non-finite entry are dropped, and so are vectors of another length than
  most have (of equally frequent lengths the longest counts) and empty ones;
* entries whose lattice value would leave +-2^53 are held there;
* repeated rows and rows without an id are whitened like any other; copies count once in the fit;
* components beyond the rank (eigenvalue up to 1e-10 of the largest) are not returned, so that a table of
  equal vectors gives no rows, as an empty one does; a deviation that no long holds is null;
* other columns are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 16
GUARD = 16               # columns of the block beyond the wanted components
DEGREE = 10              # of the Chebyshev polynomial, at most
GAIN = 1e10              # of the polynomial, at most: beyond it rounding drowns what is damped
LANCZOS_STEPS = 12
RESIDUAL = 1e-13         # of the largest eigenvalue, times the root of the dimension: rounding level
CYCLES = 40
RANK = 1e-10
SEED = 20
HELD = 1 << 53


# ----------------------------------------------------------- lattice rows

def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite entries and the usual length."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = vectors.where(v.isNotNull() & (F.size(v) > 0) & finite)
    usual = whole.groupBy(F.size(v).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return whole.where(F.size(v) == (usual["length"] if usual else 0))


def _to_lattice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        entries = np.asarray(lists.flatten()).astype(np.float64)
        x = np.clip(np.floor(64 * entries) + 1_000_000, -HELD, HELD).astype("<i8")
        width = 8 * (len(entries) // max(batch.num_rows, 1))
        rows = pa.Array.from_buffers(pa.binary(width), batch.num_rows, [None, pa.py_buffer(x.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column(0), rows.cast(pa.binary())], ["id", "x"])


def lattice(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and x (little-endian longs) of every usable row."""
    rows = usable(vectors, vector).select(F.col(key).alias("id"), F.col(vector).cast("array<double>"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_to_lattice, f"id {id_type}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """A binary column as one row of longs each (offsets make it a view of the buffer)."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view("<i8").reshape(len(column), -1)


# -------------------------------------------------------- distributed sums

@dataclass(frozen=True)
class Centre:
    """n, exact sums, and the mean as a whole and a fraction so that centring loses nothing."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: n, and each dimension's sum as high and low halves that no long overflows."""
    n, high, low = 0, None, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            high, low = (0, 0) if high is None else (high, low)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(high)), pa.int32()), pa.array([n] * len(high), pa.int64()), pa.array(high), pa.array(low)],
            ["dim", "n", "high", "low"])


def centre(fit: DataFrame) -> Centre:
    big = "decimal(38,0)"
    rows = (fit.select("x").mapInArrow(_sums, "dim int, n bigint, high bigint, low bigint").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(big)).alias("high"), F.sum(F.col("low").cast(big)).alias("low"))
            .orderBy("dim").collect())
    return Centre(rows[0]["n"], tuple((int(r["high"]) << 32) + int(r["low"]) for r in rows)) if rows else Centre(0, ())


def _products(batches: Iterator[pa.RecordBatch], at: Centre, q: np.ndarray, project: bool) -> Iterator[pa.RecordBatch]:
    """Per task Xᵀ(X Q) over centred rows, or with ``project`` (X Q)ᵀ(X Q); squares in a further column."""
    total = squares = None
    for batch in batches:
        if batch.num_rows:
            x = at.centred(_matrix(batch.column(0)))
            z = x @ q
            part = (z if project else x).T @ z
            square = (z if project else x).sum(axis=0) if project else (x * x).sum(axis=0)
            total, squares = (part, square) if total is None else (total + part, squares + square)
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array(squares)] + [pa.array(c) for c in total.T],
            ["dim", "extra", *(f"c{j}" for j in range(total.shape[1]))])


class Covariance:
    """V of a fit list, by passes over it."""

    def __init__(self, fit: DataFrame):
        self.fit, self.at, self.passes, self.trace = fit, centre(fit), 0, 0.0
        self.dims = len(self.at.sums)

    def _sum(self, q: np.ndarray, project: bool) -> tuple[np.ndarray, np.ndarray]:
        self.passes += 1
        names = [f"c{j}" for j in range(q.shape[1])]
        step = partial(_products, at=self.at, q=np.ascontiguousarray(q), project=project)
        rows = (self.fit.select("x").mapInArrow(step, "dim int, extra double, " + ", ".join(f"{c} double" for c in names))
                .groupBy("dim").agg(*[F.sum(c).alias(c) for c in ["extra", *names]]).collect())
        rows.sort(key=lambda r: r["dim"])
        return np.array([[r[c] for c in names] for r in rows]) / self.at.n, np.array([r["extra"] for r in rows]) / self.at.n

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q; the trace of V comes along."""
        product, squares = self._sum(q, project=False)
        self.trace = float(squares.sum())
        return product

    def identity_error(self, w: np.ndarray) -> float:
        """Largest entry by which the covariance of the fit list times ``w`` differs from the identity."""
        second, mean = self._sum(w, project=True)
        return float(np.abs(second - np.outer(mean, mean) - np.eye(w.shape[1])).max())


# ------------------------------------------------------- subspace iteration

def lower_end(v: Covariance, steps: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum, from a Lanczos run (kept orthogonal): least Ritz value less its residual."""
    basis, alpha, beta = [], [], []
    q = rng.standard_normal(v.dims)
    q /= np.linalg.norm(q)
    for _ in range(min(steps, v.dims)):
        basis.append(q)
        w = v.times(q[:, None])[:, 0]
        alpha.append(q @ w)
        full = np.array(basis)
        for _ in range(2):
            w = w - full.T @ (full @ w)
        beta.append(np.linalg.norm(w))
        if beta[-1] <= 1e-12 * max(abs(a) for a in alpha):
            break
        q = w / beta[-1]
    ritz, last = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return max(0.0, float(ritz[0] - beta[-1] * abs(last[-1, 0])))


def chebyshev(v: Covariance, q: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """p(V) Q with p the Chebyshev polynomial of [low, high], scaled to one at ``top``."""
    half, mid = (high - low) / 2, (high + low) / 2
    degree = int(np.clip(np.arccosh(GAIN) / np.arccosh((top - mid) / half), 1, degree))
    sigma = first = half / (top - mid)
    y = (v.times(q) - mid * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        q, y = y, (v.times(y) - mid * y) * (2 * following / half) - sigma * following * q
        sigma = following
    return y


def rayleigh_ritz(v: Covariance, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and residual norms in the span of ``y``."""
    q, _ = np.linalg.qr(y)
    vq = v.times(q)
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, vq = q @ turn, vq @ turn
    return values, q, np.linalg.norm(vq - q * values, axis=0)


def eigenpairs(v: Covariance, wanted: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of V and their unit vectors (columns), certified."""
    rng = np.random.default_rng(SEED)
    wanted, width = min(wanted, v.dims), min(wanted + guard, v.dims)
    values, q, residual = rayleigh_ritz(v, rng.standard_normal((v.dims, width)))
    if width == v.dims or values[0] <= 0:      # the block spans all there is
        return values[:wanted], q[:, :wanted]
    low, exact = lower_end(v, LANCZOS_STEPS, rng), RESIDUAL * np.sqrt(v.dims)
    for _ in range(CYCLES):
        high = min(max(values[-1], low + 1e-9 * values[0]), values[0] * (1 - 1e-9))
        low = min(low, high - 1e-9 * values[0])
        q = chebyshev(v, q, degree, low, high, values[0])
        values, q, residual = rayleigh_ritz(v, q)
        if residual[:wanted].max() > exact * values[0]:
            continue
        found = q[:, :wanted]
        probe = rng.standard_normal((v.dims, min(guard, v.dims - wanted)))
        probe = chebyshev(v, probe - found @ (found.T @ probe), degree, low, high, values[0])
        probe = probe - found @ (found.T @ probe)
        probe_values, probe_q, _ = rayleigh_ritz(v, probe - found @ (found.T @ probe))
        if probe_values[0] <= values[wanted - 1] + 2 * exact * values[0]:
            return values[:wanted], found
        q = np.hstack([found, probe_q, q[:, wanted:]])[:, :width]      # it shows a larger value: it joins the block
    raise RuntimeError(f"{wanted} components not certified in {CYCLES} cycles: residual {residual[:wanted].max():.3g}")


# ---------------------------------------------------------------- whitening

def _whiten(batches: Iterator[pa.RecordBatch], at: Centre, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    sums = np.array(at.sums, object)
    small = max(abs(s) for s in at.sums) < 1 << 62
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(1))
        z = at.centred(x) @ w
        off = np.abs(at.centred(x)).max() * at.n
        if small and np.abs(x).max() < (1 << 62) // at.n and off * off * x.shape[1] < 1 << 62:
            apart = at.n * x - np.array(at.sums, np.int64)
            deviation = (apart * apart).sum(axis=1).tolist()
        else:
            apart = at.n * x.astype(object) - sums
            deviation = [d if d < 1 << 63 else None for d in (apart * apart).sum(axis=1).tolist()]
        k = w.shape[1]
        at_row = pa.array(np.repeat(np.arange(len(x)), k))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at_row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
             pa.array(deviation, pa.int64()).take(at_row), pa.array(z.ravel())],
            ["id", "component", "deviation", "whitened"])


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: columns of ``vectors`` are the components, ``values`` their eigenvalues."""

    at: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int

    def transform(self, rows: DataFrame, key: str = "vec_id") -> DataFrame:
        """One row per lattice row and component."""
        id_type = rows.schema["id"].dataType.simpleString()
        told = f"id {id_type}, component int, deviation bigint, whitened double"
        if not len(self.values):
            out = rows.sparkSession.createDataFrame([], told)
        else:
            out = rows.mapInArrow(partial(_whiten, at=self.at, w=self.vectors / np.sqrt(self.values)), told)
        shares = [float(e / self.trace) for e in self.values]
        explained = F.element_at(F.array(*[F.lit(s) for s in shares] or [F.lit(0.0)]), F.col("component"))
        return out.select(F.col("id").alias(key), "component", F.lit(self.at.n).cast("bigint").alias("n"), "deviation",
                          "whitened", explained.alias("explained"), F.lit(self.identity_error).alias("identity_error"))


def fit(rows: DataFrame, path: str, wanted: int = COMPONENTS) -> Whitening:
    """Fit on each distinct lattice vector of ``rows`` once; the list is kept at ``path`` (a shared folder)."""
    rows.select("x").distinct().write.parquet(path)
    v = Covariance(rows.sparkSession.read.schema("x binary").parquet(path))
    if not v.at.n:
        return Whitening(v.at, np.empty((0, 0)), np.empty(0), 0.0, 0.0, 0)
    values, vectors = eigenpairs(v, wanted)
    rank = int((values > RANK * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    values, vectors = values[:rank], vectors[:, :rank]
    error = v.identity_error(vectors / np.sqrt(values)) if rank else 0.0
    return Whitening(v.at, vectors, values, v.trace, error, v.passes)
