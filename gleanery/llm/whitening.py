"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors become whole numbers x (``as_integers``), whose sums are exact. The scatter matrix is summed from vectors centred
before multiplying: a matrix per task, added up entry by entry in a shuffle, so the driver gets d * d numbers whatever the
number of tasks. The driver factors it, P'AP = LL' with the largest remaining diagonal entry as pivot, and rotates the columns of
L, pairs of columns at a time, until they are orthogonal: their squared norms are the eigenvalues, the columns over their norms
the components. No product of L with itself is formed, so small eigenvalues keep their digits.

Rows whose vector is null, holds null or non-finite entries, or an entry beyond ``LARGEST`` (its whole number would leave the
exact range of a double) are left out. So are vectors of another length than the most frequent one (of equally frequent ones the longer).
Repeated rows count each; a null id is kept. Components whose eigenvalue is zero to double precision are left out, as nothing
can be divided by it: fewer than asked for come out for few or dependent vectors, and none (no rows) for none, or for equal ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 40)
LONGS = 1 << 63


def usable(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """key and vector (array<double>) of the rows that count, and the length of their vectors (0 without any)."""
    v = F.col(vector).cast("array<double>")
    ok = F.col(vector).isNotNull() & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)), F.lit(False))
    kept = rows.filter(ok).select(F.col(key).alias("key"), v.alias("vector"))
    most = kept.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return kept.filter(F.size("vector") == d), d


def as_integers(part: pa.RecordBatch, d: int) -> np.ndarray:
    flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension: high and low halves are added apart."""

    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for part in batches:
            x = as_integers(part, d)
            n += len(x)
            high += (x >> 20).sum(0)
            low += (x & 0xFFFFF).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], names=["j", "n", "high", "low"])

    got = rows.mapInArrow(run, "j int, n long, high long, low long").groupBy("j").agg(F.sum("n"), F.sum("high"), F.sum("low")).orderBy("j").collect()
    return (got[0][1] if got else 0), [(r[2] << 20) + r[3] for r in got]


def _entries(rows: DataFrame, d: int, of, names: int) -> np.ndarray:
    """Sum over all vectors of the outer products of ``of(x)``, a matrix per batch: upper triangles are added in a shuffle."""
    i, j = np.triu_indices(names)

    def run(batches):
        total, seen = np.zeros((names, names)), False
        for part in batches:
            if part.num_rows:
                y = of(as_integers(part, d))
                total += y.T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    got = rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((names, names))
    for a, b, v in got:
        out[a, b] = out[b, a] = v
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower triangular L (d x rank) and the order of rows with a[order][:, order] = L L', pivots falling; stops at what is zero to double precision."""
    a, d = a.copy(), len(a)
    order, low = np.arange(d), np.zeros((d, d))
    first = max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        rest = a.diagonal()[k:]
        p = k + int(rest.argmax())
        if not rest[p - k] > first * d * np.finfo(float).eps:
            return low[:, :k], order
        for m in (a, a.T, low):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def one_sided_jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``low`` rotated until each two are orthogonal to double precision. Disjoint pairs are rotated together, every pair once a sweep."""
    u = low.copy()
    r = u.shape[1]
    ring = np.arange(r + r % 2)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = ring[: len(ring) // 2], ring[len(ring) // 2 :][::-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            alpha, beta, gamma = (u[:, p] ** 2).sum(0), (u[:, q] ** 2).sum(0), (u[:, p] * u[:, q]).sum(0)
            size = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, size.max(initial=0.0))
            turn = size > np.finfo(float).eps
            p, q, alpha, beta, gamma = p[turn], q[turn], alpha[turn], beta[turn], gamma[turn]
            zeta = (beta - alpha) / (2 * gamma)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            u[:, p], u[:, q] = c * u[:, p] - s * u[:, q], s * u[:, p] + c * u[:, q]
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if worst <= r * np.finfo(float).eps:
            break
    return u


@dataclass
class Whitening:
    """Exact sums, eigenvalues of the covariance (falling) with their unit components as columns, and the covariance's trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def d(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole part and remainder of S/n are taken off one after the other, so that nothing is rounded away."""
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; None where one is beyond a 64-bit number."""
        wide = float(self.n) * np.abs(x).max(initial=0) + max(map(abs, self.sums), default=0)
        if wide * wide * self.d < 2.0**62:
            y = self.n * x - np.array(self.sums)
            return (y * y).sum(1).tolist()
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums], object)
        y = (x - whole).astype(object) * self.n - rest
        return [v if v < LONGS else None for v in (y * y).sum(1)]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    n, sums = _sums(rows, d) if d else (0, [])
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    if not n:
        return model
    scatter = _entries(rows, d, model.centred, d)
    low, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(low)
    values = (turned**2).sum(0)
    best = np.argsort(-values, kind="stable")
    best = best[values[best] > values.max(initial=0.0) * d * np.finfo(float).eps][:components]
    unit = np.zeros((d, len(best)))
    unit[order] = turned[:, best] / np.sqrt(values[best])
    model.values, model.components, model.trace = values[best] / n, unit, float(np.trace(scatter)) / n
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity. Their mean is taken as what it is by construction, zero to rounding."""
    k = len(model.values)
    return float(np.abs(_entries(rows, model.d, model.whiten, k) / model.n - np.eye(k)).max(initial=0.0))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """key, component (from 1), deviation and whitened value of every vector and component."""
    kept = rows.sparkSession.sparkContext.broadcast(model)  # d x 8 numbers

    def run(batches):
        m = kept.value
        k = len(m.values)
        for part in batches:
            x = as_integers(part, m.d)
            rows_at = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(rows_at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(m.deviations(x), pa.int64()).take(pa.array(rows_at)), pa.array(m.whiten(x).ravel())],
                names=["key", "component", "deviation", "whitened"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    done = rows.mapInArrow(run, f"key {kind}, component int, deviation long, whitened double")
    return done if len(model.values) else done.filter("false")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, d = usable(C.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    model = fit(rows, d)
    error = identity_error(rows, model) if len(model.values) else 0.0
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    return whitened(rows, model).select(
        F.col("key").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
