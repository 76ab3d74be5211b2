"""Embedding whitening: the leading components by Jacobi-Davidson, without the covariance matrix.

The fit list holds each distinct integer vector once. Its covariance V is never formed:
V times a block of vectors is one distributed pass, in which a task centres its rows,
multiplies them by the block and the result by the centred rows again, and adds up. The
solver keeps an orthonormal search space Q with V Q, takes Ritz pairs from it (subspace
Rayleigh-Ritz), and extends it by the solutions t of the correction equations

    (1 - U U') (V - theta) (1 - U U') t = -r,

U being the locked vectors and the current Ritz vectors, solved for all vectors of the
block in step by a few MINRES iterations, each one pass for the whole block. A leading
pair is locked once the residual of a fresh product is at double precision
(TOLERANCE x the leading eigenvalue), and the next ones are sought orthogonally to it.
A space that has grown to most_basis columns restarts from its best Ritz vectors.

Scale: a pass reads the stored fit list and returns one d x block array a task, added up
by SUMMERS tasks before the driver adds theirs; the driver holds d x most_basis numbers.
Only the search for distinct vectors shuffles vectors; the result is one map-only pass.

Defined results: vectors that are null or hold null, NaN or infinite entries give no row;
nor do vectors of other lengths than the fit list's commonest (of equals the smallest),
or empty ones. Components whose variance is zero (to double precision) are left out, so
fewer than `wanted` may come out, none where all vectors are equal. A deviation that does
not fit a long is null. Entries times the scale have to stay within 2^31 or the job stops
with an error. Signs: the entry of largest absolute value is positive. Repeated rows and
ids count as rows of the result; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import materialise

SCALE = 256
WANTED = 4
BLOCK = 8
INNER = 4
MOST_BASIS = 96
MOST_ROUNDS = 300
MOST = 1 << 31
SUMMERS = 16
SLICE_ROWS = 1 << 12
EPS = float(np.finfo(np.float64).eps)


# -- the solver, on the driver; all work on the data is in product() --


def tolerance(d: int) -> float:
    """Residuals at double precision, in units of the leading eigenvalue."""
    return 4 * EPS * max(16, d)


def orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The directions of t outside the span of orthonormal columns; those that vanish are left out."""
    for _ in range(2):
        t = t - against @ (against.T @ t)
        size = np.linalg.norm(t, axis=0)
        t = t[:, size > 0] / size[size > 0]
    u, s, _ = np.linalg.svd(t, full_matrices=False)
    u = u[:, s > 1e-8]
    return np.linalg.qr(u - against @ (against.T @ u))[0]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, by the same number of Lanczos
    steps; apply() multiplies the columns by their operators in one go."""
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(rhs), np.where(live, rhs / np.where(live, beta, 1), 0)
    d_old, d = np.zeros_like(rhs), np.zeros_like(rhs)
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    eta, coupling = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        w = apply(v)
        alpha = (v * w).sum(0)
        w = w - alpha * v - coupling * v_old
        following = np.linalg.norm(w, axis=0)
        rho2, rho3 = s * alpha + c_old * c * coupling, s_old * coupling
        rho1_bar = c * alpha - c_old * s * coupling
        rho1 = np.hypot(rho1_bar, following)
        live = live & (rho1 > 0)
        safe = np.where(live, rho1, 1)
        c_old, s_old = c, s
        c, s = rho1_bar / safe, following / safe
        direction = np.where(live, (v - rho3 * d_old - rho2 * d) / safe, 0)
        d_old, d = d, direction
        x = x + c * eta * direction
        eta = -s * eta
        live = live & (following > EPS * beta)
        v_old, v = v, np.where(live, w / np.where(live, following, 1), 0)
        coupling = following
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, block: int = BLOCK, inner: int = INNER, most_basis: int = MOST_BASIS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leading eigenvalues (falling), unit eigenvectors and residual norms of a positive semidefinite matrix."""
    wanted, block = min(wanted, d), min(block, d)
    most_basis = max(most_basis, 3 * block)
    locked, values, norms = np.zeros((d, 0)), [], []
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, block)))[0]
    aq = product(q)
    for _ in range(MOST_ROUNDS):
        h = q.T @ aq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        q, aq = q @ s, aq @ s
        scale = max([*values[:1], float(theta[0])])
        if scale <= 0:
            return np.zeros(0), np.zeros((d, 0)), np.zeros(0)
        bound = tolerance(d) * scale
        outside = lambda r: r - locked @ (locked.T @ r)  # noqa: E731, B023
        residual = outside(aq - q * theta)
        size = np.linalg.norm(residual, axis=0)
        whole = q.shape[1] + locked.shape[1] == d
        if size[0] <= bound or whole:  # lock on the residual of a fresh product only
            n = min(block, q.shape[1])
            aq[:, :n] = product(q[:, :n])
            residual[:, :n] = outside(aq[:, :n] - q[:, :n] * (q[:, :n] * aq[:, :n]).sum(0))
            size = np.linalg.norm(residual, axis=0)
            take = 0
            while take < n and len(values) + take < wanted and size[take] <= bound:
                take += 1
            values += (q[:, :take] * aq[:, :take]).sum(0).tolist()
            norms += size[:take].tolist()
            locked, q, aq = np.concatenate([locked, q[:, :take]], axis=1), q[:, take:], aq[:, take:]
            if len(values) == wanted:
                order = np.argsort(-np.array(values), kind="stable")
                return np.array(values)[order], locked[:, order], np.array(norms)[order]
            if take:
                continue
            if whole:  # nothing to extend: products of the whole space once more
                q = orthonormal(q, locked)
                aq = product(q)
                continue
        if q.shape[1] + locked.shape[1] + block > min(d, most_basis) and q.shape[1] > 3 * block and d > most_basis:
            q, aq = q[:, : 3 * block], aq[:, : 3 * block]
            theta, residual = theta[: 3 * block], residual[:, : 3 * block]
        n = min(block, q.shape[1])
        u = np.concatenate([locked, q[:, :n]], axis=1)
        project = lambda t: t - u @ (u.T @ t)  # noqa: E731, B023

        def shifted(t: np.ndarray, theta=theta[:n], project=project) -> np.ndarray:
            t = project(t)
            return project(product(t) - t * theta)

        t = project(minres(shifted, -project(residual[:, :n]), inner))
        t = orthonormal(t[:, np.linalg.norm(t, axis=0) > 0], np.concatenate([locked, q], axis=1))[:, : d - locked.shape[1] - q.shape[1]]
        if not t.shape[1]:  # no direction is left in the corrections
            t = orthonormal(np.random.default_rng(seed + q.shape[1]).normal(size=(d, 1)), np.concatenate([locked, q], axis=1))
        q, aq = np.concatenate([q, t], axis=1), np.concatenate([aq, product(t)], axis=1)
    raise RuntimeError(f"{wanted - len(values)} components did not reach double precision in {MOST_ROUNDS} rounds")


# -- the data --


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sliced(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _added(parts: DataFrame, dtype) -> np.ndarray:
    """The sum of equally long arrays, one a task: SUMMERS tasks add them up, the driver adds theirs."""

    def run(batches):
        total = None
        for batch in batches:
            for part in batch.column(0).to_pylist():
                a = np.frombuffer(part, dtype)
                total = a.copy() if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    rows = [np.frombuffer(r.part, dtype) for r in parts.repartition(SUMMERS).mapInArrow(run, "part binary").collect()]
    return np.sum(np.sort(np.array(rows), axis=0), axis=0)


def _over(x: DataFrame, add: Callable[[np.ndarray], np.ndarray], dtype=np.float64) -> np.ndarray:
    """The sum of add(rows as a matrix) over the slices of a table of vectors."""

    def run(batches):
        total = None
        for part in _sliced(batches):
            a = add(_matrix(part.column(0)))
            total = a if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total, dtype).tobytes()], pa.binary())], ["part"])

    return _added(x.select("x").mapInArrow(run, "part binary"), dtype)


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the vectors without null or non-finite entries, as integers floor(scale * entry)."""
    e = F.col(vector_col).cast("array<double>")
    fine = F.coalesce((F.size(e) > 0) & F.forall(e, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))
    return vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(e, lambda c: F.floor(c * float(scale))).alias("x"))


class Whitener:
    """What a fit list gives: its size n and sums, eigenvalues, unit components, the trace, and the identity's error."""

    def __init__(self, x: DataFrame, d: int, wanted: int = WANTED, block: int = BLOCK, inner: int = INNER):
        def counted(rows: np.ndarray) -> np.ndarray:
            if max(rows.max(), -(rows.min() + 1)) >= MOST:
                raise ValueError(f"a scaled entry is beyond {MOST}")
            return np.concatenate([[len(rows)], rows.sum(0)])

        totals = _over(x, counted, np.int64).tolist()
        n, self.sums = totals[0], totals[1:]
        self.n, self.d, self.passes = n, d, 0
        mean = self.mean = np.array([s / n for s in self.sums])
        self.trace = float(_over(x, lambda rows: np.square(rows - mean).sum(0)).sum()) / n

        def product(u: np.ndarray) -> np.ndarray:
            def add(rows: np.ndarray) -> np.ndarray:
                centred = rows - mean
                return (centred.T @ (centred @ u)).ravel()

            self.passes += 1
            return _over(x, add).reshape(d, u.shape[1]) / n

        values, vectors, self.residuals = jacobi_davidson(product, d, wanted, block, inner)
        held = values > tolerance(d) * values[:1].sum()
        self.values, vectors = values[held], vectors[:, held]
        self.vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]) if held.any() else vectors
        self.identity_error = self._identity_error(x) if held.any() else 0.0

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) @ self.vectors / np.sqrt(self.values)

    def _identity_error(self, x: DataFrame) -> float:
        k = len(self.values)
        whiten = Whitener.whiten
        facts = Facts(self)

        def add(rows: np.ndarray) -> np.ndarray:
            w = whiten(facts, rows)
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])

        total = _over(x, add) / self.n
        return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Of each row the exact sum of (n x - S)^2; None beyond a long."""
        n, sums = self.n, self.sums
        most = n * int(max(rows.max(), -rows.min(), 0)) + max(map(abs, sums))
        if self.d * most * most < 1 << 63:
            return np.square(n * rows - np.array(sums, np.int64)).sum(1).tolist()
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in rows.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


class Facts:
    """The numbers of a fitted Whitener that tasks need."""

    def __init__(self, w: Whitener):
        self.n, self.d, self.sums, self.mean, self.values, self.vectors = w.n, w.d, w.sums, w.mean, w.values, w.vectors


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct vector of the commonest length once, stored, and that length (0: there is none)."""
    x = materialise(rows.select("x").distinct())
    lengths = [(r["count"], -r.d) for r in x.groupBy(F.size("x").alias("d")).count().collect()]  # one row a length
    d = -max(lengths)[1] if lengths else 0
    return (x.filter(F.size("x") == d) if len(lengths) > 1 else x), d


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = WANTED, scale: int = SCALE, block: int = BLOCK, inner: int = INNER) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = scaled(vectors, id_col, vector_col, scale)
    x, d = fit_list(rows)
    if not d:
        return vectors.sparkSession.createDataFrame([], OUTPUT)
    model = Whitener(x, d, wanted, block, inner)
    facts, explained, error = Facts(model), model.values / (model.trace or 1.0), model.identity_error

    def run(batches):
        k = len(facts.values)
        for part in _sliced(batches):
            m = _matrix(part.column(1))
            each = np.repeat(np.arange(len(m)), k)
            deviation = pa.array(Whitener.deviations(facts, m), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))), pa.array(np.full(len(each), facts.n)), deviation.take(pa.array(each)),
                    pa.array(Whitener.whiten(facts, m).ravel()), pa.array(np.tile(explained, len(m))), pa.array(np.full(len(each), error)),
                ],
                [c.split()[0] for c in OUTPUT.split(", ")],
            )

    return rows.filter(F.size("x") == d).mapInArrow(run, OUTPUT)
