"""Whitening of embeddings by principal components out of contour integrals."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted

SCALE, SHIFT = 64, 1_000_000
# Beyond this an entry is no exact integer in double precision.
LARGEST = float(1 << 52)
SCHEMA = "__id long, component int, deviation long, whitened double"
_MOMENTS = "rows long, mean array<double>, products array<double>"


def whiten(rows, vector="embedding", id="vec_id", components=32):
    """Project integer-scaled vectors on the leading eigenvectors of their covariance, at unit variance.

    Every entry c becomes ``floor(64 c) + 1000000``. A first pass sums entries exactly, a
    second the centred products per task, merged pairwise; what reaches the driver is one
    matrix of the vectors' length squared. :class:`Contour` finds its largest eigenpairs.
    A third pass projects all rows, and the covariance of what it gives is measured
    against the identity.

    Returns ``vec_id`` (named as ``id``), ``component`` from 1, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``. Rows with a null vector, a null or
    non-finite entry are left out; so are, as one covariance needs one length, vectors
    whose length is not the most frequent (ties: the shorter). Zero vectors and rows
    without id take part, and repeated rows count repeatedly. Directions without variance
    have no component, so constant vectors and an empty table give no rows. Entries are
    held within 2^52 on either side. A deviation beyond 64 bits is null.
    """
    column = quoted([vector])[0]
    v = F.col(column).cast("array<double>")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(v) > 0), F.lit(False))
    whole = F.transform(v, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT,
                                                        F.lit(-int(LARGEST))), F.lit(int(LARGEST))).cast("long"))
    named = quoted([id])[0]
    fit = rows.filter(finite).select(F.col(named).cast("long").alias("__id"), whole.alias("x"))
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = rows.sparkSession.createDataFrame([], f"`{id}` long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if lengths is None:
        return empty
    fit = checkpointed(fit.filter(F.size("x") == lengths["d"]))
    n, sums = _sums(fit, lengths["d"])
    covariance = _covariance(_moments(fit.mapInArrow(_centred_products(n, sums), _MOMENTS)), lengths["d"])
    values, vectors = Contour(covariance).largest(components)
    if not len(values):
        return empty
    projected = fit.mapInArrow(_project(n, sums, values, vectors), SCHEMA)
    again = fit.mapInArrow(_white_products(n, sums, values, vectors), _MOMENTS)
    error = float(np.abs(_covariance(_moments(again), len(values)) - np.eye(len(values))).max())
    share = F.element_at(F.array(*[F.lit(float(e / np.trace(covariance))) for e in values]), F.col("component"))
    return projected.select(F.col("__id").alias(id), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                            share.alias("explained"), F.lit(error).alias("identity_error"))


def _matrix(column):
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(fit, dims):
    """The number of rows and the exact sum of every dimension."""

    def task(batches):
        count, total = 0, [0] * dims
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(1))
                count += len(x)
                # Halves of 32 bits, so that no sum of a batch leaves 64 bits.
                high, low = x >> 32, x & 0xFFFFFFFF
                total = [t + (int(h) << 32) + int(m) for t, h, m in zip(total, high.sum(axis=0), low.sum(axis=0))]
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([count] * dims, pa.int64()), pa.array(range(dims), pa.int32()),
                                              pa.array([str(t) for t in total])], names=["rows", "at", "total"])

    parts = fit.mapInArrow(task, "rows long, at int, total string")
    found = (parts.groupBy("at").agg(F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
             .orderBy("at").collect())
    return found[0]["rows"], [int(r["total"]) for r in found]


def _scaled(x, n, sums):
    """x - S/n in double precision: whole parts are taken off as integers first."""
    whole = np.array([s // n for s in sums])
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def _moment(values):
    mean = values.mean(axis=0)
    centred = values - mean
    return len(values), mean, centred.T @ centred


def _merged(a, b):
    """Counts, means and centred products of two sets of rows together."""
    if a is None or b is None:
        return a or b
    rows, apart = a[0] + b[0], b[1] - a[1]
    return rows, a[1] + apart * (b[0] / rows), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / rows)


def _moments_of(rows_of):
    def task(batches):
        kept = None
        for batch in batches:
            if len(batch):
                kept = _merged(kept, _moment(rows_of(_matrix(batch.column(1)))))
        if kept:
            yield _moment_row(kept)
    return task


def _moment_row(kept):
    rows, mean, products = kept
    return pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])],
                                      names=["rows", "mean", "products"])


def _centred_products(n, sums):
    return _moments_of(lambda x: _scaled(x, n, sums))


def _white(x, n, sums, values, vectors):
    return _scaled(x, n, sums) @ vectors / np.sqrt(values)


def _white_products(n, sums, values, vectors):
    return _moments_of(lambda x: _white(x, n, sums, values, vectors))


def _moments(parts):
    """One row out of one row a task: merged in a tree, so no task or driver holds them all."""
    def merge(batches):
        kept = None
        for batch in batches:
            for rows, mean, products in zip(*(c.to_pylist() for c in batch.columns)):
                kept = _merged(kept, (rows, np.array(mean), np.array(products).reshape(len(mean), -1)))
        if kept:
            yield _moment_row(kept)

    parts = checkpointed(parts)
    many = parts.rdd.getNumPartitions()
    while many > 1:
        many = math.ceil(many / 16)
        parts = checkpointed(parts.coalesce(many).mapInArrow(merge, _MOMENTS))
    return parts.first()


def _covariance(moments, dims):
    return np.array(moments["products"]).reshape(dims, dims) / moments["rows"]


def _project(n, sums, values, vectors):
    def task(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.slice(at, 2000)
                x, count = _matrix(some.column(1)), len(values)
                white = _white(x, n, sums, values, vectors)
                parts = np.repeat(_deviations(x, n, sums), count)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(np.repeat(np.arange(len(x)), count))),
                     pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                     pa.array(parts.tolist(), pa.int64()), pa.array(white.ravel())],
                    names=["__id", "component", "deviation", "whitened"])
    return task


def _deviations(x, n, sums):
    """Sum over dimensions of (n x - S)^2, exact; null where 64 bits do not hold it."""
    far = max(max(abs(n * int(x.min()) - s), abs(n * int(x.max()) - s)) for s in sums)
    if far * far * len(sums) < 1 << 62 and n * max(abs(int(x.min())), abs(int(x.max()))) < 1 << 62:
        part = n * x - np.array(sums)
        return (part * part).sum(axis=1).astype(object)
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return np.array([e if e < 1 << 63 else None for e in exact], dtype=object)


class Contour:
    """Eigenpairs of a symmetric matrix inside intervals, by contour integration.

    A projector on the eigenvectors of an interval is the integral of (z - V)^-1 around
    it. ``nodes`` Gauss points on the upper half of a circle stand for the integral; each
    is one solve with a complex shift for a few vectors. Rayleigh-Ritz on what comes out
    gives eigenpairs, and the steps repeat until residuals vanish. How many an interval
    holds is known beforehand from inertia: the eigenvalues above a shift are the
    positive pivots of the matrix less the shift.
    """

    def __init__(self, matrix, nodes=8, most=10, seed=13):
        self.matrix, self.nodes, self.most = (matrix + matrix.T) / 2, nodes, most
        self.draw = np.random.default_rng(seed)
        self.size = float(np.abs(self.matrix).sum(axis=1).max()) if len(matrix) else 0.0
        self.diagonal, self.off = self._tridiagonal()

    def _tridiagonal(self):
        """The matrix by Householder reflections, for pivots that need no exchange."""
        a = self.matrix.copy()
        for k in range(len(a) - 2):
            x = a[k + 1:, k].copy()
            x[0] += math.copysign(float(np.sqrt(x @ x)), x[0])
            norm = float(np.sqrt(x @ x))
            if norm == 0:
                continue
            x /= norm
            a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
            a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
        return np.diag(a).tolist(), np.diag(a, -1).tolist()

    def above(self, shift):
        """The number of eigenvalues above ``shift``."""
        count, pivot, least = 0, 1.0, self.size * 1e-300 + 1e-300
        for k, d in enumerate(self.diagonal):
            pivot = d - shift - (self.off[k - 1] ** 2 / pivot if k else 0.0)
            pivot = pivot if abs(pivot) > least else -least
            count += pivot > 0
        return count

    def _edge(self, nth):
        """A bracket around the nth largest eigenvalue, one part in a million wide."""
        low, high = 0.0, self.size * 1.000001
        while high - low > 1e-6 * high:
            middle = (low + high) / 2
            low, high = (middle, high) if self.above(middle) >= nth else (low, middle)
        return low, high

    def intervals(self, wanted):
        """Cuts in wide gaps between eigenvalues, ``most`` of them or fewer between two cuts where gaps allow."""
        floor = self.size * len(self.diagonal) * 1e-13
        wanted = min(wanted, self.above(floor))
        edges = [self._edge(k) for k in range(1, wanted + 1)]
        top, k = self.size * 1.01, 0
        out = []
        while k < wanted:
            after = [self._edge(wanted + 1) if j == wanted and self.above(floor) > wanted else edges[j] if j < wanted else (floor, floor)
                     for j in range(k + 1, min(k + self.most, wanted) + 1)]
            gaps = [edges[k + j][0] - a[1] for j, a in enumerate(after)]
            last = len(gaps) - 1 if k + len(gaps) == wanted and gaps[-1] > 1e-4 * edges[k][1] else int(np.argmax(gaps))
            low = max(floor, edges[k + last][0] - 0.5 * max(gaps[last], 0.0))
            out.append((low, top))
            top, k = low, self.size and self.above(low)
        return out

    def inside(self, low, high):
        """All eigenpairs between ``low`` and ``high``, largest first."""
        count, size = self.above(low) - self.above(high), len(self.matrix)
        if not count:
            return np.empty(0), np.empty((size, 0))
        highest = min(high, self._edge(self.above(high) + 1)[1] + (high - low) * 1e-3)
        # A circle through the lower cut, and as far above the largest value as there is room.
        centre, radius = (low + highest) / 2, (highest - low) / 2
        if high - highest > 0:
            centre, radius = (low + min(high, highest + radius * 0.2)) / 2, (min(high, highest + radius * 0.2) - low) / 2
        points, weights = np.polynomial.legendre.leggauss(self.nodes)
        angles = np.pi / 2 * (points + 1)
        subspace = min(size, max(count + 6, 2 * count))
        basis = self.draw.normal(size=(size, subspace))
        best = None
        for _ in range(60):
            total = np.zeros((size, subspace))
            for angle, weight in zip(angles, weights):
                z = centre + radius * np.exp(1j * angle)
                solved = np.linalg.solve(z * np.eye(size) - self.matrix, basis.astype(complex))
                total += weight / 2 * (radius * np.exp(1j * angle) * solved).real
            q, _ = np.linalg.qr(total)
            ritz, turn = np.linalg.eigh(q.T @ self.matrix @ q)
            basis = q @ turn
            left = np.sqrt(((self.matrix @ basis - basis * ritz) ** 2).sum(axis=0))
            chosen = np.flatnonzero((ritz > low) & (ritz <= high))
            worst = left[chosen].max() if len(chosen) == count else np.inf
            if best is not None and worst >= 0.5 * best[0] and best[0] <= 1e-11 * self.size:
                break
            if best is None or worst < best[0]:
                best = worst, ritz[chosen][::-1], basis[:, chosen][:, ::-1]
        if not best[0] <= 1e-9 * self.size:
            raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}] and {len(best[1])} were found, residual {best[0]}")
        return best[1], best[2]

    def largest(self, wanted):
        """The ``wanted`` largest eigenvalues, falling, and their unit vectors as columns."""
        if not self.size:
            return np.empty(0), np.empty((len(self.matrix), 0))
        found = [self.inside(low, high) for low, high in self.intervals(wanted)]
        if not found:
            return np.empty(0), np.empty((len(self.matrix), 0))
        values, vectors = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1)
        return values[:wanted], vectors[:, :wanted]
