"""Whitening of vectors by incremental eigendecomposition.

Every task keeps the eigenvalues and eigenvectors of the scatter matrix of the rows it has seen and
changes them row by row: a centred row is a rank-one update, whose new eigenvalues are the roots
of the secular equation 1 + sum z_i^2 / (lambda_i - mu) = 0 between the old ones (components that don't
take part are deflated first).  The spectra of tasks are combined in a tree, one's eigenpairs being
rank-one updates of the other.  Passes of Rayleigh-Ritz over all rows then refine the basis to double precision.

The rows of a task are dealt to lanes, each with a spectrum of its own, so that numpy updates all
lanes at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geospan.llm.common import list_matrix, map_batches, sum_over_rows, tree

EPS = np.finfo(float).eps
LANES = 32


class Spectra:
    """Lanes of (n, mean, eigenvalues, eigenvectors) of scatter matrices; vectors[l][:, j] belongs to values[l][j]."""

    def __init__(self, lanes: int, dim: int):
        self.n = np.zeros(lanes, np.int64)
        self.mean = np.zeros((lanes, dim))
        self.values = np.zeros((lanes, dim))
        self.vectors = np.broadcast_to(np.eye(dim), (lanes, dim, dim)).copy()

    def lanes(self, which) -> Spectra:
        out = Spectra.__new__(Spectra)
        out.n, out.mean, out.values, out.vectors = self.n[which], self.mean[which], self.values[which], self.vectors[which]
        return out

    def put(self, which, other: Spectra) -> None:
        self.n[which], self.mean[which], self.values[which], self.vectors[which] = other.n, other.mean, other.values, other.vectors

    def add_rows(self, x: np.ndarray) -> None:
        """One row for each lane: scatter + n/(n+1) d d', with d the row minus the lane's mean so far."""
        d = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, d * np.sqrt(self.n / (self.n + 1))[:, None])
        self.n = self.n + 1
        self.mean = self.mean + d / self.n[:, None]

    def add_spectra(self, other: Spectra) -> None:
        """Lane by lane: the other's eigenpairs and the step between the means, as rank-one updates."""
        n = self.n + other.n
        with np.errstate(invalid="ignore", divide="ignore"):
            weight = np.where(n > 0, self.n * (other.n / np.maximum(n, 1)), 0)
        step = other.mean - self.mean
        order = np.argsort(-other.values, axis=1)
        for j in range(order.shape[1]):
            at = order[:, j]
            size = np.sqrt(np.maximum(np.take_along_axis(other.values, at[:, None], 1), 0))
            if not size.any():
                break  # by falling size: the rest is zero
            v = np.take_along_axis(other.vectors, at[:, None, None], 2)[:, :, 0] * size
            self.values, self.vectors = rank_one(self.values, self.vectors, v)
        self.values, self.vectors = rank_one(self.values, self.vectors, step * np.sqrt(weight)[:, None])
        self.mean = self.mean + step * (other.n / np.maximum(n, 1))[:, None]
        self.n = n

    def merged(self) -> Spectra:
        """All lanes combined, in halves."""
        one = self
        while len(one.n) > 1:
            half = (len(one.n) + 1) // 2
            left, right = one.lanes(slice(0, half)), one.lanes(slice(half, None))
            some = left.lanes(slice(0, len(right.n)))
            some.add_spectra(right)
            left.put(slice(0, len(right.n)), some)
            one = left
        return one


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of vectors diag(values) vectors' + v v', for lanes at once.

    values (L, d), vectors (L, d, d), v (L, d); the order of the eigenvalues is free.
    """
    z = (v[:, None, :] @ vectors)[:, 0, :]
    length = np.sqrt((z ** 2).sum(axis=1))
    scale = np.maximum(np.abs(values).max(axis=1), length ** 2)
    tol = 8 * EPS * scale
    still = np.divide(tol, length, out=np.full_like(tol, np.inf), where=length > 0)[:, None]
    lam, z, vectors = _poles_last(values, np.where(np.abs(z) <= still, 0, z), vectors)
    z, lam, vectors = _merge_equal(lam, z, vectors, tol)
    lam, z, vectors = _poles_last(lam, np.where(np.abs(z) <= still, 0, z), vectors)
    active = z != 0
    if not active.any():
        return lam, vectors
    roots, gap = _secular_roots(lam, z, active)
    return roots, vectors @ _turn(lam, z, active, gap)


def _poles_last(lam, z, vectors):
    """Deflated components (z is zero) first, the others after them by rising eigenvalue."""
    order = np.argsort(np.where(z != 0, lam, -np.inf), axis=1, kind="stable")
    if (order == np.arange(lam.shape[1])).all():
        return lam, z, vectors
    return (np.take_along_axis(lam, order, 1), np.take_along_axis(z, order, 1), np.take_along_axis(vectors, order[:, None, :], 2))


def _merge_equal(lam, z, vectors, tol):
    """Deflation of equal eigenvalues: a rotation of their two vectors moves all of z to the second."""
    a, b = z[:, :-1], z[:, 1:]
    with np.errstate(invalid="ignore", divide="ignore"):
        near = (lam[:, 1:] - lam[:, :-1]) * np.abs(a * b) <= tol[:, None] * (a * a + b * b)
    if not (near & (a != 0) & (b != 0)).any():
        return z, lam, vectors
    z, lam, vectors = z.copy(), lam.copy(), vectors.copy()
    for i in range(z.shape[1] - 1):
        p, q = z[:, i], z[:, i + 1]
        lanes = np.flatnonzero((p != 0) & (q != 0) & ((lam[:, i + 1] - lam[:, i]) * np.abs(p * q) <= tol * (p * p + q * q)))
        if not len(lanes):
            continue
        r = np.hypot(p[lanes], q[lanes])
        c, s = q[lanes] / r, p[lanes] / r
        z[lanes, i], z[lanes, i + 1] = 0, r
        x, y = vectors[lanes, :, i], vectors[lanes, :, i + 1]
        vectors[lanes, :, i], vectors[lanes, :, i + 1] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
        u, w = lam[lanes, i], lam[lanes, i + 1]
        lam[lanes, i], lam[lanes, i + 1] = c * c * u + s * s * w, s * s * u + c * c * w
    return z, lam, vectors


def _secular_roots(lam, z, active):
    """The roots (deflated components keep their eigenvalue), and gap[l, j, i] = lam_i - root_j without cancellation.

    Between two poles the equation is met by steps of two fitted poles, each inside a bracket that
    shrinks; a step that leaves it is replaced by its middle.  A root is held as its distance to
    the nearer pole.
    """
    lanes, dim = lam.shape
    zz = z * z
    total = zz.sum(axis=1)
    upper = np.concatenate([lam[:, 1:], (lam[:, -1] + total)[:, None]], axis=1)
    width = np.where(active, upper - lam, 1.0)
    far = 4 * np.abs(lam).max(axis=1) + 4 * total + 1
    column = active[:, None, :]
    base = np.where(column, lam[:, None, :] - lam[:, :, None], far[:, None, None])  # pole i seen from pole j
    f = 1 + np.einsum("li,lji->lj", zz, 1 / (base - (width / 2)[:, :, None]))
    right = (f < 0) & active
    right[:, -1] = False  # beyond the last pole there is none to start from
    origin = np.where(right, width, 0.0)
    base = np.where(column, base - origin[:, :, None], base)
    # the pole itself: exact zero
    rows = np.arange(dim)
    here = np.where(right, np.minimum(rows + 1, dim - 1)[None, :], rows[None, :])
    np.put_along_axis(base, here[:, :, None], np.where(active, 0.0, np.take_along_axis(base, here[:, :, None], 2)[:, :, 0])[:, :, None], 2)
    first, second = -origin, width - origin  # the two poles beside the root, seen from the origin
    lo = np.where(right, -width / 2, 0.0)
    hi = np.where(right, 0.0, np.where(rows == dim - 1, width, width / 2))
    tau = (lo + hi) / 2
    lower = np.tri(dim)
    open_ = active.copy()
    for _ in range(80):
        gap = base - tau[:, :, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            term = zz[:, None, :] / gap
            f = 1 + term.sum(axis=2)
            size = 1 + np.abs(term).sum(axis=2)
            term /= gap
            slope = term.sum(axis=2)
            left = np.einsum("lji,ji->lj", term, lower)
            hi = np.where(open_ & (f > 0), tau, hi)
            lo = np.where(open_ & (f <= 0), tau, lo)
            d1, d2 = first - tau, second - tau
            a = (d1 + d2) * f - d1 * d2 * slope
            b = d1 * d2 * f
            c = f - d1 * left - d2 * (slope - left)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        bad = ~((new > lo) & (new < hi))
        new = np.where(bad, (lo + hi) / 2, new)
        done = (np.abs(f) <= 4 * EPS * size) | (new == tau) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        open_ &= ~done
        if not open_.any():
            break
        tau = np.where(open_, new, tau)
    gap = np.where(column, base - tau[:, :, None], 1.0)
    return np.where(active, lam + origin + tau, lam), gap


def _turn(lam, z, active, gap):
    """The eigenvectors in the old basis, as columns, from the z that has exactly these roots (so they're orthogonal)."""
    dim = lam.shape[1]
    rows = np.arange(dim)
    nxt = np.concatenate([lam[:, 1:], lam[:, -1:]], axis=1)
    pair = np.where((rows[:, None] < rows[None, :]), lam[:, :, None], nxt[:, :, None]) - lam[:, None, :]
    pair[:, -1, :] = -1.0  # the last root has no pole of its own left
    both = active[:, :, None] & active[:, None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(both, np.where(rows[:, None] == dim - 1, -gap, gap / -pair), 1.0)
    zhat = np.sqrt(np.maximum(np.prod(ratio, axis=1), 0)) * np.sign(z)
    w = np.where(both, zhat[:, None, :] / np.where(gap == 0, EPS, gap), 0.0)
    w /= np.maximum(np.sqrt((w ** 2).sum(axis=2)), np.finfo(float).tiny)[:, :, None]
    w += np.where(active, 0.0, 1.0)[:, :, None] * np.eye(dim)
    return np.swapaxes(w, 1, 2)


def integer_entries(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """(vec_id, x array<long>): floor(scale * entry) + offset, entries as double; rows whose vector is null or
    holds null or non-finite entries are left out.  Rows without an id stay."""
    fine = F.forall(F.col(vec_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("_v"))
            .where(F.col("_v").isNotNull()).select("vec_id", F.col("_v").alias(vec_col)).where(fine).select("vec_id", x.alias("x")))


def _numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, exact: int64 where it fits, else Python's integers.  Sums of d squares have to fit, too, for int64."""
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums.tolist()), default=0) < 1 << 62:
        return n * x - np.array(sums.tolist(), np.int64)
    return n * x.astype(object) - sums


def _square_sums(t: np.ndarray) -> list[int]:
    if t.dtype != object and t.size and int(np.abs(t).max()) ** 2 * t.shape[1] < 1 << 63:
        return (t * t).sum(axis=1).tolist()
    return [sum(e * e for e in row) for row in t.tolist()]


def _spectra(rows: DataFrame, dim: int, fill: int, centre: np.ndarray) -> np.ndarray:
    """Eigenvectors (columns, by falling eigenvalue) of the scatter matrix of all rows, as incremental updates give them."""
    import pandas as pd

    most = max(1, min(LANES, (1 << 17) // (dim * dim)))

    def update(batches):
        state = None
        for b in batches:
            x = (list_matrix(b.column(0), dim, fill) - centre).astype(float)
            if not len(x):
                continue
            if state is None:
                state = Spectra(max(1, min(most, len(x) // (4 * dim))), dim)
            lanes = len(state.n)
            for a in range(0, len(x), lanes):
                some = x[a:a + lanes]
                if len(some) == lanes:
                    state.add_rows(some)
                else:
                    part = state.lanes(slice(0, len(some)))
                    part.add_rows(some)
                    state.put(slice(0, len(some)), part)
        if state is not None:
            one = state.merged()
            yield {"slot": [TaskContext.get().partitionId()], "n": one.n.tolist(), "mean": one.mean.tolist(), "lambdas": one.values.tolist(),
                   "vectors": [one.vectors[0].ravel().tolist()]}

    def combine(pdf):
        s = Spectra(len(pdf), dim)
        s.n = pdf["n"].to_numpy(np.int64)
        s.mean, s.values = np.stack(pdf["mean"].to_numpy()), np.stack(pdf["lambdas"].to_numpy())
        s.vectors = np.stack(pdf["vectors"].to_numpy()).reshape(len(pdf), dim, dim)
        one = s.merged()
        return pd.DataFrame({"slot": [0], "n": one.n, "mean": list(one.mean), "lambdas": list(one.values), "vectors": [one.vectors[0].ravel()]})
    schema = "slot int, n long, mean array<double>, lambdas array<double>, vectors array<double>"
    parts = map_batches(rows.select("x"), update, schema).checkpoint()
    row = tree(parts, combine, schema).first()
    vectors = np.array(row["vectors"]).reshape(dim, dim)
    return vectors[:, np.argsort(-np.array(row["lambdas"]), kind="stable")]


def whiten(entries: DataFrame, components: int = 8, fill: int = 100_000, refine: int = 2) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each row of
    ``entries`` (from ``integer_entries``) and each of its first ``components`` components.

    With n rows and sums S by place, V is the covariance of x - S/n (divisor n).  deviation is the sum of
    (n*x - S)^2, a decimal, exact; whitened is the projection on the unit eigenvector, over the root of its
    eigenvalue e; explained is e / trace(V); identity_error is the largest absolute entry of the covariance of
    whitened minus the identity, measured over all rows.

    Shorter vectors count as ending in ``fill`` (the integer of a zero).  Rows that repeat or have no id
    count like any other; equal rows get equal results.  Where the eigenvalue is zero (one row, equal
    rows, fewer dimensions in use) whitened is null and the component is left out of identity_error (null
    if none is left).  Equal eigenvalues: any basis of their space.  No rows, or only empty vectors: no rows.

    The driver gets one spectrum and some dim x dim sums, bounded by the vectors' length; all else is
    one pass over the rows each: sums, updates, ``refine`` times Rayleigh-Ritz, measuring, result.
    """
    spark = entries.sparkSession
    schema = "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double"
    rows = entries.select("vec_id", "x").checkpoint()
    n, dim = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not dim:
        return spark.createDataFrame([], schema).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
    place = (rows.select(F.posexplode("x").alias("p", "e")).groupBy("p")
             .agg(F.sum(F.col("e").cast("decimal(38,0)")).alias("s"), F.count("*").alias("c")).collect())  # dim rows
    sums = np.zeros(dim, object)
    for r in place:
        sums[r["p"]] = int(r["s"]) + fill * (n - r["c"])
    centre = np.array([int(s) // n for s in sums], np.int64)

    def centred(x):
        return _numerators(x, n, sums).astype(float) / n
    basis = np.linalg.qr(_spectra(rows, dim, fill, centre))[0]
    for _ in range(refine):
        def ritz(x, basis=basis):
            y = centred(x) @ basis
            return y.T @ y
        small = sum_over_rows(rows.select("x"), dim, ritz, fill).reshape(dim, dim) / n
        values, turn = np.linalg.eigh((small + small.T) / 2)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        values = values[::-1]
    trace = float(np.trace(small))
    k = min(components, dim)
    live = values[:k] > 64 * EPS * dim * max(trace, 0.0)
    weight = basis[:, :k] * np.where(live, 1 / np.sqrt(np.where(live, values[:k], 1)), 0)

    def moments(x):
        w = centred(x) @ weight
        w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
        return w.T @ w
    m = sum_over_rows(rows.select("x"), dim, moments, fill).reshape(k + 1, k + 1) / n
    off = (m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k))[np.ix_(live, live)]
    error = float(np.abs(off).max()) if live.any() else None
    explained = [float(e) / trace if trace > 0 else 0.0 for e in np.where(live, values[:k], 0)]

    def result(batches):
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                some = b.slice(a, 4096)
                t = _numerators(list_matrix(some.column(1), dim, fill), n, sums)
                w = (t.astype(float) / n) @ weight
                many = len(w) * k
                yield {"vec_id": some.column(0).take(pa.array(np.repeat(np.arange(len(w)), k))),
                       "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(w)), "n": np.full(many, n),
                       "deviation": np.repeat(np.array([str(s) for s in _square_sums(t)], object), k),
                       "whitened": pa.array(w.ravel(), mask=np.tile(~live, len(w))), "explained": np.tile(explained, len(w)),
                       "identity_error": pa.array([error] * many, pa.float64())}
    return map_batches(rows, result, schema).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
