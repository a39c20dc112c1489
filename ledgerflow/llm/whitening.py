"""Embedding whitening by incremental eigendecomposition (operator 13).

Entries become whole numbers, x = floor(grid * c) + shift, and the model is
fitted on each distinct vector once, so copies do not weigh.

1. Every partition of the fit list keeps a count, a mean and the eigenpairs of
   its scatter matrix. A vector moves the mean and adds one centred rank-one
   term: its coordinates in the eigenbasis give a secular equation, whose roots
   are the new eigenvalues. Coordinates near zero and equal eigenvalues are
   deflated (the latter by a rotation), the others' eigenvectors follow from
   the roots by way of the recomputed coordinates, which keeps them orthogonal.
2. Spectra are combined ``FAN`` at a time, in rounds: another partition's
   eigenpairs, and the shift between the means, are rank-one terms as well.
3. Rayleigh-Ritz refinement: one pass projects the centred vectors on the found
   basis and adds up the small matrix of their products; its eigenvectors turn
   the basis into the components. The mean is exact here: n * x - S is a whole
   number, so nothing is lost to the large common shift, and the rounding of
   the updates does not reach the result.
4. A last pass over the fit list measures the covariance of the whitened
   vectors against the identity.

Bounds: with d dimensions, a partition's spectrum is d * d doubles; one task
combines ``FAN`` of them; the driver holds d * d numbers. An update costs about
d ** 3 operations, so the operator is meant for some hundreds of dimensions.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries, or entries too large for the grid (2 ** 50 and more after scaling),
are left out, and so are vectors of another length than the commonest (ties:
the longer). Components of no variance (below d * 2 ** -50 of the whole) cannot
be scaled and are left out: equal vectors alone give no rows, neither does an
empty table. Repeated ids and rows give a result each; a null id stays null;
other columns are not read. ``deviation`` is null where it exceeds a long.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import pieces, small_batches, written

GRID, SHIFT = 64, 1_000_000
COMPONENTS = 16
FAN = 16
SLICE_BYTES = 2 << 20
EPS = np.finfo(float).eps
_ROUNDS = 40


def _roots(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """d_j - root_i, for the roots of 1 + sum w_j^2 / (d_j - x) = 0; d rises strictly, w has no zero.

    Root i lies between d_i and d_(i+1), the last one above the last d. Each is
    sought as a distance from its nearer pole, so that small distances keep
    their digits: the sums over the poles on either side are matched in value
    and slope by one pole each, and a step out of the bracket becomes a halving.
    """
    k, sq = len(d), w * w
    right = np.append(d[1:], d[-1] + sq.sum())
    at = np.arange(k)
    half = (right - d) / 2
    mid = 1 + (sq[:, None] / (d[:, None] - (d + half)[None, :])).sum(0)
    from_left = (mid >= 0) | (at == k - 1)
    origin = np.where(from_left, at, np.minimum(at + 1, k - 1))
    gap = d[:, None] - d[origin][None, :]                       # pole j seen from the origin of root i
    low = np.where(mid >= 0, 0.0, np.where(from_left, half, -half))
    high = np.where(mid >= 0, half, np.where(from_left, 2 * half, 0.0))
    left_pole = gap[at, at]
    right_pole = gap[np.minimum(at + 1, k - 1), at]
    below = (at[:, None] <= at[None, :])
    x = (low + high) / 2
    for _ in range(_ROUNDS):
        away = gap - x
        with np.errstate(all="ignore"):
            term = sq[:, None] / away
            slope = term / away
            psi, phi = np.where(below, term, 0).sum(0), np.where(below, 0, term).sum(0)
            dpsi, dphi = np.where(below, slope, 0).sum(0), np.where(below, 0, slope).sum(0)
            value = 1 + psi + phi
            size = 1 + np.abs(psi) + np.abs(phi)
            low, high = np.where(value < 0, x, low), np.where(value >= 0, x, high)
            done = (np.abs(value) <= 4 * EPS * k * size) | (high - low <= 2 * EPS * np.abs(x))
            if done.all():
                break
            l, r = left_pole - x, right_pole - x
            s, t = l * l * dpsi, np.where(at == k - 1, 0.0, r * r * dphi)
            c = 1 + (psi - l * dpsi) + np.where(at == k - 1, 0.0, phi - r * dphi)
            # c (l - y)(r - y) + s (r - y) + t (l - y) = 0 in the step y; the last root has the left pole alone
            a, b, q = c, -(c * (l + r) + s + t), c * l * r + s * r + t * l
            root = np.sqrt(np.maximum(b * b - 4 * a * q, 0))
            y = np.where(b > 0, -2 * q / (b + root), 2 * q / (root - b))
            other = np.where(b > 0, -(b + root) / (2 * a), (root - b) / (2 * a))
            last = l + s / c
            y = np.where(at == k - 1, last, np.where((x + y > low) & (x + y < high), y, other))
            new = x + y
        ok = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(ok, new, (low + high) / 2))
    return gap - x


def rank_one(lam: np.ndarray, q: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of q diag(lam) q^T + u u^T."""
    z = q.T @ u
    norm = np.linalg.norm(z)
    if norm == 0:
        return lam, q
    tol = 8 * EPS * max(np.abs(lam).max(), norm * norm)
    active = np.flatnonzero(np.abs(z) * norm > tol)
    if len(active) == 0:
        return lam, q
    q = q.copy()
    # equal eigenvalues: turn the pair so that one has no part in u
    near = len(active) > 1 and (np.diff(lam[active]) <= 16 * tol).any()
    if near:
        kept = []
        for j in active:
            if kept:
                i = kept[-1]
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                if abs((lam[j] - lam[i]) * c * s) <= tol:
                    q[:, i], q[:, j] = c * q[:, i] - s * q[:, j], s * q[:, i] + c * q[:, j]
                    z[i], z[j] = 0.0, r
                    kept[-1] = j
                    continue
            kept.append(j)
        active = np.array(kept)
    d, w = lam[active], z[active]
    k = len(d)
    away = _roots(d, w)
    # coordinates for which the computed roots are exact
    i = np.arange(k)
    with np.errstate(all="ignore"):
        by = np.where(i[None, :] < i[:, None], d[None, :] - d[:, None], np.append(d[1:], 0)[None, :] - d[:, None])
        by[:, -1] = 1.0
        ratio = -away / by
        exact = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1))), w)
        turn = exact[:, None] / away
    if not np.isfinite(turn).all():                 # poles closer than the roots can tell: a plain decomposition
        value, turn = np.linalg.eigh(np.diag(d) + np.outer(w, w))
    else:
        turn /= np.linalg.norm(turn, axis=0)
        value = d - np.diagonal(away)
    lam = lam.copy()
    lam[active] = value
    q[:, active] = q[:, active] @ turn
    order = np.argsort(lam, kind="stable")
    return lam[order], q[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the scatter matrix of the vectors seen."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.lam, self.q = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        if self.n > 1:
            self.lam, self.q = rank_one(self.lam, self.q, off * np.sqrt((self.n - 1) / self.n))

    def merge(self, n: int, mean: np.ndarray, lam: np.ndarray, q: np.ndarray) -> None:
        if self.n == 0:
            self.n, self.mean, self.lam, self.q = n, mean, lam, q
            return
        both = self.n + n
        off = mean - self.mean
        self.lam, self.q = rank_one(self.lam, self.q, off * np.sqrt(self.n / both * n))
        for value, vector in zip(lam, q.T):
            if value > 0:
                self.lam, self.q = rank_one(self.lam, self.q, vector * np.sqrt(value))
        self.mean = self.mean + off * (n / both)
        self.n = both

    def row(self) -> tuple[int, bytes, bytes, bytes]:
        return self.n, self.mean.tobytes(), self.lam.tobytes(), np.ascontiguousarray(self.q).tobytes()


_SPECTRUM = "n long, mean binary, lam binary, q binary"


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: as longs where they surely fit, else as Python numbers."""
    most = max(int(np.abs(x).max()), 1) if x.size else 1
    if 2 * n * most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviation(z: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row; null where a long cannot hold it."""
    if z.dtype != object and z.size and int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 62:
        return (z * z).sum(1).tolist()
    whole = [sum(int(v) ** 2 for v in row) for row in z]
    return [v if v < 1 << 63 else None for v in whole]


def grid_vectors(embeddings: DataFrame, grid: int = GRID, shift: int = SHIFT) -> DataFrame:
    """vec_id and x (longs) of the usable rows."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda c: grid * c)
    small = F.forall("_v", lambda c: F.coalesce(F.abs(c) < float(1 << 50), F.lit(False)))       # false for null, NaN and infinity
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("_v"))
            .where(F.col("_v").isNotNull() & (F.size("_v") > 0) & small)
            .select("vec_id", F.transform("_v", lambda c: F.floor(c) + shift).alias("x")))


def _spectra(fit: DataFrame, dim: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the scatter matrix, by rank-one updates in partitions and between them."""
    def partition(batches: Iterator[pa.RecordBatch]):
        own = Spectrum(dim)
        for b in pieces(batches, SLICE_BYTES):
            for x in (_vectors(b.column(0), dim) - shift).astype(float):
                own.add(x)
        if own.n:
            n, mean, lam, q = own.row()
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([mean], pa.binary()), pa.array([lam], pa.binary()), pa.array([q], pa.binary())], ["n", "mean", "lam", "q"])

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        own = Spectrum(dim)
        for r in rows.sort_values("part").itertuples():
            own.merge(int(r.n), np.frombuffer(r.mean), np.frombuffer(r.lam), np.frombuffer(r.q).reshape(dim, dim))
        n, mean, lam, q = own.row()
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN], "n": [n], "mean": [mean], "lam": [lam], "q": [q]})

    found = written(fit.mapInArrow(partition, _SPECTRUM).withColumn("part", F.spark_partition_id().cast("long")), "spectra")
    while True:
        found = written(found.withColumn("_g", F.floor(F.col("part") / FAN)).groupBy("_g")
                        .applyInPandas(combine, f"part long, {_SPECTRUM}"), "spectra")
        if found.count() == 1:
            r = found.first()
            return np.frombuffer(r["lam"]), np.frombuffer(r["q"]).reshape(dim, dim)


def _products(fit: DataFrame, dim: int, project) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products, of the projected vectors: a task sends one row an entry of the small matrix."""
    def partial(batches):
        total, means = 0, 0
        for b in pieces(batches, SLICE_BYTES):
            y = project(_vectors(b.column(0), dim))
            total, means = total + y.T @ y, means + y.sum(0)
        if np.ndim(total):
            i, j = np.triu_indices(len(total))
            k = len(means)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, np.arange(k)), pa.int32()), pa.array(np.append(j, np.full(k, -1)), pa.int32()),
                 pa.array(np.append(total[i, j], means))], ["i", "j", "v"])

    rows = fit.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    k = max(r["i"] for r in rows) + 1
    product, means = np.zeros((k, k)), np.zeros(k)
    for r in rows:
        if r["j"] < 0:
            means[r["i"]] = r["v"]
        else:
            product[r["i"], r["j"]] = product[r["j"], r["i"]] = r["v"]
    return product, means


class Model:
    """What ``fit`` found: n, S, the components (columns), their eigenvalues and shares, and the identity error."""

    def __init__(self, n, sums, components, values, shares, identity_error):
        self.n, self.sums, self.components, self.values = n, sums, components, values
        self.shares, self.identity_error = shares, identity_error


def fit(vectors: DataFrame, shift: int = SHIFT, components: int | None = COMPONENTS) -> Model | None:
    """The whitening of the distinct vectors ``x``; None where nothing varies or no row is there."""
    sizes = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return None
    dim = int(sizes["d"])
    # the updates cost far more than the bytes read: dealt over all tasks, not by size
    width = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = written(vectors.where(F.size("x") == dim).select("x").distinct().repartition(width), "fit")
    rows = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()   # one row a dimension
    n, sums = int(rows[0]["n"]), [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]

    _, q = _spectra(distinct, dim, shift)
    q = np.linalg.qr(q)[0]
    scatter, _ = _products(distinct, dim, lambda x: (_numerators(x, n, sums) / n).astype(float) @ q)
    values, turn = np.linalg.eigh(scatter / n)
    order = np.argsort(-values, kind="stable")
    trace = float(np.trace(scatter) / n)
    order = order[values[order] > dim * 2.0 ** -50 * trace][:components]
    if trace <= 0 or len(order) == 0:
        return None
    found, values = q @ turn[:, order], values[order]
    scale = found / np.sqrt(values)
    product, means = _products(distinct, dim, lambda x: (_numerators(x, n, sums) / n).astype(float) @ scale)
    off = product / n - np.outer(means / n, means / n) - np.eye(len(order))
    return Model(n, sums, found, values, values / trace, float(np.abs(off).max()))


def whiten(embeddings: DataFrame, grid: int = GRID, shift: int = SHIFT, components: int | None = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every usable row and component."""
    spark = embeddings.sparkSession
    small_batches(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = grid_vectors(embeddings, grid, shift)
    model = fit(vectors, shift, components)
    if model is None:
        return spark.createDataFrame([], schema)
    dim, k = len(model.sums), len(model.values)
    n, sums, shares, error = model.n, model.sums, model.shares, model.identity_error
    scale = model.components / np.sqrt(model.values)

    def project(batches):
        for b in pieces(batches, SLICE_BYTES):
            z = _numerators(_vectors(b.column(1), dim), n, sums)
            y = (z / n).astype(float) @ scale
            m = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n), pa.int64()), pa.array([v for v in _deviation(z) for _ in range(k)], pa.int64()),
                 pa.array(y.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.where(F.size("x") == dim).mapInArrow(project, schema)
