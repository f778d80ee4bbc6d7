"""Whitening of embeddings by incremental eigendecomposition.

Entries become integers x = floor(scale * c) + shift, so that sums and deviations are exact.  The spectrum of the
covariance of x is found in three passes over the vectors, each a job whose results stay small:

1. **Rank-one updates.** Every partition keeps the eigenvalues and eigenvectors of its scatter matrix.  A vector
   adds one centred rank-one term: with z the vector's distance from the running mean in the eigenbasis, the new
   eigenvalues are the roots of the secular equation 1 + sum z_j^2 / (d_j - t) = 0, found between the old
   ones, and the new eigenvectors follow from z adjusted to those roots (Gu and Eisenstat), which keeps them
   orthogonal.  Entries of z that are almost zero and equal eigenvalues (turned into one direction by a
   reflection) are deflated: they keep their pairs.
2. **Combining spectra.** Groups of ``FAN_IN`` partitions are combined, round by round, until one is left: the terms
   of one spectrum, and that of the distance between the means, are rank-one updates of the other.  A round's
   results are checkpointed in the shared folder.
3. **Rayleigh-Ritz refinement.** With the exact mean S / n, the covariance is projected on the combined basis in
   one distributed pass; the eigenvectors of that small matrix turn the basis into the components.  It removes
   what rounding the updates have gathered, so the components have double precision.

A last pass measures the covariance of the whitened vectors.  A task holds a few matrices of dimension squared, as does
the driver; no vector leaves its task but in the result.

Rows without a vector, with an empty one, or with an entry that is null, not finite or beyond ``ENTRY`` are dropped, as
are vectors whose length is not the most frequent one (of equally frequent lengths the greatest).  Other null columns,
repeated rows and ties stay; columns of clashing names are not read.  An empty table gives an empty result.  Components whose
eigenvalue is zero to double precision (as with fewer vectors than dimensions) have a null ``whitened`` and do not count in
``identity_error``; equal eigenvalues have any orthonormal components of their space.  A deviation beyond a long is null.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableload.llm.ship import ship
from tableload.session import shared_dir

SCALE, SHIFT = 1024, 100_000
ENTRY = 2.0**42  # entries beyond this have no exact x
FAN_IN = 16  # spectra combined in one task
ROWS = 512  # vectors handled together outside the updates
EPS = float(np.finfo(float).eps)


# ------------------------------------------------------------------- rank-one updates
def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_j / (d_j - t) for ascending distinct ``d`` and positive ``z2``: root i lies in
    (d_i, d_i+1), the last below d_k + sum z2.  Given as (index of the nearer pole, distance from that pole),
    which is exact to the last digits also where a root almost meets a pole."""
    k = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    width = upper - d
    delta = d[None, :] - d[:, None]  # from pole i
    at_mid = 1 + (z2 / (delta - (width / 2)[:, None])).sum(axis=1)
    from_left = at_mid >= 0  # f rises between poles: the root is left of the middle
    from_left[-1] = True
    pole = np.where(from_left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d[None, :] - d[pole][:, None]
    low = np.where(from_left, 0.0, -width / 2)
    high = np.where(from_left, width / 2, 0.0)
    high[-1] = width[-1]
    if at_mid[-1] >= 0:
        high[-1] = width[-1] / 2
    else:
        low[-1] = width[-1] / 2
    t = (low + high) / 2
    behind = np.tril(np.ones((k, k)))  # poles below the root's interval
    ahead = 1 - behind
    near_left = d - d[pole]
    near_right = upper - d[pole]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(100):
            inverse = 1 / (delta - t[:, None])
            f = 1 + inverse @ z2
            settled = np.abs(f) <= 8 * k * EPS * (1 + np.abs(inverse) @ z2)
            high = np.where(f > 0, np.minimum(high, t), high)
            low = np.where(f > 0, low, np.maximum(low, t))
            if (settled | (high - low <= 2 * EPS * np.abs(t))).all():
                break
            # both sums as one pole each, matching value and slope at t; the rational model's root is next
            inverse *= inverse
            left_gap, r = near_left - t, near_right - t
            s_left = (inverse * behind) @ z2 * left_gap**2
            s_right = (inverse * ahead) @ z2 * r**2
            # c + s_left / (left_gap - step) + s_right / (r - step) = 0; the last root has no pole above
            c = f - s_left / left_gap - s_right / r
            a2, a1 = c, -(c * (left_gap + r) + s_left + s_right)
            a0 = c * left_gap * r + s_left * r + s_right * left_gap
            root = np.sqrt(np.maximum(a1 * a1 - 4 * a2 * a0, 0))
            half = -0.5 * (a1 + np.where(a1 >= 0, root, -root))
            one, two = half / a2, a0 / half
            one, two = t + one, t + two
            inside = lambda s: (s > low) & (s < high)
            moved = np.where(inside(one), one, np.where(inside(two), two, (low + high) / 2))
            t = np.where(settled, t, moved)
    return pole, t


class Spectrum:
    """Eigenvalues and eigenvectors of a scatter matrix, with its count, running mean and exact sums."""

    def __init__(self, dimension: int):
        self.n = 0
        self.mean = np.zeros(dimension)
        self.sums = [0] * dimension
        self.values = np.zeros(dimension)
        self.vectors = np.eye(dimension)

    def update(self, v: np.ndarray) -> None:
        """The spectrum of the matrix plus v v'."""
        z = v @ self.vectors
        d, u = self.values, self.vectors
        size = max(float(np.abs(d).max()), float(z @ z))
        if size == 0:
            return
        tiny = 8 * EPS * size
        # equal eigenvalues: a reflection leaves one direction of each group with a share in z
        joined = np.diff(d, prepend=-np.inf, append=np.inf) <= tiny
        for begin, end in zip(np.flatnonzero(joined[1:] & ~joined[:-1]), np.flatnonzero(joined[:-1] & ~joined[1:]) + 1, strict=True):
            w = z[begin:end].copy()
            norm = float(np.sqrt(w @ w))
            if norm == 0:
                continue
            turned = -norm if w[-1] >= 0 else norm
            w[-1] -= turned
            w /= np.sqrt(w @ w)
            u[:, begin:end] -= 2 * np.outer(u[:, begin:end] @ w, w)
            z[begin:end - 1], z[end - 1] = 0, turned
        live = np.flatnonzero(np.abs(z) * np.sqrt(size) > tiny)
        if len(live) == 0:
            return
        dl, zl = d[live], z[live]
        pole, t = secular_roots(dl, zl * zl)
        # root j minus pole i, from the root's nearer pole
        apart = (dl[pole][None, :] - dl[:, None]) + t[None, :]
        k = len(live)
        if k > 1:
            low = dl[None, :] - dl[:, None]  # pole j - pole i
            ratio = np.ones((k, k))
            below = np.tril(np.ones((k, k), bool), -1)
            ratio[below] = apart[below] / low[below]
            above = np.triu(np.ones((k, k - 1), bool))  # root j against pole j + 1, j >= i
            ratio[:, :-1][above] = apart[:, :-1][above] / low[:, 1:][above]
            adjusted = np.sqrt(np.abs(ratio.prod(axis=1) * apart[:, -1]))
        else:
            adjusted = np.sqrt(np.abs(apart[:, -1]))
        adjusted = np.copysign(adjusted, zl)
        with np.errstate(divide="ignore", invalid="ignore"):
            q = adjusted[:, None] / -apart
            q /= np.sqrt((q * q).sum(axis=0))
        if not np.isfinite(q).all():  # a root on its pole, to the last digit: that pair stands
            bad = ~np.isfinite(q).all(axis=0)
            q[:, bad] = np.eye(k)[:, pole[bad]]
        d[live] = dl[pole] + t
        u[:, live] = u[:, live] @ q
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], u[:, order]

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        away = x - self.mean
        self.n += 1
        if self.n > 1:
            self.update(away * np.sqrt((self.n - 1) / self.n))
        self.mean = self.mean + away / self.n

    def tidy(self) -> None:
        """Orthonormal vectors again; rounding takes them apart by a digit in many updates."""
        self.vectors, r = np.linalg.qr(self.vectors)
        self.vectors *= np.where(np.diag(r) < 0, -1, 1)

    def merge(self, other: Spectrum) -> None:
        """Both sets of vectors together."""
        if other.n == 0:
            return
        if self.n == 0:
            self.__dict__.update(other.__dict__)
            return
        n = self.n + other.n
        away = other.mean - self.mean
        self.update(away * np.sqrt(self.n * other.n / n))
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(vector * np.sqrt(value))
        self.tidy()
        self.mean = self.mean + away * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums, strict=True)]


# --------------------------------------------------------------------- distributed passes
def _integers(column: pa.Array, dimension: int, scale: int, shift: int) -> np.ndarray:
    """x of the vectors of an Arrow list column (all of one length, no nulls)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(-1, dimension) + shift


def _slices(batches: Iterable[pa.RecordBatch], vec: str, dimension: int, scale: int, shift: int) -> Iterator:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, _integers(part.column(vec), dimension, scale, shift)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, from exact n x - S where it fits a long."""
    whole = _scaled(x, n, sums)
    return whole.astype(np.float64) / n


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S exactly, as longs or else as Python integers."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviations(whole: np.ndarray) -> list[int | None]:
    if whole.dtype != object:
        most = int(np.abs(whole).max(initial=0))
        if whole.shape[1] * most * most < 2**63:
            return (whole * whole).sum(axis=1).tolist()
        whole = whole.astype(object)
    return [v if v < 2**63 else None for v in (whole * whole).sum(axis=1).tolist()]


def _one(parts: DataFrame, merge: Callable) -> object:
    """The states (part int, state binary) combined by ``merge``, ``FAN_IN`` in a task."""
    def combine(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = None
        for state in frame.sort_values("part")["state"]:
            state = pickle.loads(state)  # written by these tasks
            held = state if held is None else merge(held, state)
        return pd.DataFrame({"part": [int(frame["part"].iloc[0]) // FAN_IN], "state": [pickle.dumps(held)]})

    parts = parts.checkpoint()
    while True:
        left = parts.agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("most")).first()
        if left.n <= 1:
            break
        grouped = parts.groupBy(F.floor(parts["part"] / FAN_IN).alias("__group"))
        parts = grouped.applyInPandas(combine, "part int, state binary").checkpoint()
    row = parts.first()
    return pickle.loads(row.state) if row is not None else None


def _reduced(vectors: DataFrame, state: Callable, merge: Callable) -> object:
    """``state(batches)`` of every partition, combined to one; null states do not count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = state(batches)
        if held is not None:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "state": pa.array([pickle.dumps(held)], pa.binary())})

    return _one(vectors.mapInArrow(run, "part int, state binary"), merge)


def _merged_spectra(a: Spectrum, b: Spectrum) -> Spectrum:
    a.merge(b)
    return a


def _spectrum(batches: Iterable, vec: str, dimension: int, scale: int, shift: int) -> Spectrum | None:
    held = Spectrum(dimension)
    for _, x in _slices(batches, vec, dimension, scale, shift):
        if np.abs(x).max(initial=0) < 2**53 // ROWS:
            added = x.sum(axis=0).tolist()
        else:
            added = x.astype(object).sum(axis=0).tolist()
        held.sums = [a + b for a, b in zip(held.sums, added, strict=True)]
        for row in x.astype(np.float64):
            held.add(row)
        held.tidy()
    return held if held.n else None


def _moments(batches: Iterable, of: Callable) -> tuple | None:
    """(n, mean, scatter) of the rows that ``of`` gives for each slice, centred before multiplying."""
    held = None
    for part in batches:
        y = of(part)
        mean = y.mean(axis=0)
        y = y - mean
        now = (len(y), mean, y.T @ y)
        held = now if held is None else _joined(held, now)
    return held


def _joined(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    away = b[1] - a[1]
    return n, a[1] + away * (b[0] / n), a[2] + b[2] + np.outer(away, away) * (a[0] * b[0] / n)


class Whitening:
    """A fitted whitening: n, sums, components (columns, by falling eigenvalue), their eigenvalues and the trace."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace

    def proper(self) -> np.ndarray:
        """Which components have an eigenvalue other than zero."""
        return self.values > len(self.sums) * 4 * EPS * max(self.values[0], 0) if len(self.values) else np.zeros(0, bool)

    def scores(self, x: np.ndarray) -> np.ndarray:
        keep = self.proper()
        with np.errstate(divide="ignore", invalid="ignore"):
            y = _centred(x, self.n, self.sums) @ self.components / np.sqrt(np.maximum(self.values, 0))
        return np.where(keep, y, np.nan)


def valid_vectors(vectors: DataFrame, vec: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> tuple[DataFrame, int]:
    """The rows that count (only the ``keep`` columns and the vector) and their dimension (0 without rows)."""
    c = vectors[vec]
    usable = c.isNotNull() & (F.size(c) > 0) & F.forall(
        c, lambda e: F.coalesce(F.abs(e.cast("double")) <= ENTRY, F.lit(False)) & ~F.isnan(e.cast("double")))
    rows = vectors.filter(usable).select(*[vectors[k] for k in keep], c)
    most = rows.groupBy(F.size(vec).alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("s")).first()
    return (rows.filter(F.size(vec) == most.s), most.s) if most else (rows, 0)


def fit(vectors: DataFrame, dimension: int, components: int = 8, vec: str = "embedding",
        scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of vectors as ``valid_vectors`` gives; None without rows."""
    shared_dir(vectors.sparkSession)
    ship(vectors.sparkSession)
    only = vectors.select(vec)
    whole = _reduced(only, lambda b: _spectrum(b, vec, dimension, scale, shift), _merged_spectra)
    if whole is None:
        return None
    n, sums, basis = whole.n, whole.sums, whole.vectors
    # the covariance in that basis, with the exact mean: its small eigenproblem gives the components
    projected = _reduced(only, lambda b: _moments(
        _slices(b, vec, dimension, scale, shift), lambda part: _centred(part[1], n, sums) @ basis), _joined)
    ritz = projected[2] / n
    values, turns = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    found = basis @ turns[:, order]
    found /= np.sqrt((found * found).sum(axis=0))
    return Whitening(n, sums, found, values[order], float(np.trace(ritz)))


def identity_error(vectors: DataFrame, fitted: Whitening, vec: str = "embedding",
                   scale: int = SCALE, shift: int = SHIFT) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity (None without a proper
    component)."""
    keep = fitted.proper()
    if not keep.any():
        return None
    dimension = len(fitted.sums)
    measured = _reduced(vectors.select(vec), lambda b: _moments(
        _slices(b, vec, dimension, scale, shift), lambda part: fitted.scores(part[1])[:, keep]), _joined)
    return float(np.abs(measured[2] / measured[0] - np.eye(int(keep.sum()))).max())


def whiten(vectors: DataFrame, components: int = 8, vec: str = "embedding", keep: tuple[str, ...] = ("vec_id",),
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per valid vector and component: the ``keep`` columns, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    rows, dimension = valid_vectors(vectors, vec, keep)
    fitted = fit(rows, dimension, components, vec, scale, shift) if dimension else None
    kept_fields = [rows.schema[k] for k in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_fields) + (
        ", component int, n long, deviation long, whitened double, explained double, identity_error double")
    if fitted is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, fitted, vec, scale, shift)
    count = len(fitted.values)
    explained = [float(v / fitted.trace) if fitted.trace > 0 else None for v in np.maximum(fitted.values, 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _slices(batches, vec, dimension, scale, shift):
            m = len(x)
            again = pa.array(np.repeat(np.arange(m), count))
            scores = fitted.scores(x).ravel()
            columns = [part.column(k).take(again) for k in keep] + [
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                pa.array(np.full(m * count, fitted.n, np.int64)),
                pa.array(_deviations(_scaled(x, fitted.n, fitted.sums)), pa.int64()).take(again),
                pa.array(scores, mask=np.isnan(scores)),
                pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * count), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "component", "n", "deviation", "whitened", "explained",
                                                             "identity_error"])

    return rows.mapInArrow(run, schema)
