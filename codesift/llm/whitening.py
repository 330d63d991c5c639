"""Embedding whitening by incremental eigendecomposition.

Entries become integers x = floor(256 c); the covariance is that of the distinct x vectors (the fit list).

1. *Partitions.*  Every partition of the fit list keeps the mean and the spectrum of its scatter matrix and adds one
   vector after another as a centred rank-one update: with z the vector's distance from the mean in the present
   eigenbasis, the new eigenvalues are the roots of the secular equation 1 + sum z_j^2 / (d_j - t) = 0 and the new basis
   follows from them.  Entries of z that cannot move an eigenvalue, and eigenvalues closer than rounding, are deflated.
2. *Combination.*  Two spectra combine by successive rank-one updates, one for each eigenvector of the second and one
   for the distance of their means.  Partitions combine in a tree of ``FAN`` at a time, so no task and no
   driver holds more than that many spectra.
3. *Rayleigh-Ritz.*  The whole basis is made orthonormal and one distributed pass forms the scatter matrix in it, from
   centred vectors; its small eigenproblem gives the components to double precision, whatever the updates have rounded.
4. *Check.*  Another pass measures the covariance of the whitened fit list.

An update costs O(d^3) for d dimensions, so a task's work is its share of the vectors; the driver sees d x d numbers only.
Every step is written under the shared checkpoint folder.

Defined cases: rows whose vector is null, empty, of another than the usual width or holds null or non-finite entries are dropped;
entries beyond 64-bit integers take the nearest one; repeated vectors count once in the fit, and every row is
returned, null ids too; components without variance (fewer distinct vectors than dimensions) are left out, so a table whose rows
are all equal, and an empty one, give an empty result; a deviation beyond 64 bits is null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.staging import staged
from codesift.llm.vectors import usable

SCALE = 256
COMPONENTS = 4
#: Spectra that one task combines.
FAN = 16
#: A partition should have at most this many vectors while there are cores without one.
SHARE = 2_000
EPS = np.finfo(np.float64).eps
#: Components with less than this part of the variance have none.
NOTHING = 1e-12
STATES = "part bigint, state array<binary>"
RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


# -- rank-one updates ---------------------------------------------------------------------------------------------


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(differences d_j - t_i, roots t): the roots of 1 + sum w_j / (d_j - t) = 0 for ascending d and positive w.

    Root i lies between d_i and d_{i+1}.  Each is found as an offset from its nearer pole, by interpolation with one
    pole on either side inside a shrinking bracket, so differences keep their relative accuracy.
    """
    k = len(d)
    left = np.tri(k)
    gaps = np.r_[d[1:] - d[:-1], w.sum()]
    middle = d + gaps / 2
    at_middle = 1 + (w / (d - middle[:, None])).sum(axis=1)
    near = at_middle >= 0
    pole = np.arange(k) + ~near
    pole[-1] = k - 1
    low = np.where(near, 0.0, -gaps / 2)
    high = np.where(near, gaps / 2, 0.0)
    if not near[-1]:
        low[-1], high[-1] = gaps[-1] / 2, gaps[-1]
    shift = d - d[pole][:, None]
    own = shift[np.arange(k), np.arange(k)]
    after = np.r_[shift[np.arange(k - 1), np.arange(1, k)], np.inf]
    t, done = (low + high) / 2, np.zeros(k, bool)
    for _ in range(100):
        diff = shift - t[:, None]
        terms = w / diff
        slopes = terms / diff
        psi, total = np.einsum("ij,ij->i", terms, left), terms.sum(axis=1)
        dpsi, slope = np.einsum("ij,ij->i", slopes, left), slopes.sum(axis=1)
        f, phi, dphi = 1 + total, total - psi, slope - dpsi
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        # a root found stays as it is: rounding would push it to the bracket's end and start a bisection
        done |= (np.abs(f) <= 4 * EPS * k * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= EPS * np.abs(t))
        if done.all():
            break
        a, b = own - t, after - t
        r, c = dpsi * a * a, 1 + psi - dpsi * a
        b_, phi_, dphi_ = b[:-1], phi[:-1], dphi[:-1]
        c[:-1] += phi_ - dphi_ * b_
        with np.errstate(all="ignore"):
            big = c[:-1] * (a[:-1] + b_) + r[:-1] + dphi_ * b_ * b_
            root = np.sqrt(np.maximum(big * big - 4 * a[:-1] * b_ * f[:-1] * c[:-1], 0))
            step = np.where(big > 0, 2 * a[:-1] * b_ * f[:-1] / (big + root), (big - root) / (2 * c[:-1]))
            moved = t + np.append(step, a[-1] + r[-1] / c[-1])
        t = np.where(done, t, np.where((moved > low) & (moved < high), moved, (low + high) / 2))
    return shift - t[:, None], d[pole] + t


class Spectrum(NamedTuple):
    """Ascending eigenvalues and the orthonormal eigenvectors (columns) of a scatter matrix."""

    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def zero(width: int) -> Spectrum:
        return Spectrum(np.zeros(width), np.eye(width))


def rank_one(s: Spectrum, x: np.ndarray, weight: float) -> Spectrum:
    """The spectrum of the matrix of ``s`` plus ``weight`` x x'."""
    d, basis = s.values, s.vectors
    z = (x @ basis) * np.sqrt(weight)
    rho = z @ z
    if rho <= 0:
        return s
    tiny = 8 * EPS * max(d[-1], rho)
    close = np.diff(d) <= tiny
    if close.any():
        # a reflection inside the eigenspace of (nearly) equal values leaves one entry of z there
        basis = basis.copy()
        starts = np.flatnonzero(np.r_[True, ~close])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(d)]):
            if b - a > 1 and (norm := np.sqrt(z[a:b] @ z[a:b])) > 0:
                v = z[a:b].copy()
                v[-1] += norm if v[-1] >= 0 else -norm
                basis[:, a:b] -= np.outer(basis[:, a:b] @ v, v * (2 / (v @ v)))
                z[a:b - 1], z[b - 1] = 0, -norm if v[-1] > 0 else norm
    active = np.flatnonzero(np.sqrt(rho) * np.abs(z) > tiny)
    if not len(active):
        return s
    da, za, k = d[active], z[active], len(active)
    diff, roots = secular_roots(da, za * za)
    # the z for which these roots are exact (Loewner's formula), so that the new basis is orthonormal
    under = da[:, None] - da
    i = np.arange(k)
    low = i[:, None] < i
    shifted = np.ones((k, k))
    shifted[:-1] = under[1:]
    ratio = -diff / np.where(low, under, shifted)
    zhat = np.sqrt(np.abs(ratio.prod(axis=0)))
    turn = (np.copysign(zhat, za) / diff).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values, vectors = d.copy(), basis if basis is not s.vectors else basis.copy()
    values[active] = roots
    vectors[:, active] = basis[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return Spectrum(values[order], vectors[:, order])


class Moments(NamedTuple):
    """Count, exact sums, mean and scatter spectrum of some vectors."""

    n: int
    sums: list[int]
    mean: np.ndarray
    spectrum: Spectrum

    def to_state(self) -> list[bytes]:
        return [str(self.n).encode(), ",".join(map(str, self.sums)).encode(), self.mean.tobytes(),
                self.spectrum.values.tobytes(), self.spectrum.vectors.tobytes()]

    @staticmethod
    def of_state(state: list[bytes]) -> Moments:
        mean, values = np.frombuffer(state[2]), np.frombuffer(state[3])
        return Moments(int(state[0]), [int(x) for x in state[1].split(b",")], mean,
                       Spectrum(values, np.frombuffer(state[4]).reshape(len(values), -1)))


def combine(a: Moments, b: Moments) -> Moments:
    """The moments of both by one rank-one update for each eigenvector of ``b`` and one for the means."""
    n, spectrum, apart = a.n + b.n, a.spectrum, b.mean - a.mean
    for value, vector in zip(b.spectrum.values, b.spectrum.vectors.T):
        if value > 0:
            spectrum = rank_one(spectrum, vector, value)
    spectrum = rank_one(spectrum, apart, a.n * b.n / n)
    return Moments(n, [x + y for x, y in zip(a.sums, b.sums)], a.mean + apart * (b.n / n), spectrum)


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of 64-bit integers without overflow."""
    return [int(h) * (1 << 32) + int(w) for h, w in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _state_row(state: list[bytes], part: int | None = None) -> pa.RecordBatch:
    part = TaskContext.get().partitionId() if part is None else part
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([state], pa.list_(pa.binary()))], names=["part", "state"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The moments of one partition of (x)."""
    n, mean, spectrum, sums = 0, None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(0))
        sums = [a + b for a, b in zip(sums or [0] * x.shape[1], exact_sums(x))]
        if mean is None:
            mean, spectrum = np.zeros(x.shape[1]), Spectrum.zero(x.shape[1])
        for row in x.astype(np.float64):
            n += 1
            apart = row - mean
            mean = mean + apart / n
            spectrum = rank_one(spectrum, apart, (n - 1) / n)
    if n:
        yield _state_row(Moments(n, sums, mean, spectrum).to_state())


# -- combining states ---------------------------------------------------------------------------------------------


def combined(states: DataFrame, merge: Callable[[list[bytes], list[bytes]], list[bytes]], name: str) -> list[bytes] | None:
    """One state from the states of all partitions, combined in a tree; null if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, None
        for batch in batches:
            for p, state in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if part is not None and p == part:
                    held = merge(held, state)
                else:
                    if held is not None:
                        yield _state_row(held, part)
                    part, held = p, state
        if held is not None:
            yield _state_row(held, part)

    level = staged(states, name)
    while (left := level.count()) > 1:
        grouped = level.select(F.floor(F.col("part") / FAN).alias("part"), F.col("part").alias("place"), "state")
        level = staged(grouped.repartition(-(-left // FAN), "part").sortWithinPartitions("part", "place").mapInArrow(run, STATES), name)
    return level.first().state if left else None


def _sum_states(a: list[bytes], b: list[bytes]) -> list[bytes]:
    return [(np.frombuffer(x) + np.frombuffer(y)).tobytes() for x, y in zip(a, b)]


def _scatter(batches: Iterator[pa.RecordBatch], project: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sums and products of the projected vectors of one partition."""
    total = None
    for batch in batches:
        if batch.num_rows:
            y = project(_matrix(batch.column(0)))
            total = (total[0] + y.sum(axis=0), total[1] + y.T @ y) if total else (y.sum(axis=0), y.T @ y)
    if total:
        yield _state_row([t.tobytes() for t in total])


# -- the operator -------------------------------------------------------------------------------------------------


class Whitening(NamedTuple):
    """A fitted whitening: its components (columns, by falling variance) and what they were fitted to."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x.astype(np.float64) - mean) @ self.components / np.sqrt(self.variances)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of every row; null beyond 64 bits."""
        most = self.n * float(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, self.sums))
        if most * most * x.shape[1] < 2.0 ** 62:
            apart = self.n * x - np.array(self.sums)
            return (apart * apart).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit_list(rows: DataFrame) -> DataFrame:
    """(x): the distinct integer vectors, over enough partitions for all cores."""
    fit = staged(rows.select("x").distinct(), "fit-list")
    cores = fit.sparkSession.sparkContext.defaultParallelism
    wanted = min(cores, -(-fit.count() // SHARE))
    return fit.repartition(wanted) if wanted and fit.count() <= cores * SHARE * 8 else fit


def fit(rows: DataFrame, n_components: int = COMPONENTS) -> tuple[Whitening | None, float | None]:
    """The whitening of a table with integer vectors ``x`` and its identity error; null without variance."""
    vectors = fit_list(rows)
    state = combined(vectors.mapInArrow(_moments, STATES),
                     lambda a, b: combine(Moments.of_state(a), Moments.of_state(b)).to_state(), "moments")
    if state is None:
        return None, None
    moments = Moments.of_state(state)
    mean = np.array([s / moments.n for s in moments.sums])
    basis = np.linalg.qr(moments.spectrum.vectors)[0]
    scatter = combined(vectors.mapInArrow(lambda b: _scatter(b, lambda x: (x.astype(np.float64) - mean) @ basis), STATES),
                       _sum_states, "scatter")
    matrix = np.frombuffer(scatter[1]).reshape(basis.shape) / moments.n
    values, turn = np.linalg.eigh((matrix + matrix.T) / 2)
    trace = float(np.trace(matrix))
    keep = [i for i in np.argsort(-values, kind="stable")[:n_components] if values[i] > NOTHING * trace]
    if not keep:
        return None, None
    components = basis @ turn[:, keep]
    largest = np.abs(components).argmax(axis=0)
    components *= np.sign(components[largest, np.arange(len(keep))])
    model = Whitening(moments.n, moments.sums, components, values[keep], trace)

    again = combined(vectors.mapInArrow(lambda b: _scatter(b, model.whitened), STATES), _sum_states, "identity")
    middle = np.frombuffer(again[0]) / model.n
    covariance = np.frombuffer(again[1]).reshape(len(keep), -1) / model.n - np.outer(middle, middle)
    return model, float(np.abs(covariance - np.eye(len(keep))).max())


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable rows."""
    return usable(df, id_col, vector_col).select(
        "vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("x"))


def whiten(df: DataFrame, n_components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component (see ``RESULT``)."""
    rows = integer_vectors(df, id_col, vector_col)
    model, error = fit(rows, n_components)
    if model is None:
        return df.sparkSession.createDataFrame([], RESULT)
    k = len(model.variances)
    explained = model.variances / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            at, m = np.repeat(np.arange(len(x)), k), len(x) * k
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(m, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(at)),
                pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error)),
            ], names=[c.split()[0] for c in RESULT.split(", ")])

    return rows.mapInArrow(run, RESULT)
