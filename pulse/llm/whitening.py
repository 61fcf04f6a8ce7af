"""Principal components of whole-number vectors by Jacobi-Davidson, and rows whitened with them.

The covariance is never built. A product with it is a job: every task centres its vectors, multiplies them with a
block of columns and back, and only sums of (dimension x columns) numbers leave it. The driver holds a search space
of that height: Rayleigh-Ritz pairs of the space are refined by corrections, which MINRES finds for all
wanted pairs in step, so that one job serves all of them; pairs that have converged are locked, and
the rest of the space is kept orthogonal to them.

Vectors become whole numbers (:mod:`.vectors`) and are moved by a whole number near their mean before any floating-point
step, so that a common offset costs no digits.

Defined results: rows whose vector is null, or holds a null or a component that is not finite, are left out. The fit
counts each different vector once. Vectors of different lengths are fitted apart, each length with its own
components. Directions whose variance is no more than rounding of the widest one's are no components, so a table of one
vector has no rows in the result. Components of equal variance may be any basis of their space. A deviation
beyond 64 bits is null. Repeated rows, and rows without id, are returned like others; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settle import settle
from . import vectors
from .arrow import prepare

#: Components, further directions searched along with them, MINRES steps of a correction, residual in units of the largest eigenvalue.
COMPONENTS, MORE, STEPS, PRECISION = 16, 4, 4, 64 * np.finfo(float).eps
#: Rounds until the search is given up.
ROUNDS = 500

_EPS = np.finfo(float).eps
_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


# --- the eigenproblem, given products only


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal to those given and to each other; what depends on them goes."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(3):
        for base in against:
            new = new - base @ (base.T @ new)
        left, size, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, size > 1e-10]
    return new


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column, after ``steps`` joint products."""
    tiny = np.finfo(float).tiny
    beta = np.linalg.norm(right, axis=0)
    v, v_old = right / np.maximum(beta, tiny), np.zeros_like(right)
    w, w_old, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, cos, cos_old, sin, sin_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        image = apply(v)
        delta = (v * image).sum(axis=0)
        image = image - delta * v - beta * v_old
        beta_new = np.linalg.norm(image, axis=0)
        a0 = cos * delta - cos_old * sin * beta
        a1 = np.hypot(a0, beta_new)
        a2, a3 = sin * delta + cos_old * cos * beta, sin_old * beta
        a1 = np.maximum(a1, tiny)
        cos_old, cos, sin_old, sin = cos, a0 / a1, sin, beta_new / a1
        w, w_old = (v - a3 * w_old - a2 * w) / a1, w
        x = x + cos * eta * w
        eta = -sin * eta
        v, v_old, beta = image / np.maximum(beta_new, tiny), v, beta_new
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, precision: float = PRECISION, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, of a symmetric non-negative operator.

    ``product`` takes a block of columns. Ends when every residual is below ``precision`` times the largest eigenvalue.
    """
    wanted = min(wanted, size)
    rng = np.random.default_rng(seed)
    most = min(size, 4 * (wanted + MORE))
    locked, values = np.zeros((size, 0)), np.zeros(0)
    space = _orthonormal(rng.standard_normal((size, min(size, wanted + MORE))))
    image = product(space)
    for _ in range(ROUNDS):
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        top = max(ritz[0], values.max(initial=0.0))
        if top <= 0:
            return np.zeros(wanted), space[:, :wanted]
        full = space.shape[1] + locked.shape[1] == size
        among = np.sort(np.concatenate([values, ritz]))[::-1][:wanted]
        need = int((ritz >= among[-1]).sum()) if len(values) < wanted or ritz[0] > values.min() else 0
        rest = image[:, :need] - space[:, :need] * ritz[:need]
        rest = rest - locked @ (locked.T @ rest)
        # a full space holds the exact pairs; what remains is rounding of the products
        good = (np.linalg.norm(rest, axis=0) <= precision * top) | full
        locked = np.concatenate([locked, space[:, :need][:, good]], axis=1)
        values = np.concatenate([values, ritz[:need][good]])
        if good.all():
            order = np.argsort(-values)[:wanted]
            return values[order], locked[:, order]
        stay = np.concatenate([~good, np.ones(len(ritz) - need, bool)])
        space, image, ritz, rest = space[:, stay], image[:, stay], ritz[stay], rest[:, ~good]
        if space.shape[1] + rest.shape[1] > most - locked.shape[1] and space.shape[1] > wanted + MORE:
            space, image, ritz = (x[..., :wanted + MORE] for x in (space, image, ritz))
        shift = ritz[:rest.shape[1]]
        near = np.concatenate([locked, space[:, :rest.shape[1]]], axis=1)

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - near @ (near.T @ t)
            t = product(t) - shift * t
            return t - near @ (near.T @ t)

        rest = rest - near @ (near.T @ rest)
        new = _orthonormal(minres(projected, -rest, STEPS), locked, space)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((size, 1)), locked, space)
        space, image = np.concatenate([space, new], axis=1), np.concatenate([image, product(new)], axis=1)
    raise RuntimeError(f"no convergence after {ROUNDS} rounds")


# --- products over a table


@dataclass
class Fit:
    """Components of vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float


def _moved(codes: np.ndarray, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Codes less their mean, which is a whole number and a rest."""
    return (codes - base).astype(float) - rest


def _middle(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and what is left of it, exact to the last digit."""
    base = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(base, np.int64), np.array([(s - n * b) / n for s, b in zip(sums, base)], float)


def _packed(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """A row per vector that takes part: its length, bytes per code, and codes. Equal vectors have equal bytes."""
    for batch in batches:
        for _, matrix in vectors.codes(batch.column(0), scale):
            wide = np.array([vectors.width(row) for row in matrix], np.int32)
            for w in np.unique(wide):
                part = matrix[wide == w].astype(f"<i{w}")
                yield pa.RecordBatch.from_pydict({
                    "length": pa.array(np.full(len(part), part.shape[1], np.int32)), "wide": pa.array(np.full(len(part), w, np.int32)),
                    "codes": pa.array([row.tobytes() for row in part], pa.binary()),
                })


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    length, wide = np.asarray(batch.column(0)), np.asarray(batch.column(1))
    for n, w in {*zip(length.tolist(), wide.tolist())}:
        rows = np.flatnonzero((length == n) & (wide == w))
        data = b"".join(batch.column(2).take(pa.array(rows)).to_pylist())
        yield vectors.unpacked(data, w, n).astype(np.int64) if n else np.zeros((len(rows), 0), np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum per length and dimension; as two halves, so that no partial sum overflows."""
    found: dict[int, list] = {}
    for batch in batches:
        for matrix in _matrices(batch):
            at = found.setdefault(matrix.shape[1], [0, 0, 0])
            at[0] += len(matrix)
            at[1] = at[1] + (matrix >> 32).sum(axis=0)
            at[2] = at[2] + (matrix & 0xFFFFFFFF).sum(axis=0)
    for length, (n, high, low) in found.items():
        yield pa.RecordBatch.from_pydict({
            "length": pa.array(np.full(length + 1, length, np.int32)), "dim": pa.array(np.arange(-1, length, dtype=np.int32)),
            "high": pa.array(np.concatenate([[0], high]).astype(np.int64)), "low": pa.array(np.concatenate([[n], low]).astype(np.int64)),
        })


def _sums_of(fit: DataFrame, columns: int, made: Callable[[np.ndarray], np.ndarray], rows: int) -> np.ndarray:
    """Sum over all vectors of ``made(matrix)``, a (rows x columns) block of numbers per batch."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((rows, columns)), False
        for batch in batches:
            for matrix in _matrices(batch):
                total += made(matrix)
                some = True
        if some:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.repeat(np.arange(rows, dtype=np.int32), columns)),
                "j": pa.array(np.tile(np.arange(columns, dtype=np.int32), rows)), "v": pa.array(total.ravel()),
            })

    out = np.zeros((rows, columns))
    for i, j, v in fit.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v
    return out


def fitted(df: DataFrame, vector_col: str, components: int = COMPONENTS, scale: float = 64.0) -> dict[int, Fit]:
    """Components per length of vector, from each different vector once."""
    prepare(df.sparkSession)
    packed = df.select(vector_col).mapInArrow(lambda it: _packed(it, scale), "length int, wide int, codes binary")
    distinct = settle(packed.distinct(), "vectors")
    sums: dict[int, dict[int, int]] = {}
    whole = "decimal(38,0)"
    parts = distinct.mapInArrow(_summed, "length int, dim int, high long, low long").groupBy("length", "dim").agg(
        F.sum(F.col("high").cast(whole)).alias("high"), F.sum(F.col("low").cast(whole)).alias("low"))
    for length, dim, high, low in parts.collect():
        sums.setdefault(length, {})[dim] = (int(high) << 32) + int(low)
    return {length: _fit_one(distinct.where(F.col("length") == length), of[-1], [of[i] for i in range(length)], components)
            for length, of in sorted(sums.items())}


def _fit_one(fit: DataFrame, n: int, sums: list[int], components: int) -> Fit:
    size = len(sums)
    base, rest = _middle(n, sums)
    if not size:
        return Fit(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        def one(matrix: np.ndarray) -> np.ndarray:
            centred = _moved(matrix, base, rest)
            return centred.T @ (centred @ block)

        return _sums_of(fit, block.shape[1], one, size) / n

    trace = _sums_of(fit, 1, lambda m: np.array([[np.square(_moved(m, base, rest)).sum()]]), 1)[0, 0] / n
    if trace <= 0:
        return Fit(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, 0.0)
    values, directions = jacobi_davidson(product, size, components)
    real = values > size * _EPS * values[0]
    values, directions = values[real], directions[:, real]

    def spread(matrix: np.ndarray) -> np.ndarray:
        white = _moved(matrix, base, rest) @ directions / np.sqrt(values)
        return white.T @ white

    error = np.abs(_sums_of(fit, len(values), spread, len(values)) / n - np.eye(len(values))).max()
    return Fit(n, sums, values, directions, float(trace), float(error))


def _deviations(codes: np.ndarray, fit: Fit) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2 in whole numbers; null beyond 64 bits."""
    base, _ = _middle(fit.n, fit.sums)
    rest = [s - fit.n * int(b) for s, b in zip(fit.sums, base)]
    near = codes - base
    most = fit.n * int(np.abs(near).max(initial=0)) + max(map(abs, rest), default=0)
    if most * most * max(1, len(rest)) < 1 << 63:
        return pa.array(np.square(near * fit.n - np.array(rest, np.int64)).sum(axis=1), pa.int64())
    exact = [sum((fit.n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in near]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def _whitened(batches: Iterator[pa.RecordBatch], fits: dict[int, Fit], scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).cast(pa.int64())
        for places, codes in vectors.codes(batch.column(1), scale):
            fit = fits[codes.shape[1]]
            k = len(fit.values)
            if not k or not len(places):
                continue
            white = _moved(codes, *_middle(fit.n, fit.sums)) @ fit.directions / np.sqrt(fit.values)
            every = pa.array(np.repeat(np.arange(len(places)), k))
            tiled = lambda x: pa.array(np.tile(x, len(places)))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(pa.array(places)).take(every), "component": tiled(np.arange(1, k + 1, dtype=np.int32)),
                "n": tiled(np.full(k, fit.n, np.int64)), "deviation": _deviations(codes, fit).take(every),
                "whitened": pa.array(white.ravel()), "explained": tiled(fit.values / fit.trace), "identity_error": tiled(np.full(k, fit.identity_error)),
            })


def whiten(df: DataFrame, id_col: str, vector_col: str, components: int = COMPONENTS, scale: float = 64.0) -> DataFrame:
    """A row per vector and component: ``whitened`` is the centred vector along the component over its standard deviation.

    ``n`` counts the different vectors, ``deviation`` is the squared distance from their mean times ``n`` squared,
    ``explained`` the component's share of the variance, and ``identity_error`` how far the covariance of what was whitened is from the identity.
    """
    fits = fitted(df, vector_col, components, scale)
    return df.select(F.col(id_col).cast("long"), vector_col).mapInArrow(lambda it: _whitened(it, fits, scale), _OUT)
