"""Whitening embeddings with leading eigenvectors of their covariance, by a distributed Jacobi-Davidson method.

The covariance is never formed. A product of it with some vectors is one pass over the stored rows: each task centres its rows, multiplies them
with the vectors and back, and hands on one small matrix; the driver adds these up. Everything on the driver has the size of some vectors.

Jacobi-Davidson: Ritz pairs from a search space; for each pair wanted next, a correction from the projected equation
(I - QQ')(V - theta)(I - QQ') t = -r, which MINRES solves by products (all pairs' equations step together, so a step is one pass); the
corrections widen the search space. A pair whose residual is down to rounding is locked: it leaves the search space, which stays orthogonal to
it. The search space is cut back to its best Ritz vectors when it grows too wide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: A pair is locked when its residual is below so many roundings of the largest eigenvalue.
ROUNDINGS = 64
#: Steps of MINRES for a correction, and how much of the residual may be left.
INNER_STEPS, INNER_LEFT = 12, 1e-3
#: The search space is cut back beyond so many vectors for each component; rounds without a new lock until the method gives up.
WIDEST, MOST_ROUNDS = 8, 200
#: An eigenvalue below this share of the largest one is no component.
LEAST_SHARE = 1e-12
#: Rows packed together.
_BLOCK = 2048

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fit:
    """Eigenpairs, falling, with what they were made from."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    products: int


def packed_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(ids, x): blocks of rows with their whole numbers floor(SCALE * c) + SHIFT, stored.

    Null vectors, empty ones, such with null or non-finite entries, and such of another length than most (the longer of two) are left out.
    """
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    good = rows.select(F.col(key).alias("id"), entries.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    lengths = good.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    good = good.filter(F.size("v") == (lengths["length"] if lengths else 0))
    id_type = rows.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), _BLOCK):
                part = batch.slice(first, _BLOCK)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False)
                if np.abs(values).max(initial=0.0) >= 2**52 / SCALE:
                    raise OverflowError("an entry is too large for whole numbers")
                x = np.floor(values * SCALE).astype(np.int64) + SHIFT
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    return stored(good.mapInArrow(pack, f"ids array<{id_type}>, x binary"))


def _blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for ids, x in zip(batch.column("ids"), batch.column("x"), strict=True):
        yield np.frombuffer(x.as_py(), np.int64).reshape(len(ids), -1)


def _added(packed: DataFrame, of_block: Callable[[np.ndarray], np.ndarray], start: np.ndarray) -> np.ndarray:
    """The sum of `of_block` over all blocks: one array from each task, in the tasks' order."""
    kind = start.dtype

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = start.copy()
        for batch in batches:
            for block in _blocks(batch):
                total += of_block(block)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["task", "total"])

    parts = sorted(packed.mapInArrow(add, "task int, total binary").collect())
    return sum((np.frombuffer(row["total"], kind).reshape(start.shape) for row in parts), start.copy())


def minres(product: Product, rhs: np.ndarray, steps: int, left: float) -> np.ndarray:
    """Solutions of symmetric systems, a column each, that share one product; a column is done when its residual is `left` of its start."""
    n, k = rhs.shape
    x = np.zeros((n, k))
    beta = np.linalg.norm(rhs, axis=0)
    going = beta > 0
    v_old, v = np.zeros((n, k)), rhs / np.where(going, beta, 1)
    w, w_old = np.zeros((n, k)), np.zeros((n, k))
    eta, gamma, gamma_old, sigma, sigma_old = beta.copy(), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    at, beta_now = beta.copy(), np.zeros(k)
    for _ in range(steps):
        if not going.any():
            break
        av = product(v)
        alpha = (v * av).sum(axis=0)
        r = av - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(r, axis=0)
        # Givens rotations of the new column of the tridiagonal matrix.
        delta = gamma * alpha - gamma_old * sigma * beta_now
        rho1 = np.hypot(delta, beta_next)
        rho1 = np.where(rho1 > 0, rho1, 1)
        rho2 = sigma * alpha + gamma_old * gamma * beta_now
        rho3 = sigma_old * beta_now
        gamma_old, gamma, sigma_old, sigma = gamma, delta / rho1, sigma, beta_next / rho1
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / rho1
        x += np.where(going, gamma * eta, 0) * w
        eta = -sigma * eta
        at = at * np.abs(sigma)
        going &= (at > left * beta) & (beta_next > 1e-14 * np.abs(alpha))
        v_old, v, beta_now = v, r / np.where(beta_next > 0, beta_next, 1), beta_next
    return x


def _orthogonal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `new` adds to the bases; rounding noise is left out."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if size == 0:
            continue
        column = column / size
        for _ in range(3):
            for basis in (*bases, *(k[:, None] for k in kept)):
                column = column - basis @ (basis.T @ column)
        rest = np.linalg.norm(column)
        if rest > 1e-10:
            column = column / rest
            for basis in (*bases, *(k[:, None] for k in kept)):
                column = column - basis @ (basis.T @ column)
            kept.append(column / np.linalg.norm(column))
    return np.stack(kept, axis=1) if kept else np.empty((len(new), 0))


def jacobi_davidson(product: Product, n: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric operator on n dimensions, falling, with unit eigenvectors and residual norms."""
    wanted = min(wanted, n)
    random = np.random.default_rng(seed)
    widest = min(n, max(WIDEST * wanted, 2 * wanted + 2))
    locked, locked_products = np.empty((n, 0)), np.empty((n, 0))
    space = _orthogonal(random.standard_normal((n, min(n, wanted + 4))))
    products = product(space)
    for _ in range(MOST_ROUNDS):
        values, turn = np.linalg.eigh((h := space.T @ products) / 2 + h.T / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, products = space @ turn, products @ turn
        residuals = products - space * values
        norms = np.linalg.norm(residuals, axis=0)
        largest = max([*np.abs(values), *np.linalg.norm(locked_products, axis=0)], default=0.0)
        done = 0
        while done < min(len(values), wanted - locked.shape[1]) and norms[done] <= ROUNDINGS * np.finfo(float).eps * largest:
            done += 1
        locked, locked_products = np.hstack([locked, space[:, :done]]), np.hstack([locked_products, products[:, :done]])
        space, products, values, residuals = space[:, done:], products[:, done:], values[done:], residuals[:, done:]
        missing = wanted - locked.shape[1]
        if not missing:
            break
        if space.shape[1] > widest - missing and locked.shape[1] + space.shape[1] < n:
            space, products, values, residuals = (a[..., : 2 * missing] for a in (space, products, values, residuals))
        aims = min(missing, space.shape[1])
        fixed, theta = np.hstack([locked, space[:, :aims]]), values[:aims]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - fixed @ (fixed.T @ t)
            t = product(t) - theta * t
            return t - fixed @ (fixed.T @ t)

        corrections = minres(projected, -(residuals[:, :aims] - fixed @ (fixed.T @ residuals[:, :aims])), INNER_STEPS, INNER_LEFT)
        new = _orthogonal(corrections, locked, space)
        if not new.shape[1]:
            new = _orthogonal(random.standard_normal((n, missing)), locked, space)
        if not new.shape[1]:
            # The search space is all there is: its Ritz pairs are the eigenpairs as far as rounding goes.
            locked, locked_products = np.hstack([locked, space[:, :missing]]), np.hstack([locked_products, products[:, :missing]])
            break
        space, products = np.hstack([space, new]), np.hstack([products, product(new)])
    else:
        raise ArithmeticError("Jacobi-Davidson did not converge")
    # The locked pairs once more together.
    locked = _orthogonal(locked)
    locked_products = product(locked)
    values, turn = np.linalg.eigh((h := locked.T @ locked_products) / 2 + h.T / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, of_vectors = locked @ turn, locked_products @ turn
    return values, vectors, np.linalg.norm(of_vectors - vectors * values, axis=0)


def fit_whitening(packed: DataFrame, components: int = COMPONENTS) -> Fit:
    """Mean and leading eigenpairs of the packed vectors' covariance (divisor n)."""
    first = packed.select("ids", "x").first()
    if first is None:
        return Fit(0, np.zeros(0), np.zeros(0), np.zeros((0, 0)), 0.0, np.zeros(0), 0)
    dims = len(first["x"]) // 8 // len(first["ids"])
    both = _added(packed, lambda x: np.r_[len(x), x.sum(axis=0)], np.zeros(dims + 1, np.int64))
    n, sums = int(both[0]), both[1:]
    mean = sums / n
    trace = float(_added(packed, lambda x: np.square(x - mean).sum(axis=0), np.zeros(dims)).sum() / n)
    passes = 0

    def product(vectors: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def of_block(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ vectors)

        return _added(packed, of_block, np.zeros(vectors.shape)) / n

    if trace <= 0:
        return Fit(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0, np.zeros(0), passes)
    values, vectors, residuals = jacobi_davidson(product, dims, components)
    real = values > LEAST_SHARE * values[0]
    return Fit(n, sums, values[real], vectors[:, real], trace, residuals[real], passes)


def whitened_embeddings(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each vector that takes part and each component from 1.

    Components with an eigenvalue of zero (fewer vectors or dimensions than components, equal vectors) have no rows. Repeated rows count as often as
    they stand there and each have their rows, rows with null keys too. An empty table gives an empty result; other columns are ignored.
    deviation fails if it does not fit a long.
    """
    packed = packed_vectors(rows, key, vector)
    fit = fit_whitening(packed, components)
    n, k, mean = fit.n, len(fit.values), (fit.sums / max(1, fit.n))
    project = fit.vectors / np.sqrt(fit.values)
    explained = fit.values / fit.trace if fit.trace else fit.values

    def white(x: np.ndarray) -> np.ndarray:
        return (x - mean) @ project

    def moments(x: np.ndarray) -> np.ndarray:
        w = white(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    error = 0.0
    if k:
        total = _added(packed, moments, np.zeros((k + 1, k))) / n
        error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    sums = fit.sums

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _blocks(batch), strict=True):
                apart = n * x - sums
                if np.square(apart.astype(float)).sum(axis=1).max() >= 2.0**62.9:
                    raise OverflowError("a deviation does not fit a long")
                m = len(x)
                columns = [
                    ids.values.take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(np.repeat(np.square(apart).sum(axis=1), k)),
                    pa.array(white(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    key_type = rows.schema[key].dataType.simpleString()
    return packed.mapInArrow(rows_of, f"`{key}` {key_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))
