"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

With ``X`` the centred rows, each step multiplies ``X v`` and ``X' u`` on the executors and makes both
results orthogonal to all earlier ones.  After ``k`` steps ``X V = U B`` with ``B`` upper bidiagonal; its
small singular value decomposition, on the driver, gives the components (``V`` times right vectors)
and the deviations along them (singular values over the root of the number of rows).

No vector as long as the table is kept: a left vector is a combination of rows, ``u = X p``, and ``p``
has one entry per dimension.  One pass over the rows therefore serves a whole step: with ``a = X q`` it
adds up ``X'a``, ``U'a = P'X'a`` and ``a'a``, which is all that both products and the orthogonalisation
need.  The driver gets one number per dimension and earlier step, and holds three square tables of
that size.  As many steps are taken as there are dimensions: the bidiagonal form is then complete, and no
component is missed, however often its variance occurs.  With ``tolerance`` they end earlier, when the
leading components have residuals below that share of the largest singular value.

Rows are integers ``floor(scale * entry)``.  An integer added to every entry would cancel throughout.

Defined results: rows whose vector is missing, or holds missing or non-finite entries, or has
another length than most vectors, take no part; repeated rows count as often as they occur.  Components
without variance (fewer dimensions or distinct rows than components) are left out; an empty table, or
one of equal rows, has none.  Each component's largest entry is positive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.common import field
from entitylake.llm.integer_vectors import IntegerVectors, integer_vectors

COMPONENTS = 8
SEED = 11

_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """``sums`` are exact sums of the integer rows; ``directions`` has a unit row per component."""

    rows: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total_variance: float
    steps: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.rows for s in self.sums], float)

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total_variance) for v in self.variances]


def vectors(rows: DataFrame, key: str, vector: str, scale: int = 1024) -> IntegerVectors:
    """The usable rows as integers, written once; ``key`` beside them."""
    return integer_vectors(rows, vector, scale, {key: F.col(key)}, same_length=True)


def _added(data: DataFrame, numbers, value: str) -> dict[int, float]:
    """Numbers by place, added up over all batches: within tasks, then between them."""

    def partial(batches):
        total = None
        for batch in batches:
            found = numbers(batch)
            total = found if total is None else total + found
        if total is not None:
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], names=["place", "value"])

    parts = data.mapInArrow(partial, f"place int, value {'long' if value != 'double' else value}")
    sums = parts.groupBy("place").agg(F.sum(F.col("value").cast(value)).alias("value"))
    return {r["place"]: r["value"] for r in sums.collect()}


def fit(
    data: IntegerVectors,
    components: int = COMPONENTS,
    tolerance: float | None = None,
    seed: int = SEED,
) -> Whitening:
    """The leading components of the rows' covariance (divisor: their number).  Starts a job a step."""
    dims, n, read = data.dims, data.rows, data.read
    numbers = data.table.select("numbers")
    if not n or not dims:
        return Whitening(n, (0,) * dims, np.zeros((0, dims)), np.zeros(0), 0.0, 0)
    totals = _added(
        numbers, lambda b: read(b.columns[0]).sum(0, dtype=np.int64), "decimal(38,0)"
    )
    sums = tuple(int(totals[i]) for i in range(dims))
    mean = np.array([s / n for s in sums], float)
    squares = _added(
        numbers, lambda b: ((read(b.columns[0]) - mean) ** 2).sum(0), "double"
    )
    total = sum(squares.values())
    nothing = Whitening(n, sums, np.zeros((0, dims)), np.zeros(0), total / n, 0)
    if total <= n * dims * (_EPS * np.abs(mean).max()) ** 2:
        return nothing

    def products(q: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """``X'a``, ``U'a`` and ``a'a`` of ``a = X q``."""

        def of_batch(batch):
            x = read(batch.columns[0]) - mean
            a = x @ q
            return np.concatenate([x.T @ a, (x @ earlier.T).T @ a, [a @ a]])

        found = _added(numbers, of_batch, "double")
        out = np.array([found[i] for i in range(len(found))])
        return out[:dims], out[dims:-1], float(out[-1])

    rng = np.random.default_rng(seed)
    right, left, images = (np.zeros((0, dims)) for _ in range(3))  # V, P and X'U, by rows
    alphas, betas = [], []
    v, beta = _orthogonal(rng.standard_normal(dims), right)[0], 0.0
    while True:
        q = v - beta * left[-1] if beta else v
        image, overlap, length = products(q, left)
        p, w = q - overlap @ left, image - overlap @ images
        alpha = float(np.sqrt(max(length - overlap @ overlap, 0.0)))
        right = np.vstack([right, v])
        if alpha <= dims * _EPS * np.sqrt(total):  # nothing varies along v
            alpha, p, w = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            p, w = p / alpha, w / alpha
        left, images = np.vstack([left, p]), np.vstack([images, w])
        alphas.append(alpha)
        if len(alphas) == dims:
            break
        v, beta = _orthogonal(w - alpha * v, right)
        if tolerance is not None and len(alphas) > components:
            outer, singular, _ = _decomposed(alphas, betas)
            if (beta * np.abs(outer[-1, :components]) <= tolerance * singular[0]).all():
                break
        if beta <= dims * _EPS * np.sqrt(total):  # an invariant space: go on outside of it
            v, beta = _orthogonal(rng.standard_normal(dims), right)[0], 0.0
        betas.append(beta)
    _, singular, inner = _decomposed(alphas, betas[: len(alphas) - 1])
    variances = singular**2 / n
    keep = np.flatnonzero(singular[:components] > dims * _EPS * singular[0])
    directions = inner[keep] @ right
    largest = np.abs(directions).argmax(1)
    directions = directions * np.sign(directions[np.arange(len(keep)), largest])[:, None]
    return Whitening(n, sums, directions, variances[keep], total / n, len(alphas))


def _orthogonal(vector: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, float]:
    """``vector`` without its share in orthonormal rows, twice for accuracy; and its length before
    it is made one."""
    for _ in range(2):
        vector = vector - (others @ vector) @ others
    length = float(np.linalg.norm(vector))
    return (vector / length if length else vector), length


def _decomposed(alphas: list[float], betas: list[float]):
    return np.linalg.svd(np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas))


def whiten(data: IntegerVectors, model: Whitening, key: str) -> DataFrame:
    """``key``, ``deviation`` (the squared distance of ``rows`` times the row from the sums, exact; NULL
    beyond 64 bits) and ``whitened``, an entry per component."""
    n, mean, read = model.rows, model.mean, data.read
    turned = (model.directions / np.sqrt(model.variances)[:, None]).T
    sums = np.array(model.sums, object)

    def rows(batches):
        for batch in batches:
            x = read(batch.columns[1])
            scores = (x - mean) @ turned
            parts = [batch.columns[0], pa.array(_distances(x, n, sums), pa.int64())]
            flat = pa.array(np.ascontiguousarray(scores).reshape(-1))
            ends = np.arange(len(x) + 1, dtype=np.int32) * scores.shape[1]
            parts.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            yield pa.RecordBatch.from_arrays(parts, names=[key, "deviation", "whitened"])

    schema = T.StructType(
        [
            field(data.table, key),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return data.table.select(key, "numbers").mapInArrow(rows, schema)


def _distances(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums of ``(n * x - sums) ** 2``: 64-bit where that is sure to fit, else whole numbers of any size."""
    far = max((abs(int(x.min())), abs(int(x.max()))), default=0) if x.size else 0
    most = n * far + max((abs(s) for s in sums), default=0)
    if most * most * max(x.shape[1], 1) < 1 << 63:
        apart = x.astype(np.int64) * n - sums.astype(np.int64)
        return (apart * apart).sum(1).tolist()
    apart = x.astype(object) * n - sums
    return [d if d < 1 << 63 else None for d in (apart * apart).sum(1)]


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest entry, without sign, of the covariance of ``whitened`` minus the identity."""
    if not components:
        return 0.0

    def moments(batch):
        w = batch.columns[0].flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
        return np.concatenate([[len(w)], w.sum(0), (w.T @ w).ravel()])

    found = _added(whitened.select("whitened"), moments, "double")
    out = np.array([found[i] for i in range(len(found))])
    n, mean = out[0], out[1 : 1 + components] / out[0]
    covariance = out[1 + components :].reshape(components, components) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(components)).max())


def component_rows(whitened: DataFrame, model: Whitening, *columns: str | Column) -> DataFrame:
    """A row per vector and component: ``columns``, ``component`` from 1, ``whitened``, ``explained``."""
    shares = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    exploded = whitened.select(*columns, F.posexplode("whitened").alias("_at", "_value"))
    return exploded.select(
        *columns, (F.col("_at") + 1).alias("component"), F.col("_value").alias("whitened"),
        F.get(shares, F.col("_at")).alias("explained"),
    )
