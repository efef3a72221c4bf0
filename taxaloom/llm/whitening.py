"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, floor(64 c); the different vectors are the fit list. Their covariance V is never formed:
a pass over the list multiplies it with a block of vectors, (centred X)ᵀ((centred X) Q), in which each task sums its
own rows and Spark sums the tasks' entries. One round runs the Chebyshev recurrence, a pass a degree, which damps
the spectrum below the block's smallest Ritz value; then QR, one more pass and Rayleigh-Ritz. Rounds end when the
residuals of all wanted pairs are below ``CERTIFIED`` of the largest eigenvalue. The driver holds blocks of (dimensions x
``BLOCK`` per component) numbers only.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped, and so are empty
vectors, which have no component; null ids stay; vectors of each length are a space of their own, with its own fit list;
equal vectors count once in the fit list, and each of their rows has its result; directions without variance
(``FLAT`` of the largest eigenvalue) are no components, so a list of equal vectors gives no rows; 64 c is held within 2^52 on
either side; a deviation beyond 64 bits is null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.arrow import field
from taxaloom.session import stage

COMPONENTS = 16
#: steps per unit of an entry; the contract's added million cancels in all results and is left out
STEPS = 64
#: columns of the block per wanted component
BLOCK = 3
#: degree of the filter, and rounds after which it gives up
DEGREE, ROUNDS = 12, 200
#: residual of a certified pair, and size of an eigenvalue that counts as none, relative to the largest
CERTIFIED, FLAT = 1e-12, 1e-12
#: whole numbers stay exact as doubles up to here
LARGEST = float(1 << 52)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows whose vector has finite entries only."""
    rows = vectors.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    steps = F.transform("x", lambda c: F.floor(F.least(F.greatest(c * STEPS, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long"))
    return rows.where(F.coalesce((F.size("x") > 0) & finite, F.lit(False))).withColumn("x", steps)


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield field(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(points: DataFrame, dims: int, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> dict[int, float]:
    """Sums over all rows of the entries of ``work(rows)``; tasks sum their rows, Spark sums the tasks."""

    def run(batches):
        total = None
        for rows in _matrices(batches, dims):
            part = work(rows).ravel()
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "v"])

    parts = points.select("x").mapInArrow(run, f"k long, v {kind}")
    return {r.k: r.v for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}  # entries of one block


class Space:
    """Fit list of one vector length: count, exact sums, and products of its covariance with blocks."""

    def __init__(self, points: DataFrame, dims: int):
        self.points, self.dims = points, dims
        # halves of the numbers, so that sums of 2^32 rows fit 64 bits
        low = _summed(points, dims, lambda x: np.concatenate([(x & 0xFFFFFF).sum(0), (x >> 24).sum(0), [len(x)]]), "long")
        self.n = low.get(2 * dims, 0)
        self.sums = [low[i] + (low[dims + i] << 24) for i in range(dims)] if self.n else []
        # the mean as a whole number and a rest below one: both are exact enough to centre before multiplying
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s - int(w) * self.n) / self.n for s, w in zip(self.sums, self.whole, strict=True)])

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times block: one pass over the fit list."""
        centred = self.centring()

        def work(rows):
            x = centred(rows)
            return x.T @ (x @ block)

        found = _summed(self.points, self.dims, work)
        return np.array([found[k] for k in range(block.size)]).reshape(block.shape) / self.n

    def trace(self) -> float:
        centred = self.centring()
        return _summed(self.points, self.dims, lambda rows: np.array([(centred(rows) ** 2).sum()]))[0] / self.n

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        """Function that centres rows; it holds no frame, so tasks can have it."""
        whole, rest = self.whole, self.rest
        return lambda rows: (rows - whole).astype(np.float64) - rest

    def deviations(self) -> Callable[[np.ndarray], list[int | None]]:
        """Exact sums over dimensions of (n x - S)^2, null where they pass 64 bits."""
        n, sums, whole = self.n, self.sums, self.whole
        rest = np.array([s - int(w) * n for s, w in zip(sums, whole, strict=True)], np.int64)  # below n

        def work(rows: np.ndarray) -> list[int | None]:
            far = rows - whole
            most = (int(np.abs(far).max()) + 1) * n
            if most * most * len(whole) < 1 << 62:
                return ((far * n - rest) ** 2).sum(1).tolist()
            exact = [sum((int(a) * n - int(b)) ** 2 for a, b in zip(row, rest, strict=True)) for row in far]
            return [e if e < 1 << 63 else None for e in exact]

        return work


def _ritz(space: Space, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals) of the block's span, by falling value: one pass."""
    basis, _ = np.linalg.qr(block)
    product = space.times(basis)
    small = basis.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)
    values, turn = values[order], turn[:, order]
    vectors = basis @ turn
    return values, vectors, np.linalg.norm(product @ turn - vectors * values, axis=0)


def _filtered(space: Space, block: np.ndarray, damped: float, degree: int, largest: float) -> np.ndarray:
    """Chebyshev polynomial of the covariance, small over [0, damped], times the block; scaled to stay near one."""
    centre = half = damped / 2
    scale = first = half / (largest - centre)
    last, now = block, (space.times(block) - centre * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        last, now = now, 2 * (following / half) * (space.times(now) - centre * now) - (scale * following) * last
        scale = following
    return now


def fit(space: Space, components: int, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors as columns, trace) of the largest components with any variance."""
    trace = space.trace()
    columns = min(space.dims, BLOCK * components)
    wanted = min(space.dims, components)
    if not trace > 0:
        return np.zeros(0), np.zeros((space.dims, 0)), 0.0
    start = np.random.default_rng(11).standard_normal((space.dims, columns))
    values, vectors, residuals = _ritz(space, start)
    for _ in range(ROUNDS):
        if residuals[:wanted].max() <= CERTIFIED * values[0] or values[wanted - 1] <= FLAT * values[0]:
            break
        damped = max(values[-1], FLAT * values[0])
        values, vectors, residuals = _ritz(space, _filtered(space, vectors, damped, degree, values[0]))
    else:
        raise RuntimeError(f"residuals stay above {CERTIFIED} of the largest eigenvalue: {residuals[:wanted] / values[0]}")
    kept = [i for i in range(wanted) if values[i] > FLAT * values[0]]
    return values[kept], vectors[:, kept], trace


def _space_rows(rows: DataFrame, space: Space, components: int, id_col: str) -> DataFrame | None:
    """Result rows of the vectors of one length."""
    values, vectors, trace = fit(space, components)
    if not len(values):
        return None
    n, centred, deviations = space.n, space.centring(), space.deviations()
    projection = vectors / np.sqrt(values)

    def gram(x):
        white = centred(x) @ projection
        return white.T @ white

    found = _summed(space.points, space.dims, gram)
    k = len(values)
    covariance = np.array([found[i] for i in range(k * k)]).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = field(batch, "x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            white = centred(x) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    field(batch, id_col).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, np.int64)),
                    pa.array([d for d in deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, _schema(rows, id_col))


def _schema(rows: DataFrame, id_col: str) -> str:
    kind = rows.schema[id_col].dataType.simpleString()
    return f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per sound row and component."""
    rows = whole_numbers(vectors, id_col, vector_col)
    points = stage(rows.select("x").distinct(), "fit")
    lengths = sorted(r.d for r in points.select(F.size("x").alias("d")).distinct().collect())  # vector lengths, not rows
    out = None
    for dims in lengths:
        space = Space(points.where(F.size("x") == dims), dims)
        part = _space_rows(rows.where(F.size("x") == dims), space, components, id_col)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    return rows.limit(0).mapInArrow(lambda batches: iter(()), _schema(rows, id_col)) if out is None else out
