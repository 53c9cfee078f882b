"""Embedding whitening by a Jacobi-Davidson method whose only access to the covariance is a distributed product.

The covariance ``V`` of the vectors is never formed. A product with a block of columns is one Spark job: each task centres its
rows, multiplies them with the block and back, and Spark adds the tasks' parts. Around it, on matrices of ``dims`` rows and a
few dozen columns, the driver holds a search space with its image, takes Ritz pairs from it (Rayleigh-Ritz), locks leading
pairs whose residuals are at double precision, and widens the space by approximate solutions of the projected correction
equations ``(I - QQ')(V - theta I)(I - QQ') t = -r`` of all open pairs at once, found by a few steps of MINRES each.

Vectors are integers and are centred exactly: ``n * x - S`` is computed in integers before anything is rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.llm.common import batched
from pairwright.session import materialize

#: Integers beyond this are held at it.
BOUND = 1 << 27
SHIFT = 1_000_000
EXTRA = 8  # columns of the search space beyond those wanted
INNER = 6  # steps of MINRES for a correction
OUTER = 200
TOLERANCE = 64 * np.finfo(float).eps  # of a residual, relative to the largest eigenvalue

Product = Callable[[np.ndarray], np.ndarray]


def minres(product: Product, project: Product, shifts: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """Columns t of least residual ``|P (V - shift) P t - b|`` in the Krylov spaces of ``steps`` dimensions, one a column."""
    scale = np.linalg.norm(b, axis=0)
    basis = [np.divide(b, scale, out=np.zeros_like(b), where=scale > 0)]
    alphas: list[np.ndarray] = []
    betas: list[np.ndarray] = []
    for step in range(steps):
        w = project(product(basis[-1]) - shifts * basis[-1])
        alphas.append((w * basis[-1]).sum(0))
        w = w - alphas[-1] * basis[-1] - (betas[-1] * basis[-2] if step else 0)
        beta = np.linalg.norm(w, axis=0)
        beta[beta <= 1e-14 * np.abs(alphas[0]).max(initial=0)] = 0  # the space is exhausted
        betas.append(beta)
        basis.append(np.divide(w, beta, out=np.zeros_like(w), where=beta > 0))
    found = np.zeros_like(b)
    for column in range(b.shape[1]):
        t = np.zeros((steps + 1, steps))
        for i in range(steps):
            t[i, i] = alphas[i][column]
            t[i + 1, i] = betas[i][column]
            if i + 1 < steps:
                t[i, i + 1] = betas[i][column]
        goal = np.zeros(steps + 1)
        goal[0] = scale[column]
        weights = np.linalg.lstsq(t, goal, rcond=None)[0]
        found[:, column] = sum(w * part[:, column] for w, part in zip(weights, basis))
    return found


def new_directions(t: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``t`` adds to orthonormal ``known``; none where it adds nothing."""
    t = t / np.maximum(np.linalg.norm(t, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        t = t - known @ (known.T @ t)
    left, sizes, _ = np.linalg.svd(t, full_matrices=False)
    left = left[:, sizes > 1e-10]
    for _ in range(2):
        left = left - known @ (known.T @ left)
        left = np.linalg.qr(left)[0]
    return left[:, : max(0, known.shape[0] - known.shape[1])]


def jacobi_davidson(product: Product, dims: int, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix that is given by its product."""
    k = min(k, dims)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, min(dims, k + EXTRA))))[0]
    image = product(space)
    locked, largest = np.zeros((dims, 0)), 0.0
    for _ in range(OUTER):
        h = space.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        want = k - locked.shape[1]
        largest = max(largest, float(values[0]))
        residual = image[:, :want] - space[:, :want] * values[:want]
        residual -= locked @ (locked.T @ residual)
        good = np.linalg.norm(residual, axis=0) <= TOLERANCE * largest
        if space.shape[1] + locked.shape[1] == dims:
            good[:] = True  # nothing lies outside the space, so what is left is rounding
        run = len(good) if good.all() else int(np.argmin(good))  # in order, so that no larger value is passed over
        locked = np.hstack([locked, space[:, :run]])
        space, image, values = space[:, run:], image[:, run:], values[run:]
        residual, good = residual[:, run:], good[run:]
        if locked.shape[1] == k:
            break
        open_ = np.flatnonzero(~good)
        frame = np.hstack([locked, space[:, : want - run]])

        def project(block: np.ndarray, frame: np.ndarray = frame) -> np.ndarray:
            return block - frame @ (frame.T @ block)

        t = minres(product, project, values[open_], -project(residual[:, open_]), INNER)
        if space.shape[1] > 2 * k + EXTRA:  # restart from the best pairs
            space, image = space[:, : want - run + EXTRA], image[:, : want - run + EXTRA]
        t = new_directions(t, np.hstack([locked, space]))
        if not t.shape[1]:  # the corrections are rounding; look in a new direction
            fresh = np.random.default_rng(seed + 1).standard_normal((dims, 1))
            t = new_directions(fresh, np.hstack([locked, space]))
        space, image = np.hstack([space, t]), np.hstack([image, product(t)])
    else:
        raise RuntimeError(f"residuals are not at double precision after {OUTER} rounds")
    q = np.linalg.qr(locked)[0]
    h = q.T @ product(q)
    values, turn = np.linalg.eigh((h + h.T) / 2)
    vectors = q @ turn[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    return values[::-1], vectors * signs


@dataclass
class Centre:
    """What a task needs to centre integer rows exactly: their number and the sum of each dimension."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S`` in integers: of 64 bits where all values fit, otherwise Python's."""
        kind = np.int64 if self.n * 4 * BOUND < 1 << 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of ``n * x - S`` of each row, exact; null where it does not fit 64 bits."""
        scaled = self.scaled(x)
        largest = int(np.abs(scaled).max(initial=0))
        if largest * largest * x.shape[1] < 1 << 63:
            return (scaled * scaled).sum(1).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in scaled]
        return [s if s < 1 << 63 else None for s in sums]


def integer_rows(rows: DataFrame, key: str, vector: str, scale: int = 64, shift: int = SHIFT) -> DataFrame:
    """Rows (key, x) of the vectors without null or non-finite entries, with ``floor(scale * c) + shift`` of each entry."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(v, lambda c: F.least(F.greatest(F.floor(c.cast("double") * scale), F.lit(-BOUND)), F.lit(BOUND)) + shift)
    return rows.where(v.isNotNull() & ~bad & (F.size(v) > 0)).select(F.col(f"`{key}`").alias("key"), whole.cast("array<bigint>").alias("x"))


def _totals(rows: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], dims: int) -> np.ndarray:
    """Sum over all rows of a small array that ``part`` makes of a batch; ``size`` numbers come to the driver."""

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in parts:
            total += part(batched(batch.column(0), dims)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int64)), pa.array(total)], ["cell", "value"])

    found = rows.select("x").mapInArrow(add, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(size)
    for r in found.collect():
        total[r.cell] = r.value
    return total


def find_centre(rows: DataFrame, dims: int) -> Centre:
    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, np.int64)
        for batch in parts:
            x = batched(batch.column(0), dims)
            n, total = n + len(x), total + x.sum(0)
        cells = np.append(total, n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int64)), pa.array(cells)], ["cell", "value"])

    found = rows.select("x").mapInArrow(add, "cell long, value long")
    sums = {r.cell: int(r.value) for r in found.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    return Centre(sums[dims], [sums[d] for d in range(dims)])


@dataclass
class Whitening:
    """The leading components of a list of vectors: eigenvalues, eigenvectors (columns), trace and worst identity entry."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Components of each row; NaN where the eigenvalue is zero to double precision."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.centre.centred(x) @ self.vectors / np.where(self.live, np.sqrt(np.abs(self.values)), np.nan)

    @property
    def live(self) -> np.ndarray:
        floor = len(self.vectors) * np.finfo(float).eps * max(float(self.values.max(initial=0)), 0.0)
        return self.values > floor


def fit_whitening(rows: DataFrame, dims: int, k: int = 32) -> Whitening:
    """Fit on rows (x) of one length, all of them."""
    centre = find_centre(rows, dims)
    squares = _totals(rows, 1, lambda x: np.array([(centre.centred(x) ** 2).sum()]), dims)

    def product(block: np.ndarray) -> np.ndarray:
        def multiply(x: np.ndarray) -> np.ndarray:
            z = centre.centred(x)
            return z.T @ (z @ block)

        return _totals(rows, block.size, multiply, dims).reshape(block.shape) / centre.n

    values, vectors = jacobi_davidson(product, dims, k)
    fit = Whitening(centre, values, vectors, float(squares[0]) / centre.n, None)
    live = np.flatnonzero(fit.live)
    if len(live):

        def moments(x: np.ndarray) -> np.ndarray:
            w = fit.whiten(x)[:, live]
            return np.vstack([w.T @ w, w.sum(0)])

        found = _totals(rows, len(live) * (len(live) + 1), moments, dims).reshape(len(live) + 1, len(live)) / centre.n
        covariance = found[:-1] - np.outer(found[-1], found[-1])
        fit.identity_error = float(np.abs(covariance - np.eye(len(live))).max())
    return fit


def whiten_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 32) -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error): ``k`` for each usable vector.

    Vectors that are null, empty, or hold null or non-finite entries are left out. Vectors of fewer than ``k`` entries have as
    many components as entries. Vectors of different lengths have no common covariance: those of each length are a fit list
    of their own, fitted one after the other. A component whose eigenvalue is zero (equal vectors, or fewer vectors than
    entries) explains 0 and has null whitened values. Repeated rows count as often as they occur. Entries beyond
    +-2**21 are held there; a deviation that does not fit 64 bits is null.
    """
    usable = integer_rows(rows, key, vector)
    stored = materialize(usable, "integer-rows")
    lengths = [r[0] for r in stored.select(F.size("x")).distinct().orderBy(F.size("x")).collect()]
    schema = T.StructType([stored.schema["key"], T.StructField("component", T.IntegerType())])
    for name in ("n", "deviation"):
        schema = schema.add(name, T.LongType())
    for name in ("whitened", "explained", "identity_error"):
        schema = schema.add(name, T.DoubleType())
    results = []
    for dims in lengths:
        same = stored.where(F.size("x") == dims)
        fit = fit_whitening(same, dims, k)

        def whiten(parts: Iterator[pa.RecordBatch], fit: Whitening = fit, dims: int = dims) -> Iterator[pa.RecordBatch]:
            count = len(fit.values)
            explained = np.where(fit.live, fit.values, 0) / fit.trace if fit.trace > 0 else np.zeros(count)
            for part in parts:
                if not len(part):
                    continue
                x = batched(part.column(1), dims)
                each = np.repeat(np.arange(len(x)), count)
                whitened = fit.whiten(x).ravel()
                total = len(whitened)
                columns = [
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(total, fit.centre.n, np.int64)),
                    pa.array(fit.centre.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array([fit.identity_error] * total, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        results.append(same.select("key", "x").mapInArrow(whiten, schema))
    if not results:
        return rows.sparkSession.createDataFrame([], schema)
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
