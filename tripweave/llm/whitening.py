"""Whitening of embeddings along their leading principal components, found by contour integrals.

Spark sums, centres and multiplies: the covariance of all distinct vectors comes from two passes
over them, as sums a task that are added up group by group. Its leading eigenvectors then come
from FEAST: the eigenvalues wanted are cut into intervals at their gaps; around each interval a
circle in the complex plane is integrated numerically, by solves with the shifted covariance,
which projects a block of vectors onto the interval's eigenvectors; Rayleigh-Ritz in that space
gives them, and rounds follow until nothing is left over. Inertia counts (the signs of a
symmetric factorization) say beforehand how many eigenvalues an interval holds, so none can be
missed unnoticed. The intervals are independent and are solved as tasks of one Spark job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.common import shielded, stored

COMPONENTS = 16
# Eigenvalues sought by one contour at most, where gaps allow a cut.
PER_INTERVAL = 4
NODES = 16
ROUNDS = 30
EXTRA_HALVINGS = 6
# Groups in which the tasks' sums are added before they reach the driver.
GROUPS = 64
SCALE, OFFSET = 64, 1_000_000
_ALPHA = (1 + 17**0.5) / 8


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are negative, zero and positive.

    By Sylvester's law those of the block diagonal that symmetric elimination with pivots of
    one or two rows (Bunch-Kaufman) leaves.
    """
    a = np.array(matrix, np.float64)
    negative = positive = 0
    tiny = len(a) * np.finfo(float).eps * (np.abs(a).max() if len(a) else 0) * 1e-3
    while len(a):
        column = np.abs(a[1:, 0])
        largest = column.max() if len(column) else 0.0
        pivot, two = 0, False
        if abs(a[0, 0]) < _ALPHA * largest:
            r = int(column.argmax()) + 1
            row = np.abs(a[r])
            row[r] = 0
            across = row.max()
            if abs(a[0, 0]) * across >= _ALPHA * largest**2:
                pass
            elif abs(a[r, r]) >= _ALPHA * across:
                pivot = r
            else:
                pivot, two = r, True
        at = 1 if two else 0
        if pivot != at:
            a[[at, pivot]] = a[[pivot, at]]
            a[:, [at, pivot]] = a[:, [pivot, at]]
        if two:
            # Such a block always has one eigenvalue of either sign.
            negative, positive = negative + 1, positive + 1
            side = a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(a[:2, :2], side.T)
        else:
            head = a[0, 0]
            if abs(head) <= tiny:  # then the whole column is as small
                a = a[1:, 1:]
                continue
            negative, positive = negative + (head < 0), positive + (head > 0)
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0]) / head
        a = (a + a.T) / 2
    return int(negative), len(matrix) - int(negative) - int(positive), int(positive)


def above(matrix: np.ndarray, bound: float) -> int:
    """How many eigenvalues exceed ``bound``."""
    return inertia(matrix - bound * np.eye(len(matrix)))[2]


@dataclass(frozen=True)
class Interval:
    """Bounds that no eigenvalue touches, and how many lie between them by the counts of inertia."""

    low: float
    high: float
    count: int


def _brackets(matrix: np.ndarray, wanted: int, fine: float) -> list[tuple[float, float, int]]:
    """Bounds of eigenvalues, from the largest, and how many they hold; at least ``wanted`` in all.

    The range is halved until a bracket holds one eigenvalue, and then some times more so that
    gaps show, or is as narrow as rounding allows. What lies below the wanted is not told apart.
    """
    size, top = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    todo = [(-fine, top + fine, size, 0, 0)]
    found = []
    while todo:
        low, high, over_low, over_high, alone = todo.pop()
        count = over_low - over_high
        if not count:
            continue
        if over_high >= wanted or alone == EXTRA_HALVINGS or high - low <= fine:
            found.append((low, high, count))
            continue
        middle = (low + high) / 2
        over = above(matrix, middle)
        alone = alone + 1 if count == 1 else 0
        todo += [(low, middle, over_low, over, alone), (middle, high, over, over_high, alone)]
    return found


def intervals(matrix: np.ndarray, wanted: int, per: int = PER_INTERVAL) -> list[Interval]:
    """Intervals that together hold the ``wanted`` largest eigenvalues, cut where gaps are wide.

    Eigenvalues that cannot be told apart are not cut apart, so that an interval may hold more
    than ``per``, and the last more than is asked for. The matrix has no negative eigenvalues.
    """
    fine = float(np.abs(matrix).sum(axis=1).max()) * len(matrix) * np.finfo(float).eps * 16
    places = _brackets(matrix, wanted + per, fine)
    ranks = np.cumsum([count for _, _, count in places]).tolist()
    # The gap below each bracket; below the last there is nothing.
    gaps = [a[0] - b[1] for a, b in zip(places, places[1:])] + [max(places[-1][1] - places[-1][0], fine * 128)]
    found, first, done = [], 0, 0
    while done < wanted:
        # The widest gap after at least one bracket and at most so many eigenvalues, else the next gap.
        open_ = [i for i in range(first, len(places)) if gaps[i] > 64 * fine or i == len(places) - 1]
        near = [i for i in open_ if ranks[i] <= done + per and (ranks[i] <= wanted or i == open_[0])] or open_[:1]
        end = max(near, key=lambda i: gaps[i])
        # No wider than the brackets need, so that the circle keeps away from what lies outside.
        span = max(places[first][1] - places[end][0], fine)
        above_gap = gaps[first - 1] / 2 if first else span
        low, high = places[end][0] - min(gaps[end] / 2, span), places[first][1] + min(above_gap, span)
        found.append(Interval(float(low), float(high), ranks[end] - done))
        first, done = end + 1, ranks[end]
    return found


def contour(
    matrix: np.ndarray, interval: Interval, nodes: int = NODES, rounds: int = ROUNDS, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of those within ``interval``.

    Raises where inertia counted another number of eigenvalues than the contour found.
    """
    size = len(matrix)
    middle, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    turns = np.exp(1j * np.pi * (np.arange(nodes) + 0.5) / nodes)
    width = min(size, 2 * interval.count + 4)
    block = np.random.default_rng(seed).standard_normal((size, width))
    # Inverses rather than factors: NumPy keeps none, and a matrix is solved in every round.
    shifted = [np.linalg.inv((middle + radius * t) * np.eye(size) - matrix) for t in turns]
    precise = 64 * np.finfo(float).eps * size * float(np.abs(matrix).sum(axis=1).max())
    best = (np.inf, None, None)
    for _ in range(rounds):
        projected = sum((radius * t * (s @ block)).real for t, s in zip(turns, shifted, strict=True)) / nodes
        space = np.linalg.qr(projected)[0]
        values, within = np.linalg.eigh(space.T @ matrix @ space)  # Rayleigh-Ritz
        block = space @ within
        inside = np.flatnonzero((values > interval.low) & (values < interval.high))
        # What the block holds beside the interval's own vectors may have values in there, but no residue of zero.
        left = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
        nearest = np.sort(np.argsort(left)[: interval.count])[::-1]
        if len(nearest) < interval.count:
            continue
        worst = left[nearest].max()
        if worst >= best[0] / 2 and best[0] <= precise:
            break
        if worst < best[0]:
            best = (worst, values[inside[nearest]], block[:, inside[nearest]])
    if best[0] > precise:
        raise ArithmeticError(f"{interval.count} eigenvalues lie in {interval}, the contour found others")
    return best[1], best[2]


def leading(
    spark: SparkSession, matrix: np.ndarray, wanted: int = COMPONENTS
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that are zero but for rounding are left out. Every interval is a task.
    """
    size = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    floor = size * np.finfo(float).eps * 64 * top
    wanted = min(wanted, above(matrix, floor)) if top else 0
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    parts = intervals(matrix, wanted)
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = contour(shared.value, Interval(row["low"], row["high"], row["count"]))
                yield pa.record_batch(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))],
                    names=["value", "vector"],
                )

    rows = spark.createDataFrame([(p.low, p.high, p.count) for p in parts], "low double, high double, count int")
    solved = rows.repartition(len(parts), "low").mapInArrow(solve, "value double, vector array<double>")
    found = sorted(solved.collect(), key=lambda r: -r.value)  # components: at most one a dimension
    shared.unpersist()
    if len(found) != sum(p.count for p in parts):
        raise ArithmeticError("an interval lost eigenvalues")
    # Once more Rayleigh-Ritz over all intervals: orthogonal also across close bounds.
    space = np.linalg.qr(np.array([r.vector for r in found]).T)[0]
    values, within = np.linalg.eigh(space.T @ matrix @ space)
    order = np.argsort(-values)[:wanted]
    return values[order], (space @ within)[:, order]


def _numbers(column: pa.Array, size: int) -> np.ndarray:
    """A list column whose lists have ``size`` values each, as rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(rows: DataFrame, add, whole: bool = False) -> np.ndarray | int:
    """Sums of fixed length over all rows: one a task, added up in groups, then by the driver.

    ``add`` gives an array a batch; ``whole`` numbers travel as text, so that they stay exact.
    """
    kind = "string" if whole else "double"

    def written(total: np.ndarray) -> pa.Array:
        return pa.array([list(map(str, total)) if whole else total.tolist()])

    def read(sums: list) -> np.ndarray:
        return np.array(list(map(int, sums)), object) if whole else np.array(sums)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(add(batch) for batch in batches if len(batch))
        if not isinstance(total, int):  # a task without rows has no sums
            yield pa.record_batch([written(total)], names=["sums"])

    def merge(table: pa.Table) -> pa.Table:
        return pa.table([written(sum(read(sums.as_py()) for sums in table["sums"]))], names=["sums"])

    tasks = rows.mapInArrow(each, f"sums array<{kind}>").withColumn("at", F.spark_partition_id() % GROUPS)
    merged = tasks.groupBy("at").applyInArrow(merge, f"sums array<{kind}>").collect()
    return sum(read(row.sums) for row in merged)


@dataclass(frozen=True)
class Fit:
    """What whitening needs: number and sums of the distinct vectors, components and their check."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def shift(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers near the means, and n times what is left of the means."""
        near = [s // self.n for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, near, strict=True)]
        return np.array(near, np.int64), np.array(rest, object)


def _centred(x: np.ndarray, n: int, near: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """n * x - S in whole numbers; of Python's own kind where 64 bits could overflow."""
    y = x - near
    most = max(int(np.abs(y).max()), 1) * n + max((abs(int(r)) for r in rest), default=0)
    if most < 1 << 62:
        return y * n - rest.astype(np.int64)
    return y.astype(object) * n - rest


def _deviation(centred: np.ndarray) -> list[int | None]:
    """Squared length of whole-number rows, exact; None where it is no 64-bit number."""
    most = int(np.abs(centred).max()) if centred.size else 0
    if centred.dtype == np.int64 and most * most * centred.shape[1] < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    exact = [sum(int(v) * int(v) for v in row) for row in centred]
    return [v if v < 1 << 63 else None for v in exact]


def grid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``id`` and ``x``, each entry c as the whole number floor(64 c) + 1000000; their length.

    Left out are null and empty vectors, those with a null or non-finite entry or one that
    leaves the 64-bit range (over 2 ** 55), and those of another length than most vectors have
    (of the greatest, if two lengths are as frequent). Null ids and repeated rows stay.
    """
    rows, (key, vector) = shielded(vectors, id_col, vector_col)
    rows = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fit = F.expr("size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < 36028797018963968D)")
    rows = rows.where(F.coalesce(fit, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "size")).alias("most")).first().most
    size = most["size"] if most else 0
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return rows.where(F.size("v") == size).select("id", x.alias("x")), size


def fit(grid: DataFrame, size: int, components: int = COMPONENTS) -> Fit:
    """Covariance and components of the distinct vectors of ``grid``, each counted once."""
    spark = grid.sparkSession
    distinct = stored(grid.select("x").distinct(), "distinct-vectors")

    def count(batch: pa.RecordBatch) -> np.ndarray:
        x = _numbers(batch.column(0), size)
        most = int(np.abs(x).max())
        sums = x.sum(axis=0) if most * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
        return np.array([len(x), *map(int, sums)], object)

    totals = _summed(distinct, count, whole=True)
    n, sums = (totals[0], tuple(totals[1:])) if size else (0, ())
    none = Fit(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, 0.0)
    if not n:
        return none
    near, rest = none.shift()

    def multiply(batch: pa.RecordBatch) -> np.ndarray:
        y = _centred(_numbers(batch.column(0), size), n, near, rest).astype(float) / n
        return (y.T @ y).ravel()

    covariance = _summed(distinct, multiply).reshape(size, size) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(spark, covariance, components)
    trace = float(np.trace(covariance))
    if not len(values):
        return none
    scaled = vectors / np.sqrt(values)

    def check(batch: pa.RecordBatch) -> np.ndarray:
        w = _centred(_numbers(batch.column(0), size), n, near, rest).astype(float) / n @ scaled
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(values)
    totals = _summed(distinct, check)
    mean = totals[:k] / n
    white = totals[k:].reshape(k, k) / n - np.outer(mean, mean)
    return Fit(n, sums, values, vectors, trace, float(np.abs(white - np.eye(k)).max()))


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: its whitened coordinate, and figures of the fit.

    Columns: the id, ``component`` from 1 by falling eigenvalue, ``n`` distinct vectors,
    ``deviation`` (squared length of n x - S, S their sum; null beyond 64 bits), ``whitened``,
    ``explained`` (the component's share of all variance) and ``identity_error`` (largest
    entry of the whitened covariance, measured over the distinct vectors, minus the identity).
    ``grid_vectors`` says which rows are left out. There are as many components as asked for,
    at most as many as dimensions in which the vectors differ: one vector alone, or only equal
    ones, give no rows. Fit and rows come from the same whole numbers; every row is projected by
    the task that reads it.
    """
    grid, size = grid_vectors(vectors, id_col, vector_col)
    fitted = fit(grid, size, components)
    near, rest = fitted.shift()
    k, n, kind = len(fitted.values), fitted.n, grid.schema["id"].dataType.simpleString()
    scaled = fitted.vectors / np.sqrt(fitted.values) if k else fitted.vectors
    shares = fitted.values / fitted.trace if k else fitted.values
    layout = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    error = fitted.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not len(batch):
                continue
            centred = _centred(_numbers(batch.column(1), size), n, near, rest)
            white = centred.astype(float) / n @ scaled
            rows = len(batch)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.record_batch(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(_deviation(centred), pa.int64()).take(each),
                    pa.array(white.ravel()),
                    pa.array(np.tile(shares, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=names,
            )

    return grid.select("id", "x").mapInArrow(project, layout)
