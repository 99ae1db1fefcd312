"""Whitening of vectors by the leading eigenvectors of their covariance, found by FEAST.

Three passes over the distinct vectors, each a Spark job with partial sums:
exact integer sums, centred products, and the covariance of the result.  The
products are dealt out by row of the matrix, so no task and no driver holds
more than width x width numbers.

The matrix itself is small.  Sturm counts (the inertia of V - s I from a
pivoted LDL^T factorisation) cut the upper end of the spectrum into intervals
of a few eigenvalues each.  For each interval, quadrature of complex shifted
solves along a circle through its ends projects a block of vectors onto its
eigenvectors, Rayleigh-Ritz extracts them, and both steps are repeated until
the residuals are at rounding level.  An interval is done only if it yields as
many eigenvalues as the counts at its ends demand.

Defined cases: vectors that are null or hold null or non-finite entries give
no rows; shorter vectors count as padded by zeros; equal vectors enter the fit
once, and rows that repeat an id or have none are all answered; eigenvalues at
rounding level (constant columns, fewer vectors than columns) and vectors of
width zero give no component; an empty table gives an empty result; an exact
deviation beyond a long, or entries beyond 2^50, are an error; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .topk import quantised, usable

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Quadrature points on the upper half of a contour, eigenvalues of an interval and around it, most rounds.
NODES, PER_INTERVAL, ROUNDS = 8, 8, 12
#: Eigenvalues below this share of the matrix's norm count as zero.
LEAST = 1e-12
#: Rows that a task holds as one dense block.
BLOCK = 8192


def inertia(a: np.ndarray) -> int:
    """Number of negative eigenvalues, from an LDL^T factorisation with complete pivoting."""
    a, negative = np.array(a, dtype=np.float64), 0
    grow = (1 + 17 ** 0.5) / 8
    while (n := len(a)):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = divmod(int(off.argmax()), n)
        if diagonal[p] == 0 and off[i, j] == 0:
            break
        block = [p] if diagonal[p] >= grow * off[i, j] else [i, j]
        rest = np.setdiff1d(np.arange(n), block)
        pivot, side = a[np.ix_(block, block)], a[np.ix_(rest, block)]
        # A pivot of two rows is taken only where it is indefinite.
        negative += int(pivot[0, 0] < 0) if len(block) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return negative


def above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues above s."""
    return inertia(s * np.eye(len(v)) - v)


def intervals(v: np.ndarray, wanted: int) -> Iterator[tuple[float, float, int, int]]:
    """(low, high, eigenvalues inside, eigenvalues within twice the radius), from above, until the wanted largest are held.

    An interval is halved until it holds few eigenvalues and has few more
    around it, which is what makes its contour converge fast; a cluster at
    rounding level stays whole.
    """
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    floor = top * LEAST
    wanted = min(wanted, above(v, floor))
    waiting, done = [(floor, top, above(v, floor), 0)], 0
    while done < wanted:
        low, high, more, less = waiting.pop()
        if more == less:
            continue
        around = above(v, low - (high - low) / 2) - above(v, high + (high - low) / 2)
        if (more - less <= PER_INTERVAL and around <= more - less + PER_INTERVAL) or high - low <= 1e-9 * top:
            yield low, high, more - less, around
            done = more
        else:
            mid = (low + high) / 2
            k = above(v, mid)
            waiting += [(low, mid, more, k), (mid, high, k, less)]


def contour(v: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block projected onto the eigenvectors of an interval, by quadrature on the circle through its ends."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    for x, w in zip(nodes, weights):
        turn = np.exp(1j * np.pi * (1 + x) / 2)
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, block.astype(complex))
        out += w / 2 * (radius * turn * solved).real
    return out


def in_interval(v: np.ndarray, low: float, high: float, count: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of an interval, falling, and their unit eigenvectors as columns."""
    scale = np.abs(v).sum(axis=1).max()
    # Eigenvalues at an end may leave the interval by rounding.
    slack = 1e-11 * scale
    for width in (min(len(v), size), len(v)):
        block = np.random.default_rng(width).standard_normal((len(v), width))
        before = np.inf
        for _ in range(ROUNDS):
            basis = np.linalg.qr(contour(v, low, high, block))[0]
            values, turned = np.linalg.eigh(basis.T @ v @ basis)
            block = basis @ turned
            inside = (values > low - slack) & (values <= high + slack)
            worst = np.abs(v @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0)
            if inside.sum() >= count and worst <= 1e-13 * scale and worst >= before / 2:
                order = np.flatnonzero(inside)[::-1][:count]
                return values[order], block[:, order]
            before = worst
    raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues between {low} and {high}, residual {worst}")


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest positive eigenvalues, falling, and their unit eigenvectors as rows."""
    if not len(v) or not np.abs(v).max():
        return np.zeros(0), np.zeros((0, len(v)))
    parts = [in_interval(v, low, high, count, around + 2) for low, high, count, around in intervals(v, wanted)]
    if not parts:
        return np.zeros(0), np.zeros((0, len(v)))
    values, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], axis=1).T
    return values[:wanted], rows[:wanted]


def blocks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers) of the lists of a batch, so many rows at a time; the shorter padded by the zero's integer."""
    for at in range(0, batch.num_rows, BLOCK):
        lists = batch.column(column).slice(at, BLOCK)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.full((len(lists), width), OFFSET, dtype=np.int64)
        out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        yield at, out


def summed(rows: DataFrame, height: int, part) -> np.ndarray:
    """The sum of one matrix per task, dealt out and added up by its rows; ``part`` maps a task's batches to its matrix."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = part(batches)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(matrix)), pa.int32()), pa.array(list(matrix), pa.list_(pa.float64()))], ["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[i] = total.get(i, 0) + row.values.to_numpy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["i", "row"])

    schema = "i int, row array<double>"
    found = rows.mapInArrow(each, schema).repartition(height, "i").mapInArrow(add, schema).collect()
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["i"])])


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, one row per usable vector and component."""
    used = vectors.where(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(quantised(F.col(vector), scale), lambda x: x + OFFSET).alias("x"))
    width = used.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return vectors.sparkSession.createDataFrame([], RESULT)
    padded = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x")))
    fit = store(used.select(padded.alias("x")).distinct(), "fit")
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"), F.max(F.abs("v")).alias("most")).collect()
    n, total = sums[0]["n"], [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    if max(r["most"] for r in sums) > 1 << 50:
        raise ArithmeticError("entries beyond 2^50 cannot be centred exactly")
    near = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    # x - near is exact, and what is left of the mean is below one half.
    left = np.array([float(s - n * int(m)) for s, m in zip(total, near)]) / n

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - near).astype(np.float64) - left

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((width, width))
        for batch in batches:
            for _, x in blocks(batch, 0, width):
                y = centred(x)
                out += y.T @ y
        return out

    covariance = summed(fit, width, products) / n
    values, axes = leading((covariance + covariance.T) / 2, components)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], RESULT)
    project = (axes / np.sqrt(values)[:, None]).T.copy()
    explained = values / np.trace(covariance)

    def spread(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        k = project.shape[1]
        out = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in blocks(batch, 0, width):
                y = centred(x) @ project
                out[:k] += y.T @ y
                out[k] += y.sum(axis=0)
        return out

    moments = summed(fit, len(values) + 1, spread) / n
    error = float(np.abs(moments[:-1] - np.outer(moments[-1], moments[-1]) - np.eye(len(values))).max())
    offsets = [n * int(m) - s for s, m in zip(total, near)]

    def deviations(x: np.ndarray) -> np.ndarray:
        """Exact sums of squares of n x - S."""
        shifted = x - near
        largest = n * int(np.abs(shifted).max(initial=0)) + max(abs(o) for o in offsets)
        if largest * largest * width < 1 << 63:
            return ((n * shifted + np.array(offsets, dtype=np.int64)) ** 2).sum(axis=1)
        exact = [sum((n * v + o) ** 2 for v, o in zip(row, offsets)) for row in shifted.tolist()]
        return np.array(exact, dtype=np.int64)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for at, x in blocks(batch, 1, width):
                rows = len(x)
                ids = batch.column(0).slice(at, rows).take(pa.array(np.repeat(np.arange(rows), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, dtype=np.int64)),
                     pa.array(np.repeat(deviations(x), k)), pa.array((centred(x) @ project).ravel()),
                     pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return used.mapInArrow(answer, RESULT)
