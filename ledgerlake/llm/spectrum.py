"""The largest eigenvalues of a covariance by contour integration (FEAST).

The projector onto the eigenvectors of an interval is the integral of ``(z - V)^-1`` along
a circle around it. Gauss-Legendre quadrature makes that a sum of a few complex shifted solves
for a block of random vectors, dealt over Spark tasks. Rayleigh-Ritz in the span
of the sum gives eigenpairs; the block goes round again until their residuals are at the level
of rounding. Intervals come from inertia counts: the signs of the pivots of ``V - s`` tell how
many eigenvalues lie above s. Each interval must yield as many pairs as its counts say, so none
is missed.

The matrix is bounded by its dimension, not by data: up to ``MOST_DIMENSIONS``, which is sent to
every executor (128 MB at most).
"""

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

MOST_DIMENSIONS = 4096
#: Eigenvalues of one interval, if they can be told apart, and points on half its circle.
SLICE = 8
NODES = 8
#: Shifts that one round of inertia counts tries for each interval that is still too full.
SHIFTS = 7
ROUNDS = 40
_EPS = np.finfo(np.float64).eps
#: Of the trace: eigenvalues below are taken for zero; how near to an edge there may be none.
NOTHING = 1e-12
_CLEAR = 1e-13
# Fixed value: the growth bound of symmetric pivoting, (1 + sqrt(17)) / 8.
_PIVOT = 0.6403882032022076


def positive_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive, by symmetric elimination.

    Pivots are the largest diagonal entry, or the block of the largest other entry where that
    is much larger; such a block has one positive and one negative eigenvalue.
    """
    work, count = matrix.copy(), 0
    while (size := len(work)) > 0:
        largest = np.abs(work)
        at = int(np.diagonal(largest).argmax())
        row, column = divmod(int(largest.argmax()), size)
        if largest[row, column] == 0:
            break
        if largest[at, at] >= _PIVOT * largest[row, column]:
            pivot = [at]
            count += work[at, at] > 0
        else:
            pivot = [row, column]
            count += 1
        rest = np.delete(np.arange(size), pivot)
        across = work[np.ix_(rest, pivot)]
        block = work[np.ix_(pivot, pivot)]
        work = work[np.ix_(rest, rest)] - across @ np.linalg.solve(block, across.T)
        work = (work + work.T) / 2
    return int(count)


def _each(spark: SparkSession, count: int, make: Callable[[int], bytes]) -> list[bytes]:
    """``make`` of 0 to count - 1, dealt over tasks."""

    def made(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([make(x) for x in ids], pa.binary())],
                names=["id", "value"],
            )

    tasks = min(count, 2 * spark.sparkContext.defaultParallelism)
    rows = spark.range(0, count, 1, tasks).mapInArrow(made, "id long, value binary").collect()
    return [bytes(row.value) for row in sorted(rows, key=lambda x: x.id)]


def _counts_above(spark: SparkSession, matrix: Broadcast, shifts: list[float]) -> list[int]:
    def count(at: int) -> bytes:
        own = matrix.value
        return positive_pivots(own - shifts[at] * np.eye(len(own))).to_bytes(4, "little")

    return [int.from_bytes(x, "little") for x in _each(spark, len(shifts), count)]


@dataclass(frozen=True)
class Interval:
    """Eigenvalues above ``low`` and not above ``high``."""

    low: float
    high: float
    count: int


def _cut(
    spark: SparkSession, matrix: Broadcast, intervals: list[Interval], shifts: list[list[float]]
) -> list[Interval]:
    """Each interval cut at those of its shifts that no eigenvalue is near: counts just below
    and just above them agree."""
    flat = [x for own in shifts for x in own]
    both = [x + side for x in flat for side in (-_CLEAR, _CLEAR)]
    counts = _counts_above(spark, matrix, both)
    above = {x: a for x, a, b in zip(flat, counts[::2], counts[1::2], strict=True) if a == b}
    out, higher = [], 0
    for each, own in zip(intervals, shifts, strict=True):
        edges = [(x, above[x]) for x in sorted(own, reverse=True) if x in above]
        ends = [(each.high, higher), *edges, (each.low, higher + each.count)]
        higher += each.count
        out += [Interval(low, high, b - a) for (high, a), (low, b) in pairwise(ends)]
    return out


def top_intervals(
    spark: SparkSession, matrix: Broadcast, wanted: int
) -> tuple[list[Interval], int]:
    """Intervals that hold the ``wanted`` largest eigenvalues of a matrix of trace 1, and how
    many of those there are.

    They begin as decades, so that zeros lie well outside of every circle; one with more
    than ``SLICE`` is cut further, until it is too narrow to matter.
    """
    (rank,) = _counts_above(spark, matrix, [NOTHING])
    wanted = min(wanted, rank)
    found = [Interval(NOTHING, 1 + 1e-9, rank)]
    decades = [10.0**-k for k in range(1, 12)]
    found = _cut(spark, matrix, found, [decades])
    for turn in range(ROUNDS):
        before = [0, *accumulate(x.count for x in found)]
        found = [x for x, seen in zip(found, before) if seen < wanted]
        full = [x.count > SLICE and x.high - x.low > 1e-8 for x in found]
        if not any(full):
            break
        # Other places each round, should one of them hit an eigenvalue.
        places = (np.arange(1, SHIFTS + 1) + 0.2 * np.sin(turn)) / (SHIFTS + 1)
        shifts = [
            [float(x.low + p * (x.high - x.low)) for p in places] if cut else []
            for x, cut in zip(found, full)
        ]
        found = _cut(spark, matrix, found, shifts)
    return [x for x in found if x.count], wanted


def eigenpairs(
    spark: SparkSession, covariance: np.ndarray, wanted: int
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors as columns, either sign fixed.

    Fewer than ``wanted`` if others are zero (not above ``NOTHING`` of the trace).
    """
    size, trace = len(covariance), float(np.trace(covariance))
    if size > MOST_DIMENSIONS:
        raise ValueError(f"{size} dimensions; a matrix of up to {MOST_DIMENSIONS} is sent around")
    if not size or trace <= 0:
        return np.zeros(0), np.zeros((size, 0))
    scaled = covariance / trace
    shared = spark.sparkContext.broadcast(scaled)
    try:
        intervals, wanted = top_intervals(spark, shared, wanted)
        blocks = _integrated(spark, shared, intervals)
    finally:
        shared.destroy()
    basis, _ = np.linalg.qr(np.concatenate(blocks, axis=1))
    values, vectors = _ritz(scaled, basis)
    residuals = np.linalg.norm(scaled @ vectors - vectors * values, axis=0)
    if residuals.max() > 4 * _level(scaled):
        raise ArithmeticError(f"eigenvectors are off by {residuals.max()} of the trace")
    vectors = vectors * np.where(
        vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0
    )
    return values[:wanted] * trace, vectors[:, :wanted]


def _level(matrix: np.ndarray) -> float:
    """Residuals that rounding alone makes."""
    return 4 * len(matrix) * _EPS * max(1e-3, float(np.linalg.norm(matrix)))


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of the matrix within the span of an orthonormal basis, falling."""
    values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ turns)[:, ::-1]


def _integrated(
    spark: SparkSession, matrix: Broadcast, intervals: list[Interval]
) -> list[np.ndarray]:
    """The eigenvectors of each interval, all of them, as columns."""
    own, size = matrix.value, len(matrix.value)
    random = np.random.default_rng(13)
    blocks = [
        random.standard_normal((size, min(size, each.count + each.count // 2 + 8)))
        for each in intervals
    ]
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 + points)
    found: dict[int, np.ndarray] = {}
    for _ in range(ROUNDS):
        open_ = [k for k in range(len(intervals)) if k not in found]
        if not open_:
            return [found[k] for k in range(len(intervals))]
        jobs = [(k, float(t), float(w)) for k in open_ for t, w in zip(angles, weights)]
        starts = {k: blocks[k] for k in open_}

        def solved(at: int) -> bytes:
            k, angle, weight = jobs[at]
            each = intervals[k]
            spoke = (each.high - each.low) / 2 * np.exp(1j * angle)
            shift = (each.high + each.low) / 2 + spoke
            solution = np.linalg.solve(shift * np.eye(size) - matrix.value, starts[k])
            return (weight / 2 * (spoke * solution).real).tobytes()

        parts = _each(spark, len(jobs), solved)
        for k in open_:
            shape = blocks[k].shape
            total = sum(
                np.frombuffer(part).reshape(shape)
                for part, job in zip(parts, jobs, strict=True)
                if job[0] == k
            )
            basis, _ = np.linalg.qr(total)
            values, vectors = _ritz(own, basis)
            residuals = np.linalg.norm(own @ vectors - vectors * values, axis=0)
            inside = (values > intervals[k].low) & (values <= intervals[k].high)
            good = inside & (residuals <= _level(own))
            if good.sum() == intervals[k].count:
                found[k] = vectors[:, good]
            else:
                blocks[k] = vectors
    raise ArithmeticError("contour integration does not find as many eigenvalues as were counted")
