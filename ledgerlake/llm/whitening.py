"""Principal components of embeddings, whitened, from exact sums.

An entry c becomes the whole number ``floor(scale * c) + shift``. The fit list has each
distinct vector once; n, the sums S by dimension and the second moments about the rounded mean
are sums of whole numbers, exact at any size, so the covariance is that of the data and not of
an order of adding. Its largest eigenpairs come from contour integration (``spectrum``).
Each row's ``x - S/n``, projected on a component and divided by the root of its eigenvalue, is
its whitened value.

At scale: rows never meet. Distinct vectors are grouped, combined map-side, so that a vector
that repeats a billion times travels once a task, and written once. Each task sends the sums of
its rows, at most one number for each pair of dimensions. The driver gets those numbers alone.

Defined results. Rows whose vector is NULL or has a NULL, NaN or infinite entry, or one of 2**46 or
more in size, whose product with the scale would not be exact, are left out. Shorter vectors
count as filled up with zeros. Rows that repeat, ties included, come back as often as they
are there; a NULL vec_id stays NULL. Where eigenvalues are equal, any basis of their space is
right; it is the same for all rows. Components whose eigenvalue is zero, or within rounding of
it (``spectrum.NOTHING`` of the trace), have no whitened value and are left out, so that a
table of one distinct vector, or an empty one, gives no rows. ``deviation`` is NULL where it does
not fit 64 bits. Other columns of the input play no part.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written
from ledgerlake.llm.spectrum import eigenpairs

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
_LARGEST = float(1 << 46)
_EXACT = 1 << 53
_LONG = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list, and its components as columns."""

    scale: int
    shift: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None = None

    @property
    def centre(self) -> list[int]:
        """The mean, rounded to whole numbers."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as whole numbers."""
    usable = F.forall(
        "embedding",
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(_LARGEST)),
    )
    whole = F.transform(
        "embedding", lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift)
    )
    rows = vectors.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & usable)
    return rows.select("vec_id", whole.alias("x"))


def _filled(whole: DataFrame, size: int, shift: int) -> DataFrame:
    missing = F.array_repeat(F.lit(shift).cast("long"), F.lit(size) - F.size("x"))
    return whole.withColumn("x", F.concat("x", missing))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, size)


def _longs(totals: Iterable[int]) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in totals], pa.decimal128(38, 0))


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and sums by dimension."""

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _matrix(batch, size)
            n += len(x)
            for start in range(0, len(x), 256):  # 256 numbers of 54 bits fit into 62
                total += x[start : start + 256].sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(size), pa.int32()),
                    pa.array([n] * size, pa.int64()),
                    _longs(total),
                ],
                names=["i", "n", "total"],
            )

    parts = fit.mapInArrow(added, "i int, n long, total decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    rows.sort(key=lambda row: row.i)
    return (rows[0].n if rows else 0), [int(row.total) for row in rows]


def products(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` of whole numbers, exact."""
    most = int(np.abs(rows).max(initial=0)) ** 2 * len(rows)
    if most < _EXACT:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64)
    rows = rows if most < _LONG else rows.astype(object)
    return rows.T @ rows


def _moments(fit: DataFrame, size: int, centre: list[int]) -> dict[tuple[int, int], int]:
    """Sums of products of each pair of dimensions, about ``centre``."""
    upper = np.triu_indices(size)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]), object)
        some = False
        for batch in batches:
            some = some or batch.num_rows > 0
            total += products(_matrix(batch, size) - np.array(centre, np.int64))[upper]
        if some:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int32()) for x in upper), _longs(total)], names=["i", "j", "total"]
            )

    parts = fit.mapInArrow(added, "i int, j int, total decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    return {(row.i, row.j): int(row.total) for row in rows}


def _covariance(n: int, sums: list[int], centre: list[int], moments: dict) -> np.ndarray:
    """Divisor n; every entry is rounded once, from its exact fraction."""
    size = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((size, size))
    for (i, j), total in moments.items():
        out[i, j] = out[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
    return out


def fit(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> Whitening:
    """Learn the components from the distinct vectors, and measure what they make of them."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, scale, shift)
    size = whole.agg(F.max(F.size("x")).alias("size")).first().size or 0
    if size == 0:
        return Whitening(scale, shift, 0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    listed = written(_filled(whole, size, shift).select("x").distinct(), "fit-list")
    n, sums = _sums(listed, size)
    model = Whitening(scale, shift, n, sums, 0.0, np.zeros(0), np.zeros((size, 0)))
    covariance = _covariance(n, sums, model.centre, _moments(listed, size, model.centre))
    values, columns = eigenpairs(spark, covariance, components)
    trace = float(np.trace(covariance))
    model = Whitening(scale, shift, n, sums, trace, values, columns)
    if not len(values):
        return model
    error = _identity_error(listed, model)
    return Whitening(scale, shift, n, sums, trace, values, columns, error)


def _multiples(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * x - S``, exact, as 64-bit numbers or, where those are too small, as Python's."""
    offset = x - np.array(model.centre, np.int64)
    rest = [s - model.n * c for s, c in zip(model.sums, model.centre, strict=True)]
    most = model.n * int(np.abs(offset).max(initial=0)) + max(map(abs, rest), default=0)
    if most < _LONG:
        return offset * model.n - np.array(rest, np.int64)
    return offset.astype(object) * model.n - np.array(rest, object)


def _whitened(multiples: np.ndarray, model: Whitening) -> np.ndarray:
    centred = (multiples / model.n).astype(np.float64)
    return centred @ (model.vectors / np.sqrt(model.values))


def _identity_error(listed: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    size, count = len(model.sums), len(model.values)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row and column are sums of the values themselves.
        total = np.zeros((count + 1, count + 1))
        for batch in batches:
            w = _whitened(_multiples(_matrix(batch, size), model), model)
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        if total[count, count]:
            i, j = np.triu_indices(count + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                names=["i", "j", "total"],
            )

    parts = listed.mapInArrow(added, "i int, j int, total double")
    full = np.zeros((count + 1, count + 1))
    for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        full[row.i, row.j] = full[row.j, row.i] = row.total / model.n
    means = full[count, :count]
    return float(np.abs(full[:count, :count] - np.outer(means, means) - np.eye(count)).max())


def _deviations(multiples: np.ndarray) -> pa.Array:
    """Sums of squares by row; NULL beyond 64 bits."""
    most = int(np.abs(multiples).max(initial=0)) ** 2 * multiples.shape[1]
    if most < _LONG:
        return pa.array((multiples.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    exact = (multiples.astype(object) ** 2).sum(axis=1)
    return pa.array([int(x) if x < 1 << 63 else None for x in exact], pa.int64())


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """One row for each vector that takes part and each component, numbered from 1.

    Vectors may be others than those of the fit, of up to as many dimensions; longer ones are
    left out.
    """
    size, count = len(model.sums), len(model.values)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    explained = model.values / model.trace if count else model.values

    def projected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            multiples = _multiples(_matrix(batch, size), model)
            each = pa.array(np.repeat(np.arange(rows), count))
            total = rows * count
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    pa.array(np.full(total, model.n), pa.int64()),
                    _deviations(multiples).take(each),
                    pa.array(_whitened(multiples, model).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array([model.identity_error] * total, pa.float64()),
                ],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    whole = whole_vectors(vectors, model.scale, model.shift).where(F.size("x") <= size)
    return _filled(whole, size, model.shift).mapInArrow(projected, schema)
