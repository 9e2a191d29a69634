"""Exact top-k by inner product, with an index of pivots and distances.

Components become whole numbers, ``floor(256 * x)``. With one more coordinate that brings all
vectors to the same norm, a larger inner product is a smaller distance, so distances obey the
triangle inequality: a vector at distance r from a pivot is at least ``|d - r|`` away from
a query at distance d from it.

Index: pivots are taken, far from each other, from a bounded sample (``SAMPLE``); every vector
is keyed by its nearest pivot and its distance. Vectors of one pivot, sorted by distance,
are cut into annuli of up to ``ANNULUS`` vectors, however many are equal. An annulus also knows
the least and the largest distance of its vectors to every other pivot. The k-th best score among
its own annulus is a query's first bound.

Search: the annuli of a pivot are dealt into shards. Queries travel in packs to every shard of
a pivot that can hold something as good as the bound of any of them. There the pack expands
over the sorted annuli, nearest first, raising bounds as it goes, and passes over all
annuli that the triangle inequality rules out from any pivot. The shards' best make the result.
Nothing is approximate: if no bound helps, every pair is computed, in blocks; ``visited_share``
measures how much of the table is.

Vectors that are NULL, or hold a NULL or non-finite component, and rows with a NULL vec_id
take no part. Shorter vectors count as filled up with zeros. Rows that repeat vec_id and
vector are one row; other rows of a query's vec_id are its own and no candidates. Scores
must fit in 64 bits. Other columns of the input play no part; an empty table gives no rows.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import written

SCALE = 256
SAMPLE = 4096
PIVOTS = 64
ANNULUS = 256
PACK = 256
#: Annuli of one shard.
SHARD = 256
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Geometry:
    """Pivots with the added coordinate, the common squared norm, and how vectors are kept."""

    pivots: np.ndarray
    norm: float
    size: int
    width: int  # bytes of a component

    def matrix(self, raw: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(raw), f"<i{self.width}").reshape(-1, self.size)

    def distances(self, vectors: np.ndarray, data: bool) -> np.ndarray:
        """From each vector to each pivot; queries have nothing in the added coordinate."""
        real = vectors.astype(np.float64)
        squares = (real**2).sum(axis=1)
        extra = np.sqrt(np.maximum(0, self.norm - squares)) if data else np.zeros(len(real))
        own = squares + extra**2
        cross = real @ self.pivots[:, :-1].T + extra[:, None] * self.pivots[:, -1]
        other = (self.pivots**2).sum(axis=1)
        return np.sqrt(np.maximum(0, own[:, None] + other - 2 * cross))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    kind = np.float64 if most < _EXACT else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v as whole numbers."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) != F.lit(float("inf"))),
    )
    rows = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.select("vec_id", whole.alias("v"))


def _padded(lists: pa.ListArray, size: int) -> np.ndarray:
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), size), np.int64)
    row = np.repeat(np.arange(len(lists)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[row, at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def far_pivots(sample: np.ndarray, norm: float, count: int) -> np.ndarray:
    """Points of the sample, each the farthest from those before it."""
    real = sample.astype(np.float64)
    extra = np.sqrt(np.maximum(0, norm - (real**2).sum(axis=1)))
    points = np.column_stack([real, extra])
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


_KEYED = "pivot int, distance double, vec_id long, vector binary"
_INDEX = (
    "annulus long, pivot int, lows array<double>, highs array<double>, vec_ids array<long>, "
    "vectors binary, query array<int>, bound array<long>"
)


def build_index(
    whole: DataFrame, geometry: Geometry, k: int, every: int, annulus: int = ANNULUS
) -> DataFrame:
    """All vectors in annuli; ``query`` has the places of query rows, ``bound`` their bounds.

    ``whole`` holds (vec_id, v).
    """

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _padded(batch.column("v"), geometry.size)
            distances = geometry.distances(vectors, data=True)
            pivot = distances.argmin(axis=1)
            raw = vectors.astype(f"<i{geometry.width}")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pivot, pa.int32()),
                    pa.array(distances[np.arange(len(pivot)), pivot]),
                    batch.column("vec_id").cast(pa.int64()),
                    pa.array([x.tobytes() for x in raw], pa.binary()),
                ],
                names=["pivot", "distance", "vec_id", "vector"],
            )

    def annuli(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held: list[tuple[int, float, int, bytes]] = []

        def close() -> pa.RecordBatch:
            nonlocal count
            ids = np.array([x[2] for x in held])
            vectors = geometry.matrix(x[3] for x in held)
            distances = geometry.distances(vectors, data=True)
            places = np.flatnonzero(ids % every == 0)
            bounds = []
            for place, scores in zip(places, products(vectors[places], vectors)):
                others = scores[ids != ids[place]]
                bounds.append(int(np.sort(others)[-k]) if len(others) >= k else None)
            row = {
                "annulus": (part << 32) + count,
                "pivot": held[0][0],
                "lows": distances.min(axis=0).tolist(),
                "highs": distances.max(axis=0).tolist(),
                "vec_ids": ids.tolist(),
                "vectors": vectors.tobytes(),
                "query": places.tolist(),
                "bound": bounds,
            }
            count += 1
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_index_schema())

        for batch in batches:
            names = ("pivot", "distance", "vec_id", "vector")
            last = None
            for row in zip(*(batch.column(x).to_pylist() for x in names)):
                if row == last or (held and row == held[-1]):
                    continue  # a repeated row
                if held and (held[0][0] != row[0] or len(held) == annulus):
                    yield close()
                held.append(row)
                last = row
        if held:
            yield close()

    order = ("pivot", "distance", "vec_id", "vector")
    return written(
        written(whole.mapInArrow(keyed, _KEYED), "keyed")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(annuli, _INDEX),
        "index",
    )


def _index_schema() -> pa.Schema:
    long, real = pa.int64(), pa.float64()
    return pa.schema(
        [
            ("annulus", long),
            ("pivot", pa.int32()),
            ("lows", pa.list_(real)),
            ("highs", pa.list_(real)),
            ("vec_ids", pa.list_(long)),
            ("vectors", pa.binary()),
            ("query", pa.list_(pa.int32())),
            ("bound", pa.list_(long)),
        ]
    )


def best_possible(
    d: np.ndarray, lows: np.ndarray, highs: np.ndarray, squares: np.ndarray, norm: float
) -> np.ndarray:
    """The largest score that queries can have among vectors within the distances to all pivots.

    ``d`` has a row for each query and a column for each pivot.
    """
    gap = np.maximum(0, np.maximum(d - highs, lows - d)).max(axis=1)
    slack = 1e-9 * (squares + norm) + 1e-6
    return (squares + norm - gap**2) / 2 + slack


_PACKS = "pack long, query_ids array<long>, vectors binary, bounds array<long>, pivots array<int>"
_LOWEST = -(1 << 63)


def _query_packs(
    index: DataFrame, geometry: Geometry, reach: dict[int, tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """Queries of consecutive annuli together, with the pivots that any of them must see."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        rows: list[np.ndarray] = []
        bounds: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal count
            vectors = np.stack(rows)
            d = geometry.distances(vectors, data=False)
            squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
            pivots = [
                pivot
                for pivot, (lows, highs) in reach.items()
                if (best_possible(d, lows, highs, squares, geometry.norm) >= bounds).any()
            ]
            row = {
                "pack": (part << 32) + count,
                "query_ids": list(ids),
                "vectors": vectors.tobytes(),
                "bounds": list(bounds),
                "pivots": pivots,
            }
            count += 1
            for x in (ids, rows, bounds):
                x.clear()
            kinds = [("pack", pa.int64()), ("query_ids", pa.list_(pa.int64()))]
            kinds += [("vectors", pa.binary()), ("bounds", pa.list_(pa.int64()))]
            kinds += [("pivots", pa.list_(pa.int32()))]
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

        for batch in batches:
            names = ("vec_ids", "vectors", "query", "bound")
            for own, raw, query, bound in zip(*(batch.column(x).to_pylist() for x in names)):
                matrix = geometry.matrix([raw])
                for place, least in zip(query, bound):
                    ids.append(own[place])
                    rows.append(matrix[place])
                    bounds.append(_LOWEST if least is None else least)
                    if len(ids) == PACK:
                        yield close()
        if ids:
            yield close()

    slim = index.where(F.size("query") > 0).select("vec_ids", "vectors", "query", "bound")
    return slim.mapInArrow(packed, _PACKS)


_FOUND = "pack long, place int, query_id long, vec_id long, score long"


def _search(geometry: Geometry, k: int, opened: Accumulator | None):
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        annuli: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        names = ("pivot", "shard", "pack", "lows", "highs", "ids", "vectors", "bounds")
        for batch in batches:
            out: list[tuple] = []
            for pivot, shard, pack, lows, highs, ids, raw, bounds in zip(
                *(batch.column(x).to_pylist() for x in names)
            ):
                if key != (pivot, shard):
                    key, annuli = (pivot, shard), []
                if pack is None:
                    near, far = np.array(lows), np.array(highs)
                    annuli.append((near, far, np.array(ids), geometry.matrix([raw])))
                else:
                    queries = geometry.matrix([raw])
                    out += expand(pack, np.array(ids), queries, bounds, annuli)
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)],
                    names=[x.split()[0] for x in _FOUND.split(", ")],
                )

    def expand(pack, ids, vectors, bounds, annuli) -> list[tuple]:
        """The best of a shard's annuli for each query of a pack, nearest annuli first."""
        d = geometry.distances(vectors, data=False)
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        floor = np.array(bounds, np.int64)
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        limits = [
            best_possible(d, lows, highs, squares, geometry.norm) for lows, highs, _, _ in annuli
        ]
        for at in sorted(range(len(annuli)), key=lambda x: -float(limits[x].max())):
            open_ = np.flatnonzero(limits[at] >= floor)
            if not len(open_):
                continue
            if opened is not None:
                opened.add(len(open_))
            _, _, own, matrix = annuli[at]
            scores = products(vectors[open_], matrix)
            for row, q in enumerate(open_.tolist()):
                good = np.flatnonzero((scores[row] >= floor[q]) & (own != ids[q]))
                if not len(good):
                    continue
                if len(good) > k:
                    good = good[np.lexsort((own[good], -scores[row][good]))[:k]]
                best[q] += zip((-scores[row][good]).tolist(), own[good].tolist())
                best[q].sort()
                del best[q][k:]
                if len(best[q]) == k:
                    floor[q] = max(floor[q], -best[q][-1][0])
        return [
            (pack, q, int(ids[q]), vec, -score)
            for q, rows in enumerate(best)
            for score, vec in rows
        ]

    return found


def _indexed(vectors: DataFrame, k: int, every: int) -> tuple[Geometry, DataFrame] | None:
    """Pivots and the index of all vectors; None if there are none."""
    whole = whole_vectors(vectors)
    square = F.aggregate(
        "v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    most = F.aggregate("v", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x)))
    shape = whole.agg(
        F.max(F.size("v")).alias("size"), F.max(square).alias("norm"), F.max(most).alias("most")
    ).first()
    if shape["size"] is None:
        return None
    size, norm = max(1, shape["size"]), shape["norm"] * (1 + 1e-9) + 1.0
    width = 2 if shape["most"] < 1 << 15 else 4 if shape["most"] < 1 << 31 else 8
    picked = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample = _padded(picked["v"].combine_chunks(), size)
    geometry = Geometry(far_pivots(sample, norm, PIVOTS), norm, size, width)
    return geometry, build_index(whole, geometry, k, every)


def _found(
    index: DataFrame, geometry: Geometry, k: int, shard: int, opened: Accumulator | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score); ``opened`` counts the annuli that queries look into."""
    ranges = index.select("pivot", F.posexplode(F.arrays_zip("lows", "highs")).alias("to", "d"))
    others = range(len(geometry.pivots))
    ranges = ranges.groupBy("pivot").agg(
        F.count_if(F.col("to") == 0).alias("n"),
        F.array(*(F.min(F.when(F.col("to") == x, F.col("d.lows"))) for x in others)),
        F.array(*(F.max(F.when(F.col("to") == x, F.col("d.highs"))) for x in others)),
    )
    pivots = ranges.collect()  # at most PIVOTS rows of PIVOTS intervals
    reach = {pivot: (np.array(lows), np.array(highs)) for pivot, _, lows, highs in pivots}
    shards = {x["pivot"]: -(-x["n"] // shard) for x in pivots}
    count = F.get(F.lit([shards.get(x, 0) for x in range(PIVOTS)]), F.col("pivot"))
    nothing = F.lit(None)
    data = index.select(
        "pivot",
        F.pmod(F.xxhash64("annulus"), count).cast("int").alias("shard"),
        nothing.cast("long").alias("pack"),
        "lows",
        "highs",
        F.col("vec_ids").alias("ids"),
        "vectors",
        nothing.cast("array<long>").alias("bounds"),
    )
    packs = _query_packs(index, geometry, reach).withColumn("pivot", F.explode("pivots"))
    packs = packs.withColumn("shard", F.explode(F.sequence(F.lit(0), count - 1)))
    packs = packs.select(
        "pivot",
        F.col("shard").cast("int"),
        "pack",
        nothing.cast("array<double>").alias("lows"),
        nothing.cast("array<double>").alias("highs"),
        F.col("query_ids").alias("ids"),
        "vectors",
        "bounds",
    )
    best = (
        data.union(packs)
        .repartition("pivot", "shard")
        .sortWithinPartitions("pivot", "shard", F.asc_nulls_first("pack"))
        .mapInArrow(_search(geometry, k, opened), _FOUND)
    )
    rank = F.row_number().over(
        Window.partitionBy("pack", "place").orderBy(F.desc("score"), "vec_id")
    )
    return (
        best.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row whose vec_id is divisible by ``every``.

    ``vectors`` holds (vec_id, embedding). Equal scores rank by vec_id.
    """
    built = _indexed(vectors, k, every)
    if built is None:
        schema = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], schema)
    geometry, index = built
    return _found(index, geometry, k, shard)


def visited_share(
    vectors: DataFrame, k: int = 5, every: int = 50, shard: int = SHARD
) -> float | None:
    """The part of all pairs of a query and an annulus that the search of ``top_k`` computes.

    None without queries. A task that runs again counts again.
    """
    built = _indexed(vectors, k, every)
    if built is None:
        return None
    geometry, index = built
    opened = vectors.sparkSession.sparkContext.accumulator(0)
    _found(index, geometry, k, shard, opened).write.format("noop").mode("overwrite").save()
    total = index.agg(F.count("*").alias("annuli"), F.sum(F.size("query")).alias("queries")).first()
    return opened.value / (total.annuli * total.queries) if total.queries else None


#: The same in SQL over ``embeddings``, for vectors of equal length.
SQL = """
WITH whole AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scores)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
