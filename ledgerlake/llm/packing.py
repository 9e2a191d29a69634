"""Packing of documents into sequences by length patterns.

The plan is made on the histogram of piece lengths, which has at most ``capacity``
entries whatever the data hold:

1. Lengths are rounded to bins, and all patterns of two to ``PATTERN_DOCUMENTS`` bins
   that fill a sequence are listed. Non-negative least squares fits how often each is to
   be used so that the patterns together use up the histogram. Rounded down, each use
   takes real lengths of its bins, the last one to fit exactly if it can.
2. What is left is packed by best fit, longest first, into the patterns' gaps and new
   sequences. All pieces of one length are placed together, so this too
   costs as many steps as there are lengths and kinds of gaps.

The plan says where the r-th piece of each length goes. Pieces learn their r from counts
by (task, length), so no document moves, and no length, however frequent, is gathered.

A document's tokens are its ids and one end id. Only a document longer than a sequence is
cut, into pieces of full length and a rest. NULL and empty texts have the end id only.
NULL and repeated doc_ids are rows like others. Other columns of the input play no part;
an empty table gives no pieces.
"""

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import steps, written
from ledgerlake.llm.tokens import part_encoder

CAPACITY = 2048
PATTERN_DOCUMENTS = 4
#: Numbers of bins and shares of the fitted uses that are tried; the fewest sequences count.
BINS = (32, 64)
SHARES = (1.0, 0.9, 0.7, 0.4)
#: Documents of up to this part of a sequence weigh little in the fit: they fill gaps.
SMALL = 1 / 16
_STEP = 4 << 20
_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, own_rank long"
)
_PLACED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)

#: Sequences of one kind: how many, and the lengths in each.
Group = tuple[int, tuple[int, ...]]


def length_patterns(bins: int, most: int) -> np.ndarray:
    """All multisets of two to ``most`` bins that sum to ``bins``, as counts by bin."""
    found: list[list[int]] = []

    def extend(chosen: list[int], left: int) -> None:
        if left == 0 and len(chosen) > 1:
            found.append(chosen)
        if len(chosen) < most:
            for bin_ in range(min(left, chosen[-1] if chosen else bins - 1), 0, -1):
                if bin_ * (most - len(chosen)) < left:
                    break
                extend([*chosen, bin_], left - bin_)

    extend([], bins)
    counts = np.zeros((len(found), bins + 1))
    for row, chosen in enumerate(found):
        np.add.at(counts[row], chosen, 1)
    return counts


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 with small ``|a x - b|``, by accelerated projected gradients."""
    step = 1 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    x = ahead = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, ahead - step * (a.T @ (a @ ahead - b)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def pattern_groups(
    histogram: np.ndarray, capacity: int, bins: int, share: float
) -> list[Group]:
    """Sequences by fitted patterns; takes what they use out of ``histogram``.

    Patterns get ``share`` of their fitted uses. The last document of each is the longest
    that still fits, not shorter than its bin by more than a bin.
    """
    width = capacity / bins
    bin_of = np.rint(np.arange(capacity + 1) / width).astype(int)
    counts = np.bincount(bin_of, weights=histogram, minlength=bins + 1)
    patterns = length_patterns(bins, PATTERN_DOCUMENTS)
    if not len(patterns):
        return []
    weights = np.where(np.arange(bins + 1) > SMALL * bins, 1.0, 0.05)
    uses = nonnegative_least_squares((patterns * weights).T, counts * weights) * share
    lengths = np.flatnonzero(histogram).tolist()  # those that are left, ascending

    def longest(most: int, slot: int, taken: dict[int, int]) -> int | None:
        at = bisect_right(lengths, most) - 1
        while at >= 0 and histogram[lengths[at]] <= taken[lengths[at]]:
            at -= 1
        return lengths[at] if at >= 0 and bin_of[lengths[at]] >= slot - 1 else None

    groups: list[Group] = []
    for row in np.argsort(-uses, kind="stable"):
        use = int(uses[row] + 1e-6)
        slots = np.repeat(np.arange(bins + 1), patterns[row].astype(int))[::-1].tolist()
        while use > 0:
            items: list[int] = []
            taken: dict[int, int] = defaultdict(int)
            for k, slot in enumerate(slots):
                room = capacity - sum(items)
                top = room if k == len(slots) - 1 else min(room, int((slot + 0.5) * width))
                length = longest(top, slot, taken)
                if length is None:
                    break
                items.append(length)
                taken[length] += 1
            if len(items) < len(slots):
                break
            run = min(use, *(int(histogram[x]) // n for x, n in taken.items()))
            for length, n in taken.items():
                histogram[length] -= run * n
                if not histogram[length]:
                    del lengths[bisect_right(lengths, length) - 1]
            groups.append((run, tuple(items)))
            use -= run
    return groups


def best_fit(histogram: np.ndarray, groups: list[Group], capacity: int) -> list[Group]:
    """The groups with all of ``histogram`` added, longest first, into the smallest gap."""
    by_gap: dict[int, list[Group]] = defaultdict(list)
    for group in groups:
        by_gap[capacity - sum(group[1])].append(group)
    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length])
        gap = length
        while left:
            while gap < capacity and not by_gap.get(gap):
                gap += 1
            count, items = by_gap[gap].pop() if by_gap.get(gap) else (left, ())
            use = min(count, left)
            if count > use:
                by_gap[gap].append((count - use, items))
            by_gap[gap - length if items else capacity - length].append((use, (*items, length)))
            left -= use
            gap = min(gap, max(length, gap - length))
    return [group for gap in sorted(by_gap) for group in by_gap[gap]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences that hold every length as often as ``histogram`` says."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    full, left[capacity] = int(left[capacity]), 0
    groups: list[Group] = []
    for bins, share in product(BINS, SHARES):
        rest = left.copy()
        found = pattern_groups(rest, capacity, min(bins, capacity), share)
        found = best_fit(rest, found, capacity)
        if not groups or sum(n for n, _ in found) < sum(n for n, _ in groups):
            groups = found
    return [(full, (capacity,)), *groups] if full else groups


def slots(groups: list[Group]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset) of consecutive pieces."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, items in groups:
        offset = 0
        for length in items:
            rows[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {length: np.array(found, np.int64) for length, found in rows.items()}


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(tokenizer)
        end = np.array([end_id], "<u4")
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for step in steps(batches, "text", _STEP):
            ids, offsets = encoder.encode(step.column("text"))
            ids = ids.astype("<u4")
            totals = np.diff(offsets) + 1
            counts = -(-totals // capacity)
            row = np.repeat(np.arange(len(totals)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(capacity, totals[row] - start)
            begin = offsets[row] + start
            last = start + length == totals[row]
            crcs = [
                zlib.crc32(end, zlib.crc32(ids[b : b + n - 1])) if z else zlib.crc32(ids[b : b + n])
                for b, n, z in zip(begin.tolist(), length.tolist(), last.tolist())
            ]
            order = np.argsort(length, kind="stable")
            found, first, each = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(first - seen[found], each)
            seen[found] += each
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("doc_id").take(pa.array(row)).cast(pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(rank),
                ],
                names=[x.split()[0] for x in _PIECES.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(pieces, _PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there; see the module's text."""
    pieces = written(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # <= capacity rows
    places = slots(plan({row["length"]: row["n"] for row in histogram}, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                rows = places[int(length)]
                at = np.searchsorted(rows[:, 0], ranks[own], "right") - 1
                sequence[own] = rows[at, 1] + ranks[own] - rows[at, 0]
                offset[own] = rows[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[x.split()[0] for x in _PLACED.split(", ")],
            )

    return (
        pieces.join(before, ["part", "length"])
        .select(
            *("doc_id", "piece", "start", "length", "ids_crc32"),
            (F.col("own_rank") + F.col("before")).alias("rank"),
        )
        .mapInArrow(place, _PLACED)
    )
