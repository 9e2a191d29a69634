"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed as LZ78 does: each phrase is the shortest run of code points, from where the
last one ended, that is no phrase yet. Texts that share passages share phrases, as they would
share the dictionary of a compressor. The phrases' hashes are dealt over ``BINS`` bins and the
smallest of each bin is kept (one permutation gives all of them); two fingerprints are as
alike as the part of bins, filled in either, that agree.

Phrases of the shared beginning of a text and its edited text are parsed once.

``neighbours`` brings each text together with the next one in the order of doc_id, without
a global sort in one task: documents go to ranges of some ``RANGE_BYTES`` of text, however
many that makes, and the first of each range also to the range before it. Ranges are cut at
(doc_id, first ``HEAD`` code points), so rows of one doc_id are split as well; only rows that agree
in both are one range, which its task reads as a stream.

NULL and empty texts have no phrase; their fingerprint is all empty bins, and two of them
are alike by 1. A single document is its own next. NULL doc_ids come first; equal doc_ids
follow one another by text. Other columns of the input play no part; an empty table gives
no rows.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.words import mixed

BINS = 128
_EMPTY = 0xFFFF
#: Text of a range, code points that tell rows of one doc_id apart, sampled rows of a range.
RANGE_BYTES, HEAD, SAMPLES = 16 << 20, 32, 16
_POINT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def parse(text: str, phrases: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases of ``text`` from ``start`` on; ``phrases`` holds the earlier ones."""
    ends = []
    for end in range(start + 1, len(text) + 1):
        phrase = text[start:end]
        if phrase not in phrases:
            phrases.add(phrase)
            ends.append(end)
            start = end
    return ends


def _phrase_hashes(points: np.ndarray, ends: list[int]) -> np.ndarray:
    """A hash of each phrase's code points, by prefix sums modulo 2**64."""
    stops = np.array(ends, np.int64)
    starts = np.concatenate([[0], stops[:-1]])
    powers = np.full(len(points) + 1, _POINT)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    back = np.full(len(points) + 1, _INVERSE)
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mixed(points + np.uint64(1)) * powers[:-1], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))


def signature(text: str, ends: list[int]) -> np.ndarray:
    """The smallest hash of each bin, 16 bits of it."""
    out = np.full(BINS, _EMPTY, np.uint16)
    if ends:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        hashes = np.sort(_phrase_hashes(points[: ends[-1]], ends))
        bins = (hashes >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        out[bins[first]] = (mixed(hashes[first]) >> np.uint64(48)) % _EMPTY
    return out


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """The part of the bins filled in either that agree; 1 for two empty fingerprints."""
    filled = (one != _EMPTY) | (two != _EMPTY)
    if not filled.any():
        return 1.0
    return float((one == two)[filled].sum() / filled.sum())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def text_and_edited(text: str, following: str) -> tuple[np.ndarray, str, np.ndarray]:
    """Signature of the text, its edited text and that one's signature."""
    changed = edited(text, following)
    kept = len(text) - len(text) // 2
    phrases: set[str] = set()
    shared = parse(text[:kept], phrases)
    start = shared[-1] if shared else 0
    both = phrases.copy()
    own = signature(text, shared + parse(text, phrases, start))
    return own, changed, signature(changed, shared + parse(changed, both, start))


#: Place of a row in the order: whether it has a doc_id, that, and how its text begins.
Key = tuple[bool, int, str]


def _key() -> Column:
    return F.struct(
        F.isnotnull("doc_id").alias("known"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.left("text", F.lit(HEAD)).alias("head"),
    )


def _keys(keys: pa.StructArray) -> Iterator[Key]:
    return zip(*(keys.field(x).to_pylist() for x in ("known", "id", "head")))


def _numbered(place: Callable[[Key], int | None]):
    """A function of keys, by Arrow arrays: the number that ``place`` gives, or NULL."""

    @F.arrow_udf("int")
    def number(keys: pa.Array) -> pa.Array:
        return pa.array([place(key) for key in _keys(keys)], pa.int32())

    return number(_key())


def _cuts(docs: DataFrame) -> list[Key]:
    """Where ranges begin, but for the first.

    The rows that a hash picks are sorted by tasks, and every ``SAMPLES``th is a cut: one key for
    some ``RANGE_BYTES``, which is what the driver and every task know of the rows.
    """
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ranges = -(-(size["bytes"] or 0) // RANGE_BYTES)
    if ranges < 2:
        return []
    one_of = max(1, size["n"] // (SAMPLES * ranges))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_of)) == 0)

    def every(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % SAMPLES, batch.num_rows, SAMPLES)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    order = ("known", "id", "head")
    sample = picked.select(_key().alias("key")).select("key.*")
    sample = sample.repartitionByRange(*order).sortWithinPartitions(*order)
    found = sample.mapInArrow(every, "known boolean, id long, head string").distinct()
    return sorted(map(tuple, found.collect()))


def neighbours(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (range, doc_id, text, extra) such that each range, sorted by doc_id, text and
    ``extra`` last, holds consecutive documents and at its end the one that follows; and how many
    ranges there may be.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = _cuts(docs)
    placed = docs.withColumn("range", _numbered(lambda key: bisect_right(cuts, key)))
    least = placed.groupBy("range").agg(F.min(_key()).alias("key")).orderBy("range").collect()
    # A range's first document also follows the range before it, and the very first the last.
    earlier = {tuple(own.key): least[k - 1]["range"] for k, own in enumerate(least)}
    copies = docs.withColumn("range", _numbered(earlier.get)).where("range is not null")
    rows = placed.withColumn("extra", F.lit(False)).union(copies.withColumn("extra", F.lit(True)))
    return rows, len(cuts) + 1


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _hex(signature_: np.ndarray) -> str:
    return signature_.astype(">u2").tobytes().hex()


class _Sequence:
    """Documents of one range in order; a row is ready when the next document is described."""

    def __init__(self):
        self._held: tuple[int | None, str] | None = None  # the last document
        self._row: tuple | None = None  # of the one before it, but for the likeness to the last
        self._own: np.ndarray | None = None
        self._closed = False

    def add(self, doc: int | None, text: str, extra: bool) -> list[tuple]:
        """Rows that are ready; ``extra`` is the range's end, which gives no row itself."""
        ready: list[tuple] = []
        if self._closed:
            return ready  # another row of the doc_id that follows the range
        if self._held is not None:
            last, own_text = self._held
            own, changed, changed_own = text_and_edited(own_text, text)
            if self._row is not None:
                ready.append((*self._row, likeness(self._own, own)))
            digest = hashlib.sha256(changed.encode()).hexdigest()
            near = likeness(own, changed_own)
            self._row = (last, len(own_text), digest, _hex(own), _hex(changed_own), near)
            self._own = own
            if extra:
                ready.append((*self._row, likeness(own, signature(text, parse(text, set())))))
        self._held, self._closed = (doc, text), extra
        return ready


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of each document beside those of its edited text and of the next one."""
    range_, sequence = None, _Sequence()
    for batch in batches:
        rows: list[tuple] = []
        columns = (batch.column(x).to_pylist() for x in ("range", "doc_id", "text", "extra"))
        for at, doc, text, extra in zip(*columns):
            if at != range_:
                range_, sequence = at, _Sequence()
            rows += sequence.add(doc, text, extra)
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    long, text, real = pa.int64(), pa.string(), pa.float64()
    kinds = (long, long, text, text, text, real, real)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
        names=[x.split()[0] for x in _RESULT.split(", ")],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike they and the next's are."""
    rows, ranges = neighbours(docs)
    return (
        rows.repartitionById(ranges, "range")  # a task for each range
        .sortWithinPartitions("range", "extra", F.asc_nulls_first("doc_id"), "text")
        .mapInArrow(_described, _RESULT)
    )
