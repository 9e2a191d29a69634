"""Removal of long repeated passages, by super-k-mers.

A window is ``WINDOW`` consecutive words of one document, a word a longest run of bytes
other than white space. Every word that lies in a window whose words also stand anywhere
else, in the same document or another, is removed; windows are judged on the input.

1. Of the ``GRAM``-word grams in a window the one with the smallest hash, leftmost if it
   repeats, is its minimiser. Equal windows have equal minimisers. Consecutive windows
   that share one minimiser are a super-k-mer.
2. A minimiser that occurs once can't belong to a repeated window. Only super-k-mers of
   the others travel, each as one packed string of its words, to their minimiser's
   bucket. Equal strings are counted before they travel.
3. In its bucket all windows are sorted by their words, byte by byte; a window that
   occurs twice is repeated. A bucket of more than ``BUCKET`` different strings is dealt
   over several tasks. What is single in one of these is counted once more by its words
   across them, after each has added up its own.
4. Repeated windows go back to the documents that have the strings, as spans of words.

Results by row: NULL, empty and short texts keep all their words. Rows are told apart by
doc_id and text; a row that repeats both counts as another document, so that its windows
repeat. Other columns of the input play no part. An empty table gives no rows.
"""

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW_KEY, row_key, steps, text_bytes, written
from ledgerlake.llm.words import gram_hashes, span_hashes, word_spans

WINDOW = 35
GRAM = 6
BUCKET = 4096

_RESULT = f"row_key {ROW_KEY}, doc_id long, n_words long, n_removed long, kept string"


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value, leftmost of equals, among each run of ``width``."""
    at = np.arange(len(values))
    have = 1
    while have < width:
        step = min(have, width - have)
        one, two = at[: len(at) - step], at[step:]
        at = np.where(values[two] < values[one], two, one)
        have += step
    return at


def super_kmers(
    words: np.ndarray, before: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first window, number of windows and minimiser of all super-k-mers.

    ``words`` holds the word hashes of all texts, ``before`` where each text's begin.
    """
    counts = np.maximum(0, np.diff(before) - window + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(text):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64)
    first = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    grams = gram_hashes(words, gram)
    at = leftmost_minima(grams, window - gram + 1)[before[:-1][text] + first]
    new = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(text, prepend=-1))
    sizes = np.diff(new, append=len(text))
    return text[new], first[new], sizes, grams[at[new]]


def _normal(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins, one entry longer."""
    keep = np.zeros(len(data) + 1, bool)
    edges = np.zeros(len(data) + 2, np.int8)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    inside = np.cumsum(edges[:-1]) > 0
    joined = np.append(data, np.uint8(0x20))
    # Words that touch, at the edge of two texts, leave no byte between them for a space.
    touching = np.isin(ends, starts)
    if touching.any():
        pieces = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        return b" ".join(pieces) + b" ", np.cumsum([0, *(ends - starts + 1)])
    keep[:] = inside
    keep[ends] = True
    joined[ends] = 0x20
    return joined[keep].tobytes(), np.cumsum(np.concatenate([[0], ends - starts + 1]))


def _read(step: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(step.column("text"))
    return data, *word_spans(data, offsets)


def _minimisers(window: int, gram: int) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            data, starts, ends, before = _read(step)
            words = span_hashes(data, starts, ends)
            text, _, _, minimiser = super_kmers(words, before, window, gram)
            yield pa.RecordBatch.from_arrays(
                [step.column("row_key").take(pa.array(text)), pa.array(minimiser.view(np.int64))],
                names=["row_key", "minimiser"],
            )

    return found


def _packs(window: int, gram: int) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            data, starts, ends, before = _read(step)
            words = span_hashes(data, starts, ends)
            text, first, size, minimiser = super_kmers(words, before, window, gram)
            lists = step.column("shared")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            shared = lists.flatten().to_numpy().view(np.uint64)
            wanted = np.zeros(len(text), bool)
            order = np.lexsort((shared, owner))
            owner, shared = owner[order], shared[order]
            ends_of = np.searchsorted(owner, np.arange(len(lists) + 1))
            cuts = np.searchsorted(text, np.arange(len(lists) + 1))
            for k in range(len(lists)):
                a, b = cuts[k], cuts[k + 1]
                wanted[a:b] = np.isin(minimiser[a:b], shared[ends_of[k] : ends_of[k + 1]])
            text, first, size = text[wanted], first[wanted], size[wanted]
            minimiser = minimiser[wanted]
            normal, places = _normal(data, starts, ends)
            begin = before[:-1][text] + first
            spans = zip(places[begin].tolist(), places[begin + size + window - 1].tolist())
            packs = [normal[a : b - 1] for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("row_key").take(pa.array(text)),
                    pa.array(first),
                    pa.array(minimiser.view(np.int64)),
                    pa.array([xxhash.xxh3_128_digest(x) for x in packs], pa.binary()),
                    pa.array(packs, pa.binary()).cast(pa.string()),
                ],
                names=["row_key", "first", "minimiser", "pack_id", "pack"],
            )

    return found


def _runs(indices: list[int]) -> Iterator[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    for _, run in groupby(enumerate(indices), lambda x: x[1] - x[0]):
        run = list(run)
        yield run[0][1], run[-1][1]


def repeated_windows(
    packs: list[tuple[str, int]], window: int, whole: bool
) -> tuple[list[list[int]], list[tuple[int, int, str]], list[str]]:
    """Sort all windows of the packs (words, how often) and count equal ones.

    The repeated windows of each pack; if the bucket is not ``whole``, also the single
    ones (pack, window, words), and the words of each repeated one.
    """
    windows = []
    for k, (pack, _) in enumerate(packs):
        places = [0]
        at = pack.find(" ")
        while at >= 0:
            places.append(at + 1)
            at = pack.find(" ", at + 1)
        places.append(len(pack) + 1)
        windows += [
            (pack[places[i] : places[i + window] - 1], k, i) for i in range(len(places) - window)
        ]
    windows.sort()
    repeated: list[list[int]] = [[] for _ in packs]
    single: list[tuple[int, int, str]] = []
    known: list[str] = []
    for words, group in groupby(windows, lambda x: x[0]):
        places_of = [(k, i) for _, k, i in group]
        if len(places_of) > 1 or packs[places_of[0][0]][1] > 1:
            for k, i in places_of:
                repeated[k].append(i)
            if not whole:
                known.append(words)
        elif not whole:
            single.append((*places_of[0], words))
    return [sorted(x) for x in repeated], single, known


_MARKS = "pack_id binary, at long, till long, words string, n long"


def _counted(window: int) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> list[tuple]:
            if not held:
                return []
            whole = held[0][3] == 1
            repeated, single, known = repeated_windows(
                [(pack, n) for _, pack, n, _ in held], window, whole
            )
            rows = [
                (held[k][0], a, b, None, None)
                for k, found_ in enumerate(repeated)
                for a, b in _runs(found_)
            ]
            rows += [(held[k][0], i, i, words, 1) for k, i, words in single]
            return rows + [(None, None, None, words, 2) for words in known]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
            names = ["pack_id", "at", "till", "words", "n"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        rows: list[tuple] = []
        names = ("minimiser", "part", "pack_id", "pack", "n", "parts")
        for batch in batches:
            for minimiser, part, *pack in zip(*(batch.column(x).to_pylist() for x in names)):
                if key != (minimiser, part):
                    rows += close()
                    key, held = (minimiser, part), []
                    if len(rows) > 20_000:
                        yield batch_of(rows)
                        rows = []
                held.append(pack)
        rows += close()
        if rows:
            yield batch_of(rows)

    return found


def _removed(window: int) -> Callable:
    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            data, starts, ends, before = _read(step)
            lists = step.column("spans")
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            spans = lists.flatten().to_numpy(zero_copy_only=False)
            begin = np.repeat(before[:-1], counts)
            edges = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edges, begin + (spans >> 32), 1)
            np.add.at(edges, begin + (spans & 0xFFFFFFFF) + window, -1)
            kept = np.cumsum(edges)[:-1] == 0
            normal, places = _normal(data, starts, ends)
            lost = np.concatenate([[0], np.cumsum(~kept)])
            texts = []
            for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
                if lost[a] == lost[b]:
                    texts.append(normal[places[a] : places[b] - 1] if b > a else b"")
                    continue
                own = kept[a:b].astype(np.int8)
                turns = np.diff(own, prepend=0, append=0)
                runs = zip(np.flatnonzero(turns > 0), np.flatnonzero(turns < 0))
                texts.append(
                    b" ".join(normal[places[a + x] : places[a + y] - 1] for x, y in runs)
                )
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("row_key"),
                    step.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(before)),
                    pa.array(lost[before[1:]] - lost[before[:-1]]),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["row_key", "doc_id", "n_words", "n_removed", "kept"],
            )

    return found


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET
) -> DataFrame:
    """Each row's words and what is left of them: row_key, doc_id, n_words, n_removed, kept.

    ``kept`` are the kept words, joined by a space.
    """
    keyed = docs.select("doc_id", "text", row_key())
    # Half of the key will do here: rows that share it pack some spans more, which repeat nowhere.
    slim = keyed.select(F.col("row_key.a").alias("row_key"), "text")
    found = written(
        slim.mapInArrow(_minimisers(window, gram), "row_key long, minimiser long"),
        "minimisers",
    )
    # Written, as are the spans below: a join can split a hot key where both its sides are tables.
    shared = found.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(shared.select("minimiser"), "shared")
    wanted = found.join(shared, "minimiser").groupBy(F.col("row_key").alias("half"))
    wanted = wanted.agg(F.collect_set("minimiser").alias("shared"))
    packs = written(
        keyed.select("row_key", "text")
        .join(wanted, F.col("row_key.a") == F.col("half"))
        .drop("half")
        .mapInArrow(
            _packs(window, gram),
            f"row_key {ROW_KEY}, first long, minimiser long, pack_id binary, pack string",
        ),
        "packs",
    )
    distinct = written(
        packs.groupBy("minimiser", "pack_id", "pack").agg(F.count("*").alias("n")), "distinct"
    )
    split = distinct.groupBy("minimiser").agg(F.ceil(F.count("*") / bucket).alias("parts"))
    split = written(split.where("parts > 1"), "split")
    marks = written(
        distinct.join(split, "minimiser", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.expr("pmod(xxhash64(pack_id, 1), parts)"))
        .repartition("minimiser", "part")
        .sortWithinPartitions("minimiser", "part")
        .select("minimiser", "part", "pack_id", "pack", "n", "parts")
        .mapInArrow(_counted(window), _MARKS),
        "marks",
    )
    opened = marks.where("words is not null")
    again = opened.groupBy("words").agg(F.sum("n").alias("n")).where("n > 1").select("words")
    spans = marks.where("words is null").select("pack_id", "at", "till").union(
        opened.where("pack_id is not null").join(again, "words").select("pack_id", "at", "till")
    )
    # A span is one number, its first window times 2**32 plus its last one.
    span = F.col("at") * (1 << 32) + F.col("till")
    spans = written(spans.groupBy("pack_id").agg(F.collect_list(span).alias("spans")), "spans")
    moved = F.transform("spans", lambda x: x + F.col("first") * ((1 << 32) + 1))
    by_row = packs.select("row_key", "first", "pack_id").join(spans, "pack_id")
    by_row = by_row.select("row_key", moved.alias("spans")).groupBy("row_key")
    by_row = by_row.agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return keyed.join(by_row, "row_key", "left").mapInArrow(_removed(window), _RESULT)
