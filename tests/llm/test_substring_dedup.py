import random
from collections import Counter

import numpy as np
import pytest
from brute import TEXTS, WORD, odd_documents, repeated_words

from ledgerlake.llm.substring_dedup import leftmost_minima, remove_repeats, repeated_windows


def expected(rows, window):
    left = repeated_words([text for _, text in rows], window)
    return Counter(
        (doc, len(w), len(w) - len(kept), " ".join(kept)) for (doc, _), (w, kept) in zip(rows, left)
    )


def got(frame):
    rows = frame.select("doc_id", "n_words", "n_removed", "kept").collect()
    return Counter(map(tuple, rows))


def test_odd_documents(odd):
    assert got(remove_repeats(odd)) == expected(TEXTS, 35)


# Buckets of two strings are split, so that singles meet again across tasks.
@pytest.mark.parametrize("bucket", [2, 4096])
def test_brute_force(spark, bucket):
    draw = random.Random(3)
    passages = [" ".join(draw.choices("abcdefgh", k=12)) for _ in range(3)]
    rows = []
    for doc in range(120):
        words = draw.choices("abcdefghijklmnop", k=draw.randrange(0, 40))
        words.insert(draw.randrange(len(words) + 1), draw.choice(passages))
        rows.append((doc, draw.choice([" ", "\n", "  "]).join(words)))
    frame = remove_repeats(odd_documents(spark, rows), window=8, gram=2, bucket=bucket)
    assert got(frame) == expected(rows, 8)


def test_a_hot_passage_with_different_edges(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(k, f"a{k} b{k} {passage} c{k} d{k}") for k in range(60)]
    frame = remove_repeats(odd_documents(spark, rows), window=8, gram=2, bucket=3)
    assert got(frame) == expected(rows, 8)


def test_empty(none):
    assert remove_repeats(none).collect() == []


def test_minima_are_leftmost():
    values = np.array([3, 1, 1, 2, 0, 0, 5], np.uint64)
    assert leftmost_minima(values, 3).tolist() == [1, 1, 4, 4, 4]


def test_windows_inside_one_string():
    packs = [("a b a b a b", 1), ("x y z", 2)]
    repeated, single, known = repeated_windows(packs, 2, whole=False)
    assert repeated == [[0, 1, 2, 3, 4], [0, 1]]
    assert single == []
    assert sorted(known) == ["a b", "b a", "x y", "y z"]


def test_words_are_bytes_between_white_space():
    assert WORD.findall("a b c d\x1fe") == ["a b", "c d\x1fe"]
