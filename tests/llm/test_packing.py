import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm.packing import length_patterns, nonnegative_least_squares, pack, plan, slots
from ledgerlake.llm.tokens import WORD_BPE, vocabulary


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=40))
def test_plan_holds_every_piece(histogram):
    groups = plan(dict(histogram), 64)
    used = Counter()
    for count, items in groups:
        assert count > 0 and sum(items) <= 64
        for length in items:
            used[length] += count
    assert used == Counter(histogram)


@pytest.mark.parametrize(
    "lengths",
    [
        lambda draw: np.minimum(2048, draw.lognormal(6, 1, 40_000).astype(int) + 1),
        lambda draw: draw.integers(1, 700, 20_000),
    ],
)
def test_sequences_are_nearly_full(lengths):
    found = lengths(np.random.default_rng(1))
    values, counts = np.unique(found, return_counts=True)
    groups = plan(dict(zip(values.tolist(), counts.tolist())))
    assert sum(n for n, _ in groups) <= 1.005 * found.sum() / 2048 + 1


def test_patterns_fill_a_sequence():
    patterns = length_patterns(12, 3)
    assert (patterns @ np.arange(13) == 12).all()
    assert set(patterns.sum(axis=1)) == {2, 3}
    assert len({tuple(x) for x in patterns}) == len(patterns) == 18


def test_least_squares_stay_nonnegative():
    a = np.array([[2.0, 1.0], [0.0, 1.0], [1.0, 1.0]])
    x = nonnegative_least_squares(a, a @ np.array([3.0, 2.0]))
    assert np.allclose(x, [3, 2], atol=1e-3)
    assert nonnegative_least_squares(a, np.array([-1.0, -1.0, -1.0])).tolist() == [0, 0]


def test_slots_follow_the_plan():
    found = slots([(2, (5, 3, 3)), (1, (3,))])
    assert found[5].tolist() == [[0, 0, 0]]
    assert found[3].tolist() == [[0, 0, 5], [2, 0, 8], [4, 2, 0]]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_documents(odd, capacity):
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    expected = Counter()
    for doc, text in TEXTS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            key = (doc, start // capacity, start, len(piece), zlib.crc32(piece.tobytes()))
            expected[key] += 1
    rows = pack(odd, vocabulary(WORD_BPE), capacity=capacity).collect()
    assert Counter(tuple(x)[:5] for x in rows) == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_empty(none):
    assert pack(none, vocabulary(WORD_BPE)).collect() == []
