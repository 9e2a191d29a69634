import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import vector_search
from ledgerlake.llm.vector_search import top_k

SCHEMA = "vec_id long, embedding array<float>, pivot int, score long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 0, 0, 0) for row in rows], SCHEMA).repartition(3)


def expected(rows, k, every):
    whole = {}
    for vec, values in rows:
        if vec is None or values is None:
            continue
        if any(x is None or not math.isfinite(x) for x in values):
            continue
        whole.setdefault(vec, set()).add(tuple(math.floor(256 * x) for x in values))
    out = Counter()
    for query, vectors in whole.items():
        if query % every:
            continue
        for own in vectors:
            scores = [
                (-sum(a * b for a, b in zip(own, other)), vec)
                for vec, others in whole.items()
                if vec != query
                for other in others
            ]
            for rank, (score, vec) in enumerate(sorted(scores)[:k], 1):
                out[query, rank, vec, -score] += 1
    return out


def got(found):
    return Counter(map(tuple, found.collect()))


def vectors(draw, count, size=6):
    """Every third vector is the same; the others are whole multiples of 1/256."""
    return [
        (k, [0.5] * size if k % 3 == 0 else [draw.randrange(-99, 99) / 256 for _ in range(size)])
        for k in range(count)
    ]


@pytest.mark.parametrize("annulus", [4, 256])
def test_brute_force(spark, monkeypatch, annulus):
    monkeypatch.setattr(vector_search, "PACK", 3)
    monkeypatch.setattr(vector_search, "PIVOTS", 5)
    build = vector_search.build_index
    monkeypatch.setattr(vector_search, "build_index", lambda *x: build(*x, annulus=annulus))
    rows = vectors(random.Random(1), 150)
    assert got(top_k(frame(spark, rows), k=4, every=10, shard=3)) == expected(rows, 4, 10)


def clustered(draw, count, clusters=24, size=12, spread=0.02):
    """Points near centres of equal norm."""
    centres = [[draw.gauss(0, 1) for _ in range(size)] for _ in range(clusters)]
    centres = [[x / math.hypot(*c) for x in c] for c in centres]
    return [(k, [x + draw.gauss(0, spread) for x in draw.choice(centres)]) for k in range(count)]


def test_most_annuli_of_clustered_vectors_are_passed_over(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "PACK", 8)
    build = vector_search.build_index
    monkeypatch.setattr(vector_search, "build_index", lambda *x: build(*x, annulus=16))
    rows = clustered(random.Random(5), 2000)
    assert got(top_k(frame(spark, rows), k=4, every=40)) == expected(rows, 4, 40)
    assert vector_search.visited_share(frame(spark, rows), k=4, every=40) < 0.25
    # Without a bound, as for fewer candidates than are wanted, everything is looked into.
    assert vector_search.visited_share(frame(spark, rows[:50]), k=60, every=10) == 1.0


def test_other_pivots_rule_out_what_the_nearest_does_not():
    """A query as far from an annulus' own pivot as its vectors are, but on the other side."""
    lows, highs = np.array([1.0, 3.0]), np.array([1.2, 3.4])
    d = np.array([[1.1, 1.0]])
    one = vector_search.best_possible(d[:, :1], lows[:1], highs[:1], np.ones(1), 1.0)
    both = vector_search.best_possible(d, lows, highs, np.ones(1), 1.0)
    assert one[0] > 0.99 and both[0] < -0.99


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (10, [3.0]),
        (20, []),
        (5, [1.0, None]),
        (6, [float("nan"), 1.0]),
        (7, [float("inf"), 1.0]),
        (8, None),
        (None, [9.0, 9.0]),
        (3, [-1.0, 0.001]),
        (4, [0.0, 0.0]),
    ]
    assert got(top_k(frame(spark, rows), k=5, every=10)) == expected(rows, 5, 10)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(2**20 + k), -float(2**20 - 3 * k), 1.0]) for k in range(30)]
    assert got(top_k(frame(spark, rows), k=3, every=10)) == expected(rows, 3, 10)


def test_fewer_candidates_than_wanted(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    assert got(top_k(frame(spark, rows))) == Counter({(0, 1, 1, 131072): 1})


def test_empty(spark):
    assert top_k(frame(spark, [])).collect() == []
    assert top_k(frame(spark, [(1, None)])).collect() == []
    assert vector_search.visited_share(frame(spark, [])) is None
    assert vector_search.visited_share(frame(spark, [(1, [1.0])])) is None
