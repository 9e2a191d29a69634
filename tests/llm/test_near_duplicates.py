import random

import numpy as np
import pyarrow as pa
import pytest
from brute import TEXTS, groups, odd_documents, shingles

from ledgerlake.llm import near_duplicates as near
from ledgerlake.llm.common import written
from ledgerlake.llm.components import Forest, components


def check(spark, rows):
    sets = [shingles(text) for _, text in rows]
    found = near.near_duplicates(odd_documents(spark, rows))
    got = {}
    for row in found.collect():
        got.setdefault(row.doc_id, set()).add((row.n_shingles, row.component_id, row.kept))
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    first = groups([sets[k] for k in order])
    for k, root in zip(order, first):
        doc, least = rows[k][0], rows[order[root]][0]
        assert got[doc] == {(len(sets[k]), least, least == doc)}


def variants(draw, words, count, changes):
    for _ in range(count):
        own = list(words)
        for _ in range(changes):
            own[draw.randrange(len(own))] = f"new{draw.random()}"
        yield " ".join(own)


def test_brute_force(spark):
    draw = random.Random(5)
    rows = []
    for topic in range(4):
        words = [f"t{topic}w{k}" for k in range(100)]
        # Two changes leave pairs of changed texts around the limit of similarity.
        rows += enumerate(variants(draw, words, 12, 2), len(rows))
    chain = [f"c{k}" for k in range(80)]
    for step in range(6):
        rows.append((len(rows), " ".join(chain[step * 6 : step * 6 + 50])))
    rows += [(len(rows) + k, f"short {k % 3}") for k in range(9)]
    draw.shuffle(rows)
    check(spark, rows)


def test_prefixes_find_what_stars_miss(spark, monkeypatch):
    monkeypatch.setattr(near, "STAR_ROUNDS", 1)
    monkeypatch.setattr(near, "BLOCK", 4)
    draw = random.Random(8)
    words = [f"w{k}" for k in range(90)]
    check(spark, list(enumerate(variants(draw, words, 40, 2))))


def template_pages(count, own, size=200):
    """Pages that share all but ``own`` of their words, which stand together."""
    shared = [f"template{k}" for k in range(size - own)]
    return [(k, " ".join([*shared, *(f"own{k}-{j}" for j in range(own))])) for k in range(count)]


def shipped(spark, monkeypatch, rows):
    """Rows of every table that is written on the way."""
    seen = {}

    def counted(frame, name):
        out = written(frame, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(near, "written", counted)
    found = near.near_duplicates(odd_documents(spark, rows)).collect()
    monkeypatch.setattr(near, "written", written)
    return seen, {row.doc_id: row.component_id for row in found}


def test_pages_of_a_template_are_not_compared(spark, monkeypatch):
    """At a similarity of 0.66 they share buckets; with twice the pages twice as much travels."""
    monkeypatch.setattr(near, "STAR_ROUNDS", 1)
    sizes = []
    for count in (150, 300):
        seen, roots = shipped(spark, monkeypatch, template_pages(count, 40))
        assert roots == {k: k for k in range(count)}
        assert seen.get("met", 0) == 0
        sizes.append(seen)
    assert sizes[1]["prefixes"] <= 2.2 * sizes[0]["prefixes"]


def test_template_pages_of_many_sizes_and_links_among_them(spark, monkeypatch):
    monkeypatch.setattr(near, "STAR_ROUNDS", 1)
    draw = random.Random(12)
    rows = []
    for k in range(60):
        words = [f"template{j}" for j in range(160)] + [f"own{k % 45}-{j}" for j in range(20 + k % 30)]
        words[draw.randrange(160)] = f"other{k % 7}"
        rows.append((k, " ".join(words)))
    check(spark, rows)


def test_repeated_rows_are_one_text(spark, monkeypatch):
    words = [f"w{k}" for k in range(80)]
    rows = [(0, " ".join(words))] * 400
    rows += [(k, " ".join([*words[:-k], *(f"end{k}-{j}" for j in range(k))])) for k in range(1, 6)]
    seen, roots = shipped(spark, monkeypatch, rows)
    assert seen["texts"] == 6
    assert set(roots.values()) == {0}


def test_odd_documents(odd):
    rows = {}
    for row in near.near_duplicates(odd).collect():
        rows.setdefault(row.doc_id, []).append(row)
    assert sum(map(len, rows.values())) == len(TEXTS)
    assert {rows[k][0].component_id for k in (3, 4, 5)} == {3}
    assert [rows[k][0].kept for k in (3, 4, 5)] == [True, False, False]
    assert rows[9][0].component_id == rows[10][0].component_id == 9
    for blank in (6, 7, 8):
        assert (rows[blank][0].n_shingles, rows[blank][0].kept) == (0, True)
    assert [(x.n_shingles, x.component_id) for x in rows[17]] == [(1, 17)] * 2
    assert all(x.kept and x.component_id is None for x in rows[None])
    assert rows[12][0].n_shingles == 1


def test_empty(none):
    assert near.near_duplicates(none).collect() == []


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    errors = []
    for shared in range(0, 300, 10):
        base = draw.integers(0, 1 << 63, 300, dtype=np.uint64)
        other = np.concatenate([base[:shared], draw.integers(0, 1 << 63, 300 - shared, np.uint64)])
        a, b = np.unique(base), np.unique(other)
        one, two = near.signatures([a, b])
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append((one == two).mean() - real)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.04  # a plain signature of this size has 0.044 at worst


def test_signatures_do_not_depend_on_the_batch():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 4, 50, 2000)]
    together = near.signatures(sets)
    assert all((near.signatures([x])[0] == y).all() for x, y in zip(sets, together))


def test_similarity_limit_is_exact():
    base = np.arange(100, dtype=np.uint64)
    assert near.linked(base[:75], base)
    assert not near.linked(base[:74], base)
    assert not near.linked(base[:0], base[:0])


def test_shingles_of_texts_side_by_side():
    sets = near.shingle_sets(pa.array(["a b c d e f", "", "A b", "a b"], pa.large_string()))
    assert [len(x) for x in sets] == [2, 0, 1, 1]
    assert sets[2].tolist() == sets[3].tolist()


@pytest.mark.parametrize("task_links", [0, 1000])
def test_components_of_a_path_and_a_star(spark, task_links):
    path = [(k, k + 1) for k in range(10, 40)]
    star = [(100, k) for k in range(101, 140)]
    links = spark.createDataFrame(path + star + [(7, 7)], "a long, b long").repartition(4)
    found = {x.node: x.root for x in components(links, task_links).collect()}
    assert found == {k: 10 for k in range(10, 41)} | {k: 100 for k in range(100, 140)}


def test_forest():
    forest = Forest()
    for a, b in ((3, 2), (5, 4), (2, 4)):
        forest.join(a, b)
    assert sorted(forest.stars()) == [(3, 2), (4, 2), (5, 2)]
