import math
from collections import defaultdict

import numpy as np
import pytest

from ledgerlake.llm import spectrum, whitening
from ledgerlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def frame(spark, vectors, extra=False):
    schema = "vec_id long, embedding array<float>"
    rows = list(enumerate(vectors)) if not vectors or not isinstance(vectors[0], tuple) else vectors
    made = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("x", "i", "n", "total", "component", "label") if extra else ():
        made = made.selectExpr("*", f"'junk' AS {name}")
    return made


def plain(rows):
    """(n, S, V, rows that take part) in whole numbers, from (vec_id, vector)."""
    used = [
        (vec_id, vector)
        for vec_id, vector in rows
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector)
    ]
    size = max((len(vector) for _, vector in used), default=0)
    whole = [
        (vec_id, tuple(math.floor(64 * np.float32(c).astype(float)) + 10**6 for c in vector))
        for vec_id, vector in used
    ]
    whole = [(vec_id, x + (10**6,) * (size - len(x))) for vec_id, x in whole]
    listed = sorted({x for _, x in whole})
    n, sums = len(listed), [sum(column) for column in zip(*listed)]
    multiples = np.array([[n * a - s for a, s in zip(x, sums)] for x in listed], dtype=object)
    v = (multiples.T @ multiples).astype(object) if n else np.zeros((0, 0))
    exact = np.array([[float(int(a)) / n**3 for a in row] for row in v])
    return n, sums, exact, whole


def check(rows, found, most=16):
    n, sums, v, whole = plain(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > 1e-12 * values.sum()).sum()))
    assert len(found) == len(whole) * count
    got = defaultdict(list)
    for row in found:
        got[row.vec_id].append(row)
    expected = defaultdict(list)
    for vec_id, x in whole:
        expected[vec_id].append(x)
    assert got.keys() == expected.keys()
    for vec_id, own in expected.items():
        deviations = sorted(sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in own)
        assert sorted(r.deviation for r in got[vec_id] if r.component == 1) == deviations
        assert {r.n for r in got[vec_id]} == {n}
        if len(own) > 1:
            continue
        (x,) = own
        centred = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        rows_ = sorted(got[vec_id], key=lambda r: r.component)
        assert [r.component for r in rows_] == list(range(1, count + 1))
        # Length within the space of all components is the same in any basis of it.
        mine = np.array([r.whitened for r in rows_])
        theirs = centred @ vectors[:, :count] / np.sqrt(values[:count])
        gaps = np.abs(np.diff(values[: count + 1])) / values.sum()
        if len(values) == count or gaps[-1] > 1e-6:
            assert mine @ mine == pytest.approx(theirs @ theirs, rel=1e-6, abs=1e-9)
        if (gaps > 1e-6).all():
            assert np.abs(mine) == pytest.approx(np.abs(theirs), rel=1e-6, abs=1e-8)
        explained = np.array([r.explained for r in rows_])
        assert explained == pytest.approx(values[:count] / values.sum(), rel=1e-9)
        assert max(r.identity_error for r in rows_) <= 1e-4


def run(df, **options):
    return whitening.transform(df, whitening.fit(df, **options)).collect()


def random_vectors(count, size, seed=3):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    made = rng.standard_normal((count, size)) * (1 + np.arange(size)) @ turn / 4 + 0.3
    return [[float(np.float32(c)) for c in row] for row in made]


def test_components_of_random_vectors(spark):
    vectors = random_vectors(300, 24)
    check(list(enumerate(vectors)), run(frame(spark, vectors)))


def test_fewer_components(spark):
    vectors = random_vectors(100, 6)
    check(list(enumerate(vectors)), run(frame(spark, vectors), components=3), most=3)


def test_odd_vectors(spark):
    vectors = random_vectors(40, 8)
    rows = [(k, vector) for k, vector in enumerate(vectors)]
    rows += [(0, vectors[0]), (0, vectors[1]), (None, vectors[2])]
    rows += [(50, None), (51, [None] * 8), (52, [NAN] + [0.0] * 7), (53, [-INF] * 8)]
    rows += [(54, []), (55, [1.0]), (56, [0.5] * 9)]
    check(rows, run(frame(spark, rows, extra=True)))


def test_a_vector_that_repeats_counts_once(spark):
    vectors = random_vectors(30, 5)
    rows = list(enumerate(vectors)) + [(100 + k, vectors[7]) for k in range(2000)]
    check(rows, run(frame(spark, rows)))


def test_rows_of_low_rank(spark):
    base = np.array(random_vectors(3, 20)).round(1)
    rows = [(k, [float(c) for c in base[k % 3] * (1 + k // 3)]) for k in range(9)]
    found = run(frame(spark, rows))
    check(rows, found)
    assert found


def test_no_spread_and_no_rows(spark):
    one = frame(spark, [[1.0, 2.0]] * 3)
    assert run(one) == []
    assert run(one.limit(0)) == []
    assert run(frame(spark, [[], None])) == []


def test_exact_beyond_doubles(spark):
    vectors = [[1e9, 0.0], [-1e9, 0.5], [3e9, 0.25], [1e9, 1.0]]
    rows = list(enumerate(vectors))
    found = run(frame(spark, rows))
    n, sums, _, whole = plain(rows)
    for vec_id, x in whole:
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        expected = exact if exact < 2**63 else None
        assert {r.deviation for r in found if r.vec_id == vec_id} == {expected}
    a = np.array([[2**31, 5], [-(2**33), 7]])
    assert (whitening.products(a) == a.astype(object).T @ a.astype(object)).all()


def test_signs_of_pivots_count_eigenvalues():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 30):
        for _ in range(20):
            m = rng.standard_normal((size, size))
            m = m + m.T
            np.fill_diagonal(m, rng.choice([0.0, 1.0], size) * np.diagonal(m))
            assert spectrum.positive_pivots(m) == (np.linalg.eigvalsh(m) > 0).sum()
    assert spectrum.positive_pivots(np.zeros((3, 3))) == 0


SPECTRA = {
    "equal": [3.0] * 40,
    "falling fast": [2.0**-k for k in range(40)],
    "two clusters": [1.0] * 10 + [1 + 1e-9] * 10 + [0.5] * 10,
    "rank 4": [4.0, 3.0, 2.0, 1.0] + [0.0] * 30,
    "one": [2.0],
    "at edges of decades": [1.0, 0.1, 0.01, 0.001] + [1e-4] * 3,
}


@pytest.mark.parametrize("name", SPECTRA)
def test_spectra(spark, name):
    given = np.array(SPECTRA[name])
    turn = np.linalg.qr(np.random.default_rng(5).standard_normal((len(given),) * 2))[0]
    matrix = turn * given @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = spectrum.eigenpairs(spark, matrix, 16)
    expected = np.sort(given)[::-1][:16]
    expected = expected[expected > 1e-12 * given.sum()]
    assert values == pytest.approx(expected, rel=1e-9, abs=1e-13 * given.sum())
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * given.sum()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_more_dimensions_than_fit_are_refused(spark, monkeypatch):
    monkeypatch.setattr(spectrum, "MOST_DIMENSIONS", 3)
    with pytest.raises(ValueError, match="dimensions"):
        spectrum.eigenpairs(spark, np.eye(4), 2)


def test_the_registered_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(row) for row in table.collect()]
    check(rows, QUERIES["op13_whitening"](spark, SF_DIR).collect())
