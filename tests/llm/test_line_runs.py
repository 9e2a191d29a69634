import random
from collections import Counter

import pytest
from brute import TEXTS, odd_documents, without_runs

from ledgerlake.llm.line_dedup import remove_repeated_chunks, remove_repeated_runs

both = pytest.mark.parametrize("remove", [remove_repeated_chunks, remove_repeated_runs])


def got(frame):
    rows = frame.select("row.doc_id", "kept", "n_lines", "n_removed").collect()
    return Counter(map(tuple, rows))


@both
def test_odd_documents(remove, odd):
    found = remove(odd)
    assert got(found) == without_runs(TEXTS)
    assert found.select("row.*").columns == odd.columns


@both
def test_brute_force(remove, spark):
    draw = random.Random(4)
    blocks = [[f"block {b} line {k}" for k in range(9)] for b in range(4)]
    rows = [(None, "a\nb\nc"), (-1, "x\na\nb\ny"), (-2, "s\ns\ns"), (-3, "s\ns\ns\ns\ns"), (-4, "\n\n\n")]
    for doc in range(80):
        lines = [f"own {draw.randrange(60)}" for _ in range(draw.randrange(12))]
        at = draw.randrange(len(lines) + 1)
        lines[at:at] = draw.choice(blocks)[draw.randrange(3) : draw.randrange(4, 10)]
        rows.append((doc, "\n".join(lines)))
    rows.append(rows[-1])
    assert got(remove(odd_documents(spark, rows))) == without_runs(rows)


@both
def test_two_lines_in_otherwise_different_documents_go(remove, spark):
    rows = [(k, f"head {k}\nfirst of two\nsecond of two\ntail {k}") for k in range(40)]
    kept = {x.row.doc_id: x.kept for x in remove(odd_documents(spark, rows)).collect()}
    assert kept.pop(0) == rows[0][1]
    assert kept == {k: f"head {k}\ntail {k}" for k in range(1, 40)}


@both
def test_empty(remove, none):
    assert remove(none).collect() == []
