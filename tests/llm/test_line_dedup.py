import hashlib
import random
from collections import Counter

from brute import TEXTS, line_chunks, odd_documents, without_runs

from ledgerlake.llm import line_dedup
from ledgerlake.llm.common import written
from ledgerlake.llm.line_dedup import EVERY, remove_repeated_chunks


def value(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def got(frame):
    rows = frame.select("row.doc_id", "kept", "n_lines", "n_removed").collect()
    return Counter(map(tuple, rows))


def test_odd_documents(odd):
    found = remove_repeated_chunks(odd)
    assert got(found) == without_runs(TEXTS)
    assert found.select("row.*").columns == odd.columns


def test_brute_force(spark):
    draw = random.Random(4)
    blocks = [[f"block {b} line {k}" for k in range(9)] for b in range(4)]
    rows = []
    for doc in range(80):
        lines = [f"own {draw.randrange(60)}" for _ in range(draw.randrange(12))]
        at = draw.randrange(len(lines) + 1)
        lines[at:at] = draw.choice(blocks)[draw.randrange(3) :]
        rows.append((doc, "\n".join(lines)))
    assert got(remove_repeated_chunks(odd_documents(spark, rows))) == without_runs(rows)


def test_boundaries_resist_shifts():
    lines = [f"line {k}" for k in range(40)]
    plain = line_chunks("\n".join(lines), value, EVERY)
    moved = line_chunks("\n".join(["new", "lines", *lines]), value, EVERY)
    assert plain[2:] == moved[-len(plain) + 2 :]


def test_any_cut_gives_the_same(spark):
    draw = random.Random(6)
    lines = [f"line {k}" for k in range(12)] + ["s"] * 4
    rows = [(k, "\n".join(draw.choices(lines, k=draw.randrange(25)))) for k in range(60)]
    rows += rows[:3] + [(None, rows[5][1]), (70, None), (71, "")]
    docs = odd_documents(spark, rows)
    expected = without_runs(rows)
    for every in (1, 2, 5, 100):
        assert got(remove_repeated_chunks(docs, every)) == expected


def test_chunks_spare_most_pairs(spark, monkeypatch):
    """Copies are found by their chunks: pairs are left where a chunk ends, or stands first."""
    seen = {}

    def counted(frame, name):
        out = written(frame, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    lines = [f"line {k}" for k in range(300)]
    rows = [(k, f"own {k}\n" + "\n".join(lines)) for k in range(20)]
    found = remove_repeated_chunks(odd_documents(spark, rows))
    assert got(found) == without_runs(rows)
    # What is left to compare are the pairs across a cut, about a third.
    assert seen["removed_chunks"] == 19
    assert seen["first_pairs"] < 150


def test_empty(none):
    assert remove_repeated_chunks(none).collect() == []
