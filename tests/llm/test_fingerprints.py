import hashlib
import random
from collections import Counter

import pytest
from brute import TEXTS, odd_documents

from ledgerlake.llm.fingerprints import (
    _hex,
    edited,
    fingerprints,
    likeness,
    neighbours,
    parse,
    signature,
    text_and_edited,
)


def own(text):
    return signature(text, parse(text, set()))


def expected(rows):
    order = sorted(
        ((doc, text or "") for doc, text in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])
    )
    out = Counter()
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        changed = edited(text, following)
        out[
            doc,
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            _hex(own(text)),
            _hex(own(changed)),
            likeness(own(text), own(changed)),
            likeness(own(text), own(following)),
        ] += 1
    return out


def got(frame):
    return Counter(map(tuple, frame.collect()))


def test_odd_documents(odd):
    assert got(fingerprints(odd)) == expected(TEXTS)


@pytest.mark.parametrize("count", [1, 2, 300])
def test_next_documents_across_ranges(spark, count):
    draw = random.Random(count)
    ids = draw.sample(range(-(10**12), 10**12), count)
    rows = [(k, "".join(draw.choices("abc ", k=draw.randrange(30)))) for k in ids]
    assert got(fingerprints(odd_documents(spark, rows))) == expected(rows)


@pytest.mark.parametrize("ids", [[7], [None], [None, 1, 1, 2], range(200)])
def test_many_ranges_and_rows_of_one_doc_id(spark, monkeypatch, ids):
    monkeypatch.setattr("ledgerlake.llm.fingerprints.RANGE_BYTES", 500)
    draw = random.Random(3)
    rows = [(draw.choice(ids), "".join(draw.choices("abc ", k=40))) for _ in range(300)]
    rows += rows[:20]
    docs = odd_documents(spark, rows)
    assert got(fingerprints(docs)) == expected(rows)
    ranges = neighbours(docs)[0].where("not extra").groupBy("range").count().collect()
    assert len(ranges) > 15
    assert max(x["count"] for x in ranges) < 60


def test_empty(none):
    assert fingerprints(none).collect() == []


def test_phrases_are_those_of_lz78():
    text = "aababcabcd"
    ends = parse(text, set())
    assert [text[a:b] for a, b in zip([0, *ends], ends)] == ["a", "ab", "abc", "abcd"]


def test_edited_replaces_the_last_half():
    assert edited("abcde", "XYZ") == "abcXY"
    assert edited("abcdef", "X") == "abcX"
    assert edited("a", "X") == "a"


def test_shared_beginnings_are_parsed_alike():
    draw = random.Random(1)
    for _ in range(200):
        one, two = ("".join(draw.choices("ab", k=draw.randrange(40))) for _ in range(2))
        mine, changed, changed_own = text_and_edited(one, two)
        assert (mine == own(one)).all()
        assert changed == edited(one, two)
        assert (changed_own == own(changed)).all()


def test_likeness_follows_what_is_shared():
    draw = random.Random(2)
    words = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    base = " ".join(words[:1000])
    scores = [
        likeness(own(base), own(" ".join(words[: 1000 - n] + words[2000 : 2000 + n])))
        for n in (0, 100, 300, 600, 1000)
    ]
    assert scores[0] == 1.0
    assert scores == sorted(scores, reverse=True)
