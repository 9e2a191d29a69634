import numpy as np
import pyarrow as pa
from brute import TEXTS, WORD

from ledgerlake.llm.common import steps, text_bytes
from ledgerlake.llm.words import gram_hashes, span_hashes, word_spans


def test_words_of_texts_side_by_side():
    texts = [text or "" for _, text in TEXTS] + ["ends", "begins", " ", "", "a\x0bb\x0cc\x85d"]
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    starts, ends, before = word_spans(data, offsets)
    raw = data.tobytes()
    for text, a, b in zip(texts, before[:-1], before[1:]):
        found = [raw[x:y].decode() for x, y in zip(starts[a:b], ends[a:b])]
        assert found == WORD.findall(text)


def test_hashes_depend_on_the_bytes_alone():
    texts = pa.array(["same other", "x same", "SAME same"], pa.large_string())
    data, offsets = text_bytes(texts)
    starts, ends, _ = word_spans(data, offsets)
    same, other, x, again, upper, last = span_hashes(data, starts, ends).tolist()
    assert same == again == last
    assert len({same, other, x, upper}) == 4
    lowered = span_hashes(data, starts, ends, lower=True)
    assert lowered[4] == lowered[0] == same


def test_grams_are_ordered():
    hashes = np.array([1, 2, 3, 2, 1], np.uint64)
    grams = gram_hashes(hashes, 2).tolist()
    assert len(set(grams)) == 4
    assert len(gram_hashes(hashes, 6)) == 0


def test_steps_hold_every_row_once():
    texts = ["x" * n for n in (5, 0, 50, 3, 3, 100, 1)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": list(range(8))})
    for most in (1, 10, 1000):
        found = list(steps(iter([batch, batch.slice(0, 0)]), "text", most))
        assert [n for x in found for n in x.column("n").to_pylist()] == list(range(8))
        assert [t for x in found for t in x.column("text").to_pylist()] == [*texts[:-1], ""]
