import hashlib
import math
import random
from collections import Counter
from functools import cache

import numpy as np
import pytest
import sentencepiece
from brute import TEXTS

from ledgerlake.llm.pieces import PIECE_BPE, PieceCoder, decode_ids, encode_texts
from ledgerlake.llm.tokens import vocabulary

MODEL = vocabulary(PIECE_BPE)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as model:
        return PieceCoder(model.read())


def texts():
    draw = random.Random(2)
    letters = "abcdetnio ▁\n.é,!'①"
    yield from ("", " ", "\n", "  a  b\n c", "<s> </s> <0x0A>", "x" * 300, "日本語①\t\r\n")
    yield from (text or "" for _, text in TEXTS)
    for _ in range(300):
        yield "".join(draw.choices(letters, k=draw.randrange(1, 150)))


def test_ids_are_the_library_s(coder, library):
    for text in texts():
        assert coder.encode(text) == library.encode(text)


def test_decoding_restores(coder, library):
    for text in texts():
        ids = coder.encode(text)
        assert coder.decode(ids) == library.decode(ids) == text.replace("▁", " ")


def test_long_text_without_a_break_keeps_a_small_window(coder, library):
    text = "abcd" * 20_000
    found, most = [], 0
    search = coder.search("▁" + text)
    for token in search:
        found.append(token)
        most = max(most, len(search.gi_frame.f_locals["tokens"]))
    assert found == library.encode(text)
    assert most < 200


def test_unigram_takes_the_largest_sum():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as model:
        proto.ParseFromString(model.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    coder = PieceCoder(proto.SerializeToString())
    scores = {x.piece: x.score for x in proto.pieces[259:]}

    def best(text):
        @cache
        def upto(end):
            if not end:
                return 0.0
            return max(
                (
                    upto(start) + scores[text[start:end]]
                    for start in range(max(0, end - 16), end)
                    if text[start:end] in scores
                ),
                default=-math.inf,
            )

        return upto(len(text))

    for text in ("▁hello▁world", "▁internationalization", "▁thethethe", "▁abababab▁x"):
        tokens = list(coder.search(text))
        assert "".join(proto.pieces[x].piece for x in tokens) == text
        assert sum(proto.pieces[x].score for x in tokens) == best(text)


def test_documents(odd, library):
    expected = Counter()
    for doc, text in TEXTS:
        ids = library.encode(text or "")
        plain = (text or "").replace("▁", " ")
        expected[doc, len(ids), hashlib.sha256(plain.encode()).hexdigest()] += 1
    encoded = encode_texts(odd, MODEL)
    found = decode_ids(encoded, MODEL).collect()
    assert expected == Counter(
        (x.doc_id, x.n_tokens, hashlib.sha256(x.text.encode()).hexdigest()) for x in found
    )
    raw = {x.doc_id: x.ids for x in encoded.collect()}
    assert np.frombuffer(raw[1], "<u4").tolist() == library.encode(TEXTS[0][1])


def test_empty(none):
    assert decode_ids(encode_texts(none, MODEL), MODEL).collect() == []
