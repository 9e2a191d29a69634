"""Registered queries that SQL can't express, over their whole tables, against the libraries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm.fingerprints import _hex, edited, likeness, parse, signature
from ledgerlake.llm.pieces import PIECE_BPE
from ledgerlake.llm.tokens import WORD_BPE, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    return sorted((x.doc_id, x.text or "") for x in docs.collect())


@pytest.fixture(scope="module")
def ids(texts):
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    return {doc: tokenizer.encode(x, add_special_tokens=False).ids for doc, x in texts}


def found(spark, name, *columns):
    return Counter(map(tuple, entry.queries()[name](spark, SF_DIR).select(*columns).collect()))


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_op2(spark, ids):
    start, expected = 0, Counter()
    for doc, own in ids.items():
        expected[doc, start, len(own) + 1, crc([*own, 1])] += 1
        start += len(own) + 1
    assert found(spark, "op2_token_output", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op3(spark, ids):
    rows = entry.queries()["op3_packing"](spark, SF_DIR).collect()
    expected = Counter()
    for doc, own in ids.items():
        whole = [*own, 0]
        for at in range(0, len(whole), 2048):
            piece = whole[at : at + 2048]
            expected[doc, at // 2048, at, len(piece), crc(piece)] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows) == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(x.length for x in rows) // 2048)
    assert len(sequences) <= 1.01 * least + 1


def test_op5(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    expected = Counter()
    for doc, text in texts:
        own = library.encode(text)
        decoded = hashlib.sha256(library.decode(own).encode()).hexdigest()
        expected[doc, len(own), crc(own), decoded] += 1
    columns = ("doc_id", "n_tokens", "ids_crc32", "decoded_sha256")
    assert found(spark, "op5_pieces", *columns) == expected


def test_op8(spark, texts):
    def own(text):
        return signature(text, parse(text, set()))

    expected = Counter()
    for (doc, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        changed = edited(text, following)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        marks = [own(x) for x in (text, changed, following)]
        near = [likeness(marks[0], x) for x in marks[1:]]
        expected[doc, len(text), digest, _hex(marks[0]), _hex(marks[1]), *near] += 1
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    got = found(spark, "op8_fingerprints", *columns, "near_edited", "near_next")
    assert got == expected


def test_op9(spark, texts):
    rows = entry.queries()["op9_toxicity"](spark, SF_DIR).collect()
    assert sorted(x.doc_id for x in rows) == [doc for doc, _ in texts]
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)


def test_pipeline(spark, texts):
    rows = entry.queries()["pipeline"](spark, SF_DIR).collect()
    kept = {x.doc_id for x in rows}
    assert rows and kept < {doc for doc, _ in texts}
    for doc in kept:
        pieces = sorted((x.piece, x.start, x.length) for x in rows if x.doc_id == doc)
        assert [x[:2] for x in pieces] == [(k, 2048 * k) for k in range(len(pieces))]
        assert all(x[2] == 2048 for x in pieces[:-1])
