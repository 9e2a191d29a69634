"""Each stage against its plain version on what the stage before it has kept."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import groups, repeated_words, shingles, without_runs
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import toxicity
from ledgerlake.llm.tokens import WORD_BPE, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(draw):
    words = [f"plain{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    passage = " ".join(draw.choices(words, k=60))
    block = "\n".join(" ".join(draw.choices(words, k=6)) for _ in range(12))
    story = draw.choices(words, k=120)
    texts = [" ".join(draw.choices(words, k=draw.randrange(5, 90))) for _ in range(700)]
    for k in range(0, 700, 4):
        texts[k] = texts[k].replace(" ", " you grobbit ", 3)
    for k in range(1, 60, 2):
        texts[k] = f"{texts[k]} {passage} {texts[k + 2]}"
    for k in range(101, 160, 2):
        texts[k] = f"{texts[k]}\n{block}\n{texts[k + 1][:9]}"
    for k in range(201, 260, 2):
        own = list(story)
        own[draw.randrange(120)] = f"odd{k}"
        texts[k] = " ".join(own)
    rows = [(k, text, "en", "s", len(text)) for k, text in enumerate(texts)]
    rows += [(700, None, None, None, None), (701, "", "en", "s", 0), (702, "x " * 4000, "en", "s", 0)]
    rows += [rows[3], (None, "no id at all", "en", "s", 12), (703, "same", "a", "s", 1)]
    labels = [(k, int(k % 4 == 0)) for k in range(700)]
    return rows, labels


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = documents(random.Random(11))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What comes out of each stage, the documents first."""
    path = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(path / name))
        docs = spark.read.parquet(str(path / name))
        out.append(docs)
    return out


def texts(frame):
    return [(x.doc_id, x.text) for x in frame.collect()]


def order(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


def test_stages_keep_the_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go_and_clean_ones_stay(spark, sf_dir, stages):
    docs = stages[0]
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = toxicity.score(docs, model).where("predicted = 0").collect()
    assert Counter(x.doc_id for x in kept) == Counter(doc for doc, _ in texts(stages[1]))
    left = {doc for doc, _ in texts(stages[1])}
    assert all(k in left for k in range(700) if k % 4)
    assert sum(k in left for k in range(0, 700, 4)) < 9


def test_lines(stages):
    rows = texts(stages[1])
    expected = Counter()
    for (doc_id, kept, _, _), n in without_runs(rows).items():
        expected[doc_id, kept] += n
    assert Counter(texts(stages[2])) == expected
    for row in stages[2].collect():
        assert row.n_chars == (None if row.text is None else len(row.text))


def test_one_of_each_group_stays(stages):
    rows = sorted(set(texts(stages[2])), key=order)
    sets = [shingles(text) for _, text in rows]
    roots = groups(sets)
    expected = Counter(
        row for k, row in enumerate(rows) if roots[k] == k
    )
    assert Counter(texts(stages[3])) == expected


def test_passages(stages):
    rows = texts(stages[3])
    expected = Counter()
    for (doc, text), (words, kept) in zip(rows, repeated_words([x for _, x in rows], 35)):
        expected[doc, text if len(words) == len(kept) else " ".join(kept)] += 1
    assert Counter(texts(stages[4])) == expected


def test_packing(stages):
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    expected = Counter()
    for doc, text in texts(stages[4]):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            expected[doc, at // 2048, zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    found = Counter((x.doc_id, x.piece, x.ids_crc32) for x in stages[5].collect())
    assert found == expected


def test_run_is_the_stages_in_turn(spark, sf_dir, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert Counter(found) == Counter(stages[5].select(*columns).collect())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_of_no_documents(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    assert found.collect() == []
    if name != "packing":
        assert found.columns == docs.columns
