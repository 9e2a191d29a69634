import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import TEXTS

from ledgerlake.llm import toxicity
from ledgerlake.llm.common import read_table
from ledgerlake.llm.toxicity import INSULT, NEGATION, NOTHING, REPORT, TARGET, THREAT


def output(*symbols):
    """Factors of insults and threats."""
    machine, state, out = toxicity.grammar(), 0, []
    for symbol in symbols:
        state, factor = machine.step(state, symbol)
        if symbol in (INSULT, THREAT):
            out.append(factor)
    return out


def test_grammar_reads_clauses_not_words():
    plain = output(INSULT)[0]
    assert output(TARGET, NOTHING, INSULT)[0] > plain
    assert output(NEGATION, INSULT)[0] < plain
    assert output(REPORT, INSULT)[0] < plain
    assert output(REPORT, TARGET, NEGATION, INSULT)[0] < output(REPORT, TARGET, INSULT)[0]
    assert output(THREAT)[0] < output(TARGET, THREAT)[0]
    assert output(INSULT, INSULT)[1] > plain


def test_composition_multiplies():
    one = toxicity.Transducer(2, {(0, INSULT): (1, 2.0)})
    two = toxicity.Transducer(2, {(0, INSULT): (1, 3.0), (1, INSULT): (1, 5.0)})
    both = one.compose(two)
    state, factor = both.step(0, INSULT)
    assert factor == 6.0
    assert both.step(state, INSULT) == (state, 5.0)


def rows(draw, count):
    """Toxic documents hold made-up insults, some with endings that others never have."""
    words = [f"plain{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    for doc in range(count):
        own = draw.choices(words, k=40)
        toxic = int(draw.random() < 0.2)
        if toxic:
            for _ in range(3):
                ending = "".join(draw.choices("abcdefgh", k=3))
                own.insert(draw.randrange(40), draw.choice(["grobbit", f"snarvel{ending}"]))
        yield doc, " ".join(own) + ".", toxic


@pytest.fixture(scope="module")
def tables(spark):
    found = list(rows(random.Random(6), 1500))
    extra = "key long, toxic int, score int, held_out int, row_key int"
    docs = spark.createDataFrame(
        [(doc, text, 1, 1, 1, 1, 1) for doc, text, _ in found], f"doc_id long, text string, {extra}"
    )
    labels = [(doc, toxic) for doc, _, toxic in found]
    return docs, spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")


def contexts(draw, count):
    """Insults that clean documents negate or report; only the clause tells them apart."""
    words = [f"plain{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    insults = ["grobbit", "snarvel", "wuzzock"]
    for doc in range(count):
        clauses = [" ".join(draw.choices(words, k=6)) for _ in range(5)]
        toxic, kind = draw.random() < 0.2, draw.random()
        insult = draw.choice(insults)
        if toxic:
            clauses.insert(draw.randrange(5), f"{draw.choice(words)} {insult}")
        elif kind < 0.03:
            clauses.insert(draw.randrange(5), f"never a {insult}")
        elif kind < 0.06:
            clauses.insert(draw.randrange(5), f"the man said {insult}")
        yield doc, ". ".join(clauses) + ".", int(toxic)


def test_composition_decides(spark, monkeypatch):
    found = list(contexts(random.Random(8), 5000))
    docs = spark.createDataFrame([x[:2] for x in found], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in found], "doc_id long, toxic int")

    def wrong(**options):
        model = toxicity.train(docs, labels, **options)
        rows = toxicity.score(docs, model).where("held_out").collect()
        return model, sum(row.predicted != found[row.doc_id][2] for row in rows), len(rows)

    model, errors, count = wrong()
    assert errors <= 0.005 * count
    learned = dict(zip(toxicity.FACTORS, model.factors))
    assert learned["insult_negated"] <= 0.3 and learned["insult_reported"] <= 0.1
    # No evidence, no change.
    for arc in ("insult_after_threat", "threat_without_target", "threat_negated"):
        assert learned[arc] == toxicity.FACTORS[arc]
    texts = ["a grobbit", "never a grobbit", "he said grobbit", "never a word. a grobbit"]
    scores = toxicity.probabilities(
        toxicity.clause_features(pa.array(texts), model), model.coefficients
    )
    assert (scores >= 0.7).tolist() == [True, False, False, True]
    # The same without a grammar: each word counts as it is.
    monkeypatch.setattr(toxicity, "CHOICES", ())
    assert wrong(factors=(1.0,) * len(toxicity.FACTORS))[1] > 0.03 * count


def test_held_out_documents(tables):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    truth = {x.doc_id: x.toxic for x in labels.where("toxic is not null").collect()}
    found = toxicity.score(docs, model).collect()
    assert len(found) == 1500
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
    held = [(row.predicted, truth[row.doc_id]) for row in found if row.held_out]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)


def test_held_out_labels_are_not_read(tables):
    docs, labels = tables
    spoiled = labels.withColumn(
        "toxic", toxicity.F.when(toxicity.held_out(), 1 - labels.toxic).otherwise(labels.toxic)
    )
    one, two = toxicity.train(docs, labels), toxicity.train(docs, spoiled)
    assert one.coefficients == two.coefficients
    assert (one.keys == two.keys).all()


def test_odd_documents(odd, tables):
    model = toxicity.train(*tables)
    found = toxicity.score(odd, model).collect()
    assert sorted(str(x.doc_id) for x in found) == sorted(str(doc) for doc, _ in TEXTS)
    assert {x.predicted for x in found} == {0}
    blank = {x.score for x in found if x.doc_id in (6, 7, 8)}
    assert len(blank) == 1
    assert toxicity.keep_clean(odd, model).count() == len(TEXTS)
    assert toxicity.keep_clean(odd, model).columns == odd.columns


def test_no_labels(odd, none, tables):
    _, labels = tables
    model = toxicity.train(odd, labels.limit(0))
    assert len(model.keys) == 0
    assert {x.predicted for x in toxicity.score(odd, model).collect()} == {0}
    assert toxicity.score(none, model).collect() == []
    assert toxicity.keep_clean(none, model).collect() == []


def test_texts_do_not_change_each_other(tables):
    model = toxicity.train(*tables)
    texts = ["you grobbit", "grobbit.", "", "not a grobbit", "plain", "grobbit"]
    together = toxicity.clause_features(pa.array(texts), model)
    alone = np.concatenate([toxicity.clause_features(pa.array([x]), model) for x in texts])
    assert np.allclose(together, alone)
    assert together[0, 0] > together[5, 0] > together[3, 0] > 0


def test_the_given_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id")
    held = found.where("held_out").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.97
    clean = held[held.toxic == 0]
    assert clean.predicted.mean() < 0.01
    assert held[held.toxic == 1].predicted.mean() > 0.85
