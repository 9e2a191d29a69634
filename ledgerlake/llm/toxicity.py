"""Toxicity by a weighted finite-state grammar over clauses.

A text's words, lower-cased, become symbols: insult, threat, target, negation, report, or
nothing. Five small transducers, one for each kind, read a clause's symbols and put out
factors; their composition is one transducer, whose output for an insult or a threat is
the word's weight times what the clause says around it, such as a target, a negation or reported
speech. A clause scores the sum, and a document's clause scores become a probability by a
logistic model.

Threats, targets, negations and verbs of saying are short lists. Insults, as words and as
beginnings of words, are learned from a bounded sample of labelled rows, by the lower
confidence bound of their log odds, each different text counted once. The factors of the
transducers' arcs and the logistic model are fitted to one half of the sample with the insults
of the other, as they will meet texts that they were not learned from: starting from
``FACTORS``, the one change of a factor to one of ``CHOICES`` that makes the labels likeliest
is taken, as long as it gains ``LEAST_GAIN``, ``MOST_CHANGES`` times at most. Labels are only read where crc32(doc_id) mod 3 is not 1; language,
source and doc_id are no inputs of a score.

NULL and empty texts score as texts without a match. Without labels of both kinds there
are no learned insults and the model has fixed weights. Labels of a document that differ count
as toxic, NULL ones not at all. Repeated rows score alike. Other columns play no part.
An empty table gives no rows.
"""

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import steps, text_bytes, written
from ledgerlake.llm.words import mixed, span_hashes, word_spans

#: Labelled rows that are learned from, picked by a hash of doc_id.
TRAIN_ROWS = 20_000
#: Learned beginnings and words: documents they must be seen in, least weight, most of them.
LEAST_SEEN, LEAST_WEIGHT, MOST_WORDS = 5, 2.0, 5000
PREFIXES = (4, 5, 6, 7, 8, 9)
REJECT = 0.7

NOTHING, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# English, German, French and Spanish.
WORDS = {
    THREAT: "kill murder destroy strangle umbringen töten zerstören tuer détruire matar destruir",
    TARGET: "you your you're he she they this these those du dich dein ihr sie dieser diese tu vous "
    "toi ton ce cette tú usted ustedes ese esa este esta",
    NEGATION: "not never no isn't aren't don't nicht nie kein keine ne pas jamais nunca tampoco",
    REPORT: "said says say called quoted claimed sagte sagt nannte dit disait appelé dijo dice llamó",
}
THREAT_WEIGHT = 2.0

#: Factors of the arcs, to begin with.
FACTORS = {
    "insult_again": 1.2,
    "insult_after_threat": 1.2,
    "threat_without_target": 0.2,
    "insult_at_target": 1.3,
    "insult_negated": 0.3,
    "threat_negated": 0.2,
    "insult_reported": 0.5,
    "threat_reported": 0.5,
}
#: What a factor can become, the log likelihood that a change must gain, and how many are made.
CHOICES = (0.0, 0.1, 0.3, 1.0, 3.0)
LEAST_GAIN, MOST_CHANGES = 3.0, 4


class Transducer:
    """``moves[state, symbol]`` is the next state and the factor put out; state 0 is the first.

    What is not listed stays in its state with factor one.
    """

    def __init__(self, states: int, moves: Mapping[tuple[int, int], tuple[int, float]]):
        self.states = states
        self._moves = moves

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self._moves.get((state, symbol), (state, 1.0))

    def compose(self, other: "Transducer") -> "Transducer":
        """Both side by side: states are pairs, factors multiply."""
        moves = {}
        for a, b, symbol in product(range(self.states), range(other.states), range(6)):
            (to_a, x), (to_b, y) = self.step(a, symbol), other.step(b, symbol)
            moves[a * other.states + b, symbol] = (to_a * other.states + to_b, x * y)
        return Transducer(self.states * other.states, moves)


@lru_cache(256)
def grammar(factors: tuple[float, ...] = tuple(FACTORS.values())) -> Transducer:
    """The composition of the five kinds, with the factors of their arcs."""
    again, after, untargeted, targeted, negated, no_threat, reported, told_threat = factors
    insult = Transducer(2, {(0, INSULT): (1, 1.0), (1, INSULT): (1, again)})
    threat = Transducer(2, {(0, THREAT): (1, 1.0), (1, INSULT): (1, after)})
    target = Transducer(
        2, {(0, TARGET): (1, 1.0), (0, THREAT): (0, untargeted), (1, INSULT): (1, targeted)}
    )
    negation = Transducer(
        2, {(0, NEGATION): (1, 1.0), (1, INSULT): (0, negated), (1, THREAT): (0, no_threat)}
    )
    report = Transducer(
        2, {(0, REPORT): (1, 1.0), (1, INSULT): (1, reported), (1, THREAT): (1, told_threat)}
    )
    return reduce(Transducer.compose, (insult, threat, target, negation, report))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100), 0x27]] = True
_CLAUSE = np.zeros(256, bool)
_CLAUSE[[ord(x) for x in "\n.,;:!?()|\""]] = True


@dataclass
class _Words:
    """Words of many texts: keys of their beginnings and themselves, clause and text of each."""

    keys: np.ndarray  # words x (prefixes + 1); 0 where a word is shorter than the prefix
    clause: np.ndarray
    text: np.ndarray


def _words(texts: pa.Array) -> _Words:
    lowered = pc.utf8_lower(texts.cast(pa.large_string()))
    data, offsets = text_bytes(lowered)
    starts, ends, before = word_spans(data, offsets, gap=~_LETTER)
    text = np.repeat(np.arange(len(texts)), np.diff(before))
    keys = np.zeros((len(starts), len(PREFIXES) + 1), np.uint64)
    for k, size in enumerate(PREFIXES):
        long = np.flatnonzero(ends - starts > size)
        hashes = span_hashes(data, starts[long], starts[long] + size)
        keys[long, k] = mixed(hashes + np.uint64(1))
    keys[:, -1] = span_hashes(data, starts, ends)
    breaks = _CLAUSE[data]
    inner = offsets[1:-1]
    breaks[inner[inner < len(data)]] = True
    return _Words(keys, np.cumsum(breaks)[starts] if len(data) else starts, text)


def _listed(kind: int) -> np.ndarray:
    words = pa.array(WORDS[kind].split(), pa.large_string())
    data, offsets = text_bytes(words)
    return span_hashes(data, offsets[:-1], offsets[1:])


@dataclass(frozen=True)
class Model:
    """Keys of insults, ascending, their weights, the logistic model, and the arcs' factors."""

    keys: np.ndarray
    weights: np.ndarray
    coefficients: tuple[float, ...] = (-3.0, 0.5, 0.5, 0.5, 2.0)
    factors: tuple[float, ...] = tuple(FACTORS.values())


@dataclass(frozen=True)
class _Symbols:
    """What the grammar reads of many texts: text, clause, symbol, weight; and each text's words."""

    rows: list[tuple[int, int, int, float]]
    words: np.ndarray


def _symbols(texts: pa.Array, model: Model) -> _Symbols:
    """The symbols of all clauses with an insult or a threat."""
    words = _words(texts)
    weight = np.zeros(len(words.text))
    if len(model.keys):
        for k in range(words.keys.shape[1]):
            at = np.minimum(np.searchsorted(model.keys, words.keys[:, k]), len(model.keys) - 1)
            hit = model.keys[at] == words.keys[:, k]
            weight = np.maximum(weight, np.where(hit, model.weights[at], 0))
    symbol = np.where(weight > 0, INSULT, NOTHING)
    for kind in WORDS:
        listed = np.isin(words.keys[:, -1], _listed(kind)) & (symbol == NOTHING)
        symbol[listed] = kind
    weight[symbol == THREAT] = THREAT_WEIGHT
    matched = np.unique(words.clause[(symbol == INSULT) | (symbol == THREAT)])
    read = np.flatnonzero(np.isin(words.clause, matched) & (symbol != NOTHING))
    rows = zip(*(x[read].tolist() for x in (words.text, words.clause, symbol, weight)))
    return _Symbols(list(rows), np.bincount(words.text, minlength=len(texts)))


def _features(symbols: _Symbols, factors: tuple[float, ...]) -> np.ndarray:
    out = np.zeros((len(symbols.words), 4))
    machine, state, last = grammar(factors), 0, -1
    scores: dict[tuple[int, int], float] = {}
    for text, clause, kind, own in symbols.rows:
        if clause != last:
            state, last = 0, clause
        state, factor = machine.step(state, kind)
        if kind in (INSULT, THREAT):
            scores[text, clause] = scores.get((text, clause), 0.0) + own * factor
    sums = np.zeros(len(out))
    for (text, _), score in scores.items():
        out[text, 0] = max(out[text, 0], score)
        out[text, 2] += score > 0
        sums[text] += score
    out[:, 3] = np.minimum(1, 20 * out[:, 2] / np.maximum(symbols.words, 1))
    out[:, 1], out[:, 2] = np.log1p(sums), np.log1p(out[:, 2])
    return out


def clause_features(texts: pa.Array, model: Model) -> np.ndarray:
    """Of each text: largest clause score, log of their sum, log of the matched, their share.

    A clause that scores nothing is not matched.
    """
    return _features(_symbols(texts, model), model.factors)


def probabilities(features: np.ndarray, coefficients: tuple[float, ...]) -> np.ndarray:
    line = coefficients[0] + features @ np.array(coefficients[1:])
    return 1 / (1 + np.exp(-np.clip(line, -30, 30)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Coefficients by Newton's method, the intercept first."""
    x = np.column_stack([np.ones(len(features)), features])
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        change = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ beta
        )
        beta += change
        if np.abs(change).max() < 1e-8:
            break
    return tuple(beta.tolist())


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels are never read; NULL doc_ids have no label."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 3 == 1, F.lit(False))


def _seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of either label each beginning and each word occurs."""
    for step in steps(batches, "text", 8 << 20):
        words = _words(step.column("text"))
        toxic = step.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        row = np.repeat(words.text, words.keys.shape[1])
        keys = words.keys.ravel()
        row, keys = row[keys != 0], keys[keys != 0]
        order = np.lexsort((row, keys))
        row, keys = row[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
        row, keys = row[new], keys[new]
        found, at = np.unique(keys, return_inverse=True)
        bad = np.bincount(at, weights=toxic[row], minlength=len(found)).astype(np.int64)
        all_ = np.bincount(at, minlength=len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(bad), pa.array(all_ - bad)],
            names=["key", "toxic", "clean"],
        )


def _lexicon(known: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and weights of what tells toxic texts from clean ones."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(a / (toxic + 1)) - F.log(b / (clean + 1)) - 1.5 * F.sqrt(1 / a + 1 / b)
    learned = (
        known.mapInArrow(_seen, "key long, toxic long, clean long")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_SEEN)
        .select("key", weight.alias("weight"))
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("weight"), "key")
        .limit(MOST_WORDS)
        .toPandas()
    )
    keys = learned["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], learned["weight"].to_numpy(np.float64)[order]


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = TRAIN_ROWS,
    factors: tuple[float, ...] = tuple(FACTORS.values()),
) -> Model:
    """Learn from at most ``rows`` labelled documents, starting with the arcs' ``factors``.

    See the module's text.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    known = written(
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")  # at most `rows` pairs of numbers
        .where("text is not null")
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))),
        "labelled",
    )
    counts = known.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()
    n = {(x.half, bool(x.toxic)): x.n for x in counts}
    first = [n.get((0, kind), 0) for kind in (True, False)]
    both = [x + n.get((1, kind), 0) for x, kind in zip(first, (True, False))]
    if not all(both):
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    final = Model(*_lexicon(known.drop("half"), *both), factors=factors)
    if not all(first):
        return final
    model = Model(*_lexicon(known.where("half = 0").drop("half"), *first), factors=factors)
    second = known.where("half = 1").drop("half")

    coefficients, factors = _fitted(second, model)
    return Model(final.keys, final.weights, coefficients, factors)


def _changes(factors: tuple[float, ...]) -> list[tuple[float, ...]]:
    """The factors as they are, and with each single one changed."""
    changed = [
        (*factors[:arc], value, *factors[arc + 1 :])
        for arc in range(len(factors))
        for value in CHOICES
        if value != factors[arc]
    ]
    return [factors, *changed]


def _fitted(known: DataFrame, model: Model) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """The logistic model and the arcs' factors that make the labels of ``known`` likeliest.

    Features are found by tasks; the driver gets four numbers a row and candidate.
    """
    factors = model.factors
    for left in range(MOST_CHANGES, -1, -1):
        candidates = _changes(factors) if left else [factors]

        def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for step in steps(batches, "text"):
                symbols = _symbols(step.column("text"), model)
                found = np.hstack([_features(symbols, x) for x in candidates])
                yield pa.RecordBatch.from_arrays(
                    [step.column("toxic").cast(pa.int32()), pa.array(list(found))],
                    names=["toxic", "features"],
                )

        table = known.mapInArrow(features, "toxic int, features array<double>").toArrow()
        labels = table["toxic"].to_numpy()
        if len(np.unique(labels)) < 2:
            return model.coefficients, factors
        values = table["features"].combine_chunks().flatten().to_numpy()
        values = values.reshape(len(labels), len(candidates), 4)
        fits = [fit_logistic(values[:, k], labels) for k in range(len(candidates))]
        gains = [_log_likelihood(values[:, k], labels, fit) for k, fit in enumerate(fits)]
        best = int(np.argmax(gains))
        if gains[best] < gains[0] + LEAST_GAIN:
            break
        factors = candidates[best]
    return fits[0], factors


def _log_likelihood(
    features: np.ndarray, labels: np.ndarray, coefficients: tuple[float, ...], ridge: float = 1.0
) -> float:
    """Of labels under a model, less the penalty under which it is fitted."""
    p = np.where(labels == 1, 1, -1) * (coefficients[0] + features @ np.array(coefficients[1:]))
    return float(-np.logaddexp(0, -p).sum() - ridge / 2 * np.square(coefficients[1:]).sum())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row_key, doc_id, held_out, score, predicted) of each row.

    ``row_key`` is ``xxhash64(doc_id, text)``.
    """

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            found = probabilities(clause_features(step.column("text"), model), model.coefficients)
            yield pa.RecordBatch.from_arrays(
                [step.column("row_key"), step.column("doc_id").cast(pa.int64()), pa.array(found)],
                names=["row_key", "doc_id", "score"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    return rows.mapInArrow(scored, "row_key long, doc_id long, score double").select(
        "row_key",
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    Texts are scored where they are, so nothing is joined.
    """

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            own = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            found = [
                probabilities(clause_features(step.column("text"), model), model.coefficients)
                for step in steps([own], "text")
            ]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) < REJECT))

    return docs.mapInArrow(clean, docs.schema)
