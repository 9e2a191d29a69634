"""Secrets in documents, told apart from copied examples by who owns them.

Method: candidates are found text by text, each with a hash of its value. Over the whole corpus
the hashes are counted by distinct repositories and distinct owners. A value that
``COPIED_OWNERS`` owners or more hold is an example that was copied; one of fewer that also looks
drawn at random is taken for a live credential. The counts also find more: a run of characters
that no pattern claims is reported as ``owned`` if few owners hold it and it either is the
value of an assignment elsewhere or looks like a key by itself.

Candidates: ``assign`` is a name such as token, a sign and a value of 12 characters or more;
``access`` an access key id of 18 or more, ``hex`` 16 or more of ``0-9a-f``, each leftmost and
not overlapping others of its kind; ``loose`` are whole runs of 12 or more of the characters
that values are made of, with a digit, that overlap none of those. The hash of an assignment is
that of its value, so that the bare value elsewhere is the same. Full stops, ``=`` and ``-`` around
a value, as in prose, are no part of it. Only hashes leave a text, never a value.

Defined results. A NULL text is empty and has no spans. Places are code points, the end
exclusive; whole texts are searched, however long. A NULL repository or owner is one of
its own. Rows that repeat, with or without a doc_id, are each reported; a value counts once for
each repository, however often it is there, so that repeated rows and ties change nothing.
An empty table gives no rows; columns that are not named play no part.

At scale: texts stay where they are read. Candidates are some bytes each; repositories and
owners of a hash are made distinct and counted map-side, and a hash that very many documents
hold is joined by a plain join, which adaptive execution splits. Only the spans of one
document are ever gathered.
"""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

#: Owners from which on a value is a copied example.
COPIED_OWNERS = 3
#: What a key that no pattern claims is like at least.
LOOSE_LENGTH, LOOSE_BITS = 20, 3.5
#: Entropy of a character, from which on a claimed value looks random.
LIVE_BITS = 3.0

# The patterns of the base kinds, in the order in which they are listed, the least
# length of what counts, and the group that does.
_VALUE = "A-Za-z0-9+/_.=-"
_ASSIGN = rf"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([{_VALUE}]+)"""
BASE = (
    ("assign", re.compile(_ASSIGN, re.ASCII), 12, 2),
    ("access", re.compile("AKIA[A-Z0-9]+"), 18, 0),
    ("hex", re.compile("[0-9a-f]+"), 16, 0),
)
# Names that an assignment needs, in small letters: texts without any are not searched for one.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Words that stand in values which are none.
_PLACEHOLDERS = (
    "example",
    "sample",
    "changeme",
    "placeholder",
    "dummy",
    "your",
    "xxxx",
    "1234567890",
)
_LOOSE = re.compile(rf"(?<![{_VALUE}])[{_VALUE}]{{12,}}+")
_LONG_HEX = re.compile("[0-9a-f]{16,}+")
_KEY = re.compile("[A-Za-z0-9_-]+")
_ORDER = {**{kind: k for k, (kind, *_) in enumerate(BASE)}, "loose": len(BASE)}


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base kinds, by start and then kind as listed."""
    found = []
    small = text.lower()
    for kind, pattern, least, group in BASE:
        if kind == "assign" and not any(x in small for x in _NAMES):
            continue
        if kind == "access" and "AKIA" not in text:
            continue
        # A run shorter than that can hold no longer one, so only hex runs may be asked for whole.
        pattern = _LONG_HEX if kind == "hex" else pattern
        for match in pattern.finditer(text):
            if len(match[group]) >= least:
                found.append((match.start(), match.end(), kind, match[group]))
    return sorted(found, key=lambda x: (x[0], _ORDER[x[2]]))


def loose_spans(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The same of runs that overlap no base span and have a digit."""
    found = []
    for match in _LOOSE.finditer(text):
        bare = _bare(match[0])
        if len(bare) < 12 or not any(x.isdigit() for x in bare):
            continue
        start = match.start() + match[0].index(bare)
        end = start + len(bare)
        if not any(start < b and a < end for a, b, _, _ in base):
            found.append((start, end, "loose", bare))
    return found


def _bare(value: str) -> str:
    return value.strip(".=-")


def bits(value: str) -> float:
    """Entropy of the value's characters."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_live(kind: str, value: str) -> bool:
    """Whether a value looks drawn at random; the bar is higher where no pattern claims it."""
    if any(x in value.lower() for x in _PLACEHOLDERS):
        return False
    if not any(x.isdigit() for x in value) or not any(x.isalpha() for x in value):
        return False
    if kind != "loose":
        return bits(value) >= LIVE_BITS
    mixed = any(x.isupper() for x in value) and any(x.islower() for x in value)
    key = len(value) >= LOOSE_LENGTH and _KEY.fullmatch(value) is not None
    return mixed and key and bits(value) >= LOOSE_BITS


def spelled(spans: Iterable[tuple[int, int, str, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


_SPAN = [
    ("start", pa.int32()),
    ("end", pa.int32()),
    ("kind", pa.string()),
    ("hash", pa.binary()),
    ("live", pa.bool_()),
]
_COUNTS = tuple(f"n_{kind}" for kind, *_ in BASE)
_FOUND = (
    "row_id long, repository string, owner string, "
    + "".join(f"{x} long, " for x in _COUNTS)
    + "base string, "
    + "spans array<struct<start: int, end: int, kind: string, hash: binary, live: boolean>>"
)


def _scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ("row_id", "repository", "owner")
    for batch in batches:
        counts, bases, spans = [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            kinds = Counter(kind for _, _, kind, _ in base)
            counts.append([kinds[kind] for kind, *_ in BASE])
            bases.append(spelled(base))
            spans.append(
                [
                    {
                        "start": start,
                        "end": end,
                        "kind": kind,
                        "hash": hashlib.blake2b(_bare(value).encode(), digest_size=16).digest(),
                        "live": looks_live(kind, value),
                    }
                    for start, end, kind, value in base + loose_spans(text, base)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(x) for x in kept),
                *(pa.array([x[k] for x in counts], pa.int64()) for k in range(len(BASE))),
                pa.array(bases, pa.string()),
                pa.array(spans, pa.list_(pa.struct(_SPAN))),
            ],
            names=[*kept, *_COUNTS, "base", "spans"],
        )


def scan(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """The spans of every text with hashes of their values, as a written table.

    ``row_id`` tells rows apart; ``doc_id`` is carried along.
    """
    rows = docs.select(
        "doc_id",
        "text",
        *(
            F.coalesce(x.cast("string"), F.lit("")).alias(name)
            for x, name in ((repository, "repository"), (owner, "owner"))
        ),
    ).withColumn("row_id", F.monotonically_increasing_id())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                (found,) = _scanned([batch])
                columns = [batch.column("doc_id"), *found.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *found.schema.names])

    return written(rows.mapInArrow(scanned, f"doc_id {kind}, {_FOUND}"), "secrets")


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners, claimed) of every value; claimed ones have a base span."""
    each = scanned.select("repository", "owner", F.explode("spans").alias("span"))
    claimed = F.max(F.col("span.kind") != "loose").alias("claimed")
    held = each.groupBy(F.col("span.hash").alias("hash"), "owner", "repository").agg(claimed)
    owners = held.groupBy("hash", "owner").agg(
        F.count("*").alias("n_repositories"), F.max("claimed").alias("claimed")
    )
    return owners.groupBy("hash").agg(
        F.sum("n_repositories").alias("n_repositories"),
        F.count("*").alias("n_owners"),
        F.max("claimed").alias("claimed"),
    )


def findings(scanned: DataFrame, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """All spans that are reported, a row each, with what the corpus says of their value.

    ``verdict`` is copied, live, or weak: held by few, but not like a value drawn at random.
    """
    known = written(ownership(scanned), "ownership")
    each = scanned.select("row_id", "doc_id", F.explode("spans").alias("span"))
    each = each.select("row_id", "doc_id", "span.*")
    copied = F.col("n_owners") >= copied_owners
    verdict = F.when(copied, "copied").when(F.col("live"), "live").otherwise("weak")
    base = F.col("kind") != "loose"
    return (
        each.join(known, "hash")
        .where(base | (~copied & (F.col("claimed") | F.col("live"))))
        .withColumn("verdict", F.when(base | F.col("live"), verdict).otherwise("live"))
        .withColumn("kind", F.when(base, F.col("kind")).otherwise("owned"))
        .select(
            "row_id",
            "doc_id",
            "kind",
            "start",
            "end",
            "hash",
            "n_repositories",
            "n_owners",
            "verdict",
        )
    )


def by_document(scanned: DataFrame, found: DataFrame) -> DataFrame:
    """Counts of base kinds and verdicts, base and all spans as text, for every document."""
    rank = F.lit(len(BASE))
    for kind, *_ in BASE:
        rank = F.when(F.col("kind") == kind, _ORDER[kind]).otherwise(rank)
    place = F.concat_ws(":", "kind", "start", "end")
    spans = F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), place.alias("place"))))
    own = found.groupBy("row_id").agg(
        F.array_join(F.transform(spans, lambda x: x["place"]), ",").alias("all"),
        *(F.count_if(F.col("verdict") == x).alias(f"n_{x}") for x in ("live", "copied", "weak")),
    )
    verdicts = ("n_live", "n_copied", "n_weak")
    documents = scanned.select("row_id", "doc_id", *_COUNTS, "base", F.size("spans").alias("any"))
    # Most documents have no span at all, and need not meet anything.
    some = documents.where("any > 0").join(own, "row_id", "left")
    rest = documents.where("any = 0").select(
        "*", F.lit("").alias("all"), *(F.lit(0).cast("long").alias(x) for x in verdicts)
    )
    return some.unionByName(rest).select(
        "doc_id",
        *_COUNTS,
        "base",
        F.coalesce("all", F.lit("")).alias("spans"),
        *(F.coalesce(x, F.lit(0)).alias(x) for x in verdicts),
    )


def owner_of(repository: Column) -> Column:
    """What stands before the first slash of a repository's name, as on hosting sites."""
    return F.substring_index(repository, "/", 1)
