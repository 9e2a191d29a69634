"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

Words are lower-cased (A-Z only) runs of bytes other than white space; a document's set
holds its distinct shingles of ``SHINGLE`` words, or its whole sequence of words if that
is shorter. Two documents are linked when their sets have a similarity (intersection over
union) of at least ``PERCENT`` in a hundred, compared in whole numbers on the full sets.

1. Documents with equal sets are one class; only classes are compared.
2. A class's signature has ``REGISTERS`` registers. Every shingle deals out its ranks by
   a permutation of the registers of its own, one rank a round, and a document is done
   as soon as no later rank can be the smallest anywhere.
3. ``BANDS`` bands of the signature are buckets: at a similarity of 0.75 two classes miss
   each other in all of them once in 190,000 times, above it less often.
4. Every class is compared with one centre of the buckets it is in. Rounds with other
   centres follow for buckets that still span several components. What these leave meets by
   an exact prefix filter on the sets themselves (:func:`_meeting`), and what meets is compared
   in blocks. So the linked part of a large group costs about one comparison for each member,
   no link between its components is lost, and pages that share a template are not compared.
5. Links make components (see :mod:`ledgerlake.llm.components`).

Results by row: NULL and blank texts have an empty set, are linked with nothing and stay.
Rows that repeat a doc_id are told apart by their text. A NULL doc_id counts as larger than
every other. Other columns of the input play no part. An empty table gives no rows; very
long texts are compared whole; among ties the smallest doc_id names a group.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW_KEY, row_key, steps, text_bytes, written
from ledgerlake.llm.components import Forest, components
from ledgerlake.llm.words import gram_hashes, mixed, span_hashes, word_spans

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
BANDS = 32
STAR_ROUNDS = 2
_ALL = (1 << 64) - 1
#: Signatures of equal registers below this part rule a pair out in blocks: more than six
#: deviations under 0.75, so one linked pair in some 10**10 that meets by nothing else.
LEAST_EQUAL = 0.5
#: Members compared with one copy of their centre, and classes on either side of a block.
BLOCK = 256


def shingle_sets(texts: pa.LargeStringArray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, lower=True)
    grams = gram_hashes(words, size)
    sets = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        else:
            sets.append(gram_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash of each set, 16 bits a register; rows of empty sets mean nothing.

    In round j a shingle's rank is j plus a fraction, at the j-th register of its
    permutation. The smallest rank of each register stays, so a set whose registers are
    all below j + 1 takes no part in later rounds.
    """
    count = len(sets)
    best = np.full(count * registers, ~np.uint64(0))
    row = np.repeat(np.arange(count), [len(x) for x in sets])
    seed = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = None
    for j in range(registers):
        if not len(seed):
            break
        draw = mixed(seed + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & _ALL))
        fraction = mixed(draw ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(8)
        swap = j + (draw % np.uint64(registers - j)).astype(np.int64)
        if j == 0:
            at = swap
        else:
            own = np.arange(len(seed))
            at = order[own, swap]
            order[own, swap] = order[:, j]
        np.minimum.at(best, row * registers + at, (np.uint64(j) << np.uint64(56)) | fraction)
        worst = best.reshape(count, registers).max(axis=1)
        going = (worst >= np.uint64(j + 1) << np.uint64(56))[row]
        if j == 0:
            order = np.tile(np.arange(registers, dtype=np.uint8), (int(going.sum()), 1))
            order[np.arange(len(order)), swap[going]] = 0
        else:
            order = order[going]
        seed, row = seed[going], row[going]
    return (mixed(best) >> np.uint64(48)).astype(np.uint16).reshape(count, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for k in range(parts.shape[2]):
        keys = mixed(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k])
    return keys


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are similar enough."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large) or not len(small):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "text"):
        sets = shingle_sets(step.column("text"))
        digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
        rows = signatures(sets)
        yield pa.RecordBatch.from_arrays(
            [
                step.column("row_key"),
                step.column("doc_id").cast(pa.int64()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([x.tobytes() for x in rows], pa.binary()),
            ],
            names=["row_key", "doc_id", "n_shingles", "class", "signature"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", row_key())


def _banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
        keys = band_keys(signature.reshape(-1, REGISTERS))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.ravel().view(np.int64)),
                pa.array(np.repeat(batch.column("node").to_numpy(), keys.shape[1])),
            ],
            names=["band", "node"],
        )


def _confirmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of members with their centre, whose row comes before theirs."""
    centre, own = None, np.zeros(0, np.uint64)
    for step in steps(batches, "text"):
        sets = shingle_sets(step.column("text"))
        wanted = step.column("class").to_pylist()
        found = []
        columns = [step.column(x).to_pylist() for x in ("centre", "part", "member")]
        for key, part, member, shingles, name in zip(*columns, sets, wanted):
            if xxhash.xxh3_128_digest(shingles.tobytes()) != name:
                continue  # another row with the same 64-bit key
            if member is None:
                centre, own = (key, part), shingles
            elif centre == (key, part) and linked(own, shingles):
                found.append((key, member))
        if found:
            columns = [pa.array(x, pa.int64()) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (centre, member) that are linked by their full sets.

    Members of a centre are dealt over parts of about ``BLOCK``, each with its own copy of
    the centre, so a centre of a third of all classes is no task's burden.
    """
    sizes = pairs.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    sizes = written(sizes, "centres")
    member = pairs.join(sizes, "centre").select(
        "centre",
        F.expr("pmod(xxhash64(member, 1), parts)").alias("part"),
        "member",
        F.col("member").alias("node"),
    )
    centre = sizes.select(
        "centre",
        F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"),
        F.lit(None).cast("long").alias("member"),
        F.col("centre").alias("node"),
    )
    rows = member.union(centre).join(texts, "node")
    return (
        rows.select("centre", "part", "member", "class", "text")
        .repartition("centre", "part")
        .sortWithinPartitions("centre", "part", F.col("member").asc_nulls_first())
        .mapInArrow(_confirmed, "a long, b long")
    )


def _shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of open classes."""
    for step in steps(batches, "text"):
        sets = shingle_sets(step.column("text"))
        names = step.column("class").to_pylist()
        own = [k for k, x in enumerate(sets) if xxhash.xxh3_128_digest(x.tobytes()) == names[k]]
        ends = np.cumsum([0, *(len(sets[k]) for k in own)])
        flat = np.concatenate([sets[k] for k in own]) if own else np.zeros(0, np.uint64)
        rows = step.take(pa.array(own, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("node"),
                rows.column("root"),
                pa.array(np.diff(ends), pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64))),
            ],
            names=["node", "root", "n", "shingles"],
        )


class _Block:
    """Classes that others are compared with: their sets and signatures."""

    def __init__(self):
        self.nodes: list[int] = []
        self.roots: list[int] = []
        self.sets: list[np.ndarray] = []
        self.signatures: list[np.ndarray] = []

    def add(self, node: int, root: int, shingles: np.ndarray, signature: bytes) -> None:
        self.nodes.append(node)
        self.roots.append(root)
        self.sets.append(shingles)
        self.signatures.append(np.frombuffer(signature, np.uint16))

    def links(self, other: "_Block", forest: Forest) -> Iterator[tuple[int, int]]:
        """Links to the other's classes that join what ``forest`` has not joined yet.

        Only pairs whose signatures do not rule them out are compared by their sets.
        """
        if not self.nodes or not other.nodes:
            return
        mine, theirs = np.stack(self.signatures), np.stack(other.signatures)
        for k in range(0, len(mine), 64):
            equal = (mine[k : k + 64, None, :] == theirs[None]).mean(axis=2)
            for i, j in zip(*(x.tolist() for x in np.nonzero(equal >= LEAST_EQUAL))):
                a, b = self.roots[k + i], other.roots[j]
                if forest.root(a) != forest.root(b) and linked(self.sets[k + i], other.sets[j]):
                    forest.join(a, b)
                    yield self.nodes[k + i], other.nodes[j]


def _linked_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the components of a block; its left side comes before its right."""
    key, left, forest = None, _Block(), Forest()
    names = ("cluster", "i", "j", "right", "node", "root", "signature", "class")
    for step in steps(batches, "text"):
        found: list[tuple[int, int]] = []
        right = _Block()
        sets = shingle_sets(step.column("text"))
        columns = [step.column(x).to_pylist() for x in names]
        for cluster, i, j, is_right, node, root, signature, name, shingles in zip(*columns, sets):
            if xxhash.xxh3_128_digest(shingles.tobytes()) != name:
                continue  # another row with the same 64-bit key
            if key != (cluster, i, j):
                found += left.links(right, forest)
                key, left, right, forest = (cluster, i, j), _Block(), _Block(), Forest()
            (right if is_right else left).add(node, root, shingles, signature)
        found += left.links(right, forest)
        if found:
            columns = [pa.array(x, pa.int64()) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (band, node, root) of the buckets that span several components."""
    rooted = members.join(roots, "node", "left").select(
        "band", "node", F.coalesce("root", "node").alias("root")
    )
    spanning = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    return rooted.join(written(spanning.where("lo < hi").select("band"), "spanning"), "band")


def _meeting(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(band, node, root) of open classes where a linked one of another component may be.

    An exact prefix filter. Every set has its shingles in one order, the rarest among the open
    classes first. Two sets of sizes m <= n that are linked share at least 3/7 (m + n) shingles,
    which is no less than 6/7 m and 3/4 n. So one of the shingles they share is among the first
    ``m - 6/7 m + 1`` of the smaller and the first ``n - 3/4 n + 1`` of the larger. Groups by
    such a shingle, which take the place of bands, need a set of the first kind, and several
    components. Pages of one template share what is frequent, and so last in that order: they
    meet nowhere. Numbers travel, no texts.
    """
    nodes = members.select("node", "root").distinct()
    opened = texts.join(nodes, "node").mapInArrow(
        _shingled, "node long, root long, n long, shingles array<long>"
    )
    opened = written(opened, "open_sets")
    each = opened.select("node", "root", "n", F.explode("shingles").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    shared = written(shared, "shared_shingles")
    # Shingles that no other set has come first; only their number matters.
    ordered = each.join(shared, "shingle").groupBy("node", "root", "n")
    ordered = ordered.agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("own"))
    probing = F.expr(f"n - (n * {PERCENT} + 99) div 100 + 1")
    length = F.greatest(probing - F.col("n") + F.size("own"), F.lit(0)).cast("int")
    prefix = F.slice("own", 1, length)
    entries = ordered.select(
        "node", "root", "n", F.size("own").alias("m"), F.posexplode(prefix).alias("at", "x")
    )
    parts = 2 * PERCENT, 100 + PERCENT
    indexed = F.expr(f"n - m + at < n - (n * {parts[0]} + {parts[1] - 1}) div {parts[1]} + 1")
    entries = entries.select(
        "node", "root", indexed.alias("indexed"), F.col("x.shingle").alias("band")
    )
    entries = written(entries, "prefixes")
    groups = entries.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("indexed").alias("indexed")
    )
    groups = written(groups.where("lo < hi and indexed").select("band"), "meeting")
    return written(entries.select("band", "node", "root").join(groups, "band"), "met")


def _rest(members: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components of groups (band, node, root) that span several.

    Groups that have classes in common are one cluster, so that each class comes once. The
    largest component of a cluster is only compared with the other components' classes, not
    within itself. Blocks of both sides meet with their texts: pairs are compared where they
    meet and are no rows; what comes out are links that join components.
    """
    centres = members.groupBy("band").agg(F.min("node").alias("b"))
    clusters = components(members.join(centres, "band").select(F.col("node").alias("a"), "b"))
    clusters = clusters.withColumnRenamed("root", "cluster")
    members = members.select("node", "root").distinct().join(clusters, "node")
    sizes = members.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("cluster").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n")
    )
    sizes = sizes.select(
        "cluster",
        F.col("top.root").alias("main"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("lefts"),
        F.ceil(F.col("n") / BLOCK).alias("rights"),
    )
    rows = members.join(sizes.where("lefts > 0"), "cluster")
    left = rows.where("root != main").select(
        "cluster",
        F.expr("pmod(xxhash64(node, 2), lefts)").alias("i"),
        F.explode(F.expr("sequence(0L, rights - 1)")).alias("j"),
        F.lit(False).alias("right"),
        "node",
        "root",
    )
    right = rows.select(
        "cluster",
        F.explode(F.expr("sequence(0L, lefts - 1)")).alias("i"),
        F.expr("pmod(xxhash64(node, 3), rights)").alias("j"),
        F.lit(True).alias("right"),
        "node",
        "root",
    )
    wanted = classes.select("node", "signature").join(texts, "node")
    return (
        left.union(right)
        .join(wanted, "node")
        .select("cluster", "i", "j", "right", "node", "root", "signature", "class", "text")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j", "right")
        .mapInArrow(_linked_blocks, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, n_shingles, component_id, component, kept) for each row of ``docs``.

    ``component`` names the group, also among NULL doc_ids.
    """
    keyed = _keyed(docs)
    described = written(
        keyed.mapInArrow(
            _described,
            f"row_key {ROW_KEY}, doc_id long, n_shingles long, class binary, signature binary",
        ),
        "signatures",
    )
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_key", "signature"))
    classes = written(
        described.where("class is not null")
        .groupBy("class")
        .agg(first.alias("first"))
        .select(
            F.monotonically_increasing_id().alias("node"), "class", "first.doc_id",
            "first.row_key", "first.signature",
        ),
        "classes",
    )
    bands = classes.select("node", "signature").mapInArrow(_banded, "band long, node long")
    buckets = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    # Written: a join can split a hot bucket where both its sides are tables.
    members = written(bands.join(written(buckets, "buckets"), "band"), "members")
    compared = members.select("node").distinct()
    # One text for each class, however many rows repeat it.
    once = keyed.groupBy("row_key")
    texts = written(
        classes.select("node", "class", "row_key")
        .join(compared, "node")
        .join(once.agg(F.first("text").alias("text")), "row_key")
        .select("node", "class", "text"),
        "texts",
    )

    links, roots, left = None, None, members
    for turn in range(STAR_ROUNDS + 1):
        if roots is not None:
            left = written(_open(members, roots), "open")
            if left.isEmpty():
                break
        if turn == STAR_ROUNDS:
            found = _rest(_meeting(left, texts), classes, texts)
        else:
            by = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
            centres = left.groupBy("band").agg(
                F.min(F.struct(by.alias("by"), F.col("node"))).alias("c")
            )
            centres = written(centres, "stars")
            pairs = left.join(centres, "band").select(
                "node", F.col("c.node").alias("centre"), *(["root"] if turn else [])
            )
            pairs = pairs.where("node != centre")
            if turn:
                other = roots.select(F.col("node").alias("centre"), F.col("root").alias("over"))
                pairs = pairs.join(other, "centre", "left").where(
                    "root != coalesce(over, centre)"
                )
            pairs = pairs.groupBy("node").agg(F.min("centre").alias("centre"))
            pairs = written(pairs.select("centre", F.col("node").alias("member")), "pairs")
            found = _verified(pairs, texts)
        found = written(found, "found")
        if turn and turn < STAR_ROUNDS and found.isEmpty():
            continue
        links = found if links is None else links.union(found)
        roots = components(links)
    named = classes.join(roots, "node", "left").select(
        "class", "doc_id", F.coalesce("root", "node").alias("component")
    )
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("class", "component").join(least, "component")
    alone = F.isnull("component")
    return (
        described.select("row_key", "doc_id", "n_shingles", "class")
        .join(named, "class", "left")
        .select(
            "row_key",
            "doc_id",
            "n_shingles",
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            "component",
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
