"""Token ids as files: a shared zstandard dictionary, one frame per document, an offset index.

The files are Parquet tables in one folder, so that Spark's own writers place them on any
store and commit them as a whole:

``dictionary``
    One row: the dictionary's bytes, its hash (``dictionary_id``), the width of an id in
    bytes.
``blocks``
    Documents in ascending order. A row holds the frames of some hundred documents one
    after another (``payload``) and its index: ``doc_ids``, ``offsets`` (where each frame
    begins, and the end of the last), ``n_tokens``, the smallest and largest document,
    and the ids before the block in its part of the order. Frames decompress one by one:
    reading a short document costs one short frame.

The dictionary is trained on the serialized ids of at most ``SAMPLE_DOCUMENTS`` documents,
picked by a hash of doc_id, of each a slice of up to ``SAMPLE_CHARS`` characters that begins
at a hashed place, so that any part of a long text may shape it. Tasks encode the slices;
their serialized ids are all that the driver gets. All documents are encoded whole.

NULL and empty texts have only the end id. Documents with a NULL doc_id come first;
repeated doc_ids are told apart by their text, and repeated rows are kept, one after
another. Other columns of the input play no part. An empty table writes no block.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.llm.common import steps
from ledgerlake.llm.tokens import part_encoder

SAMPLE_DOCUMENTS = 2000
SAMPLE_CHARS = 8000
DICTIONARY_BYTES = 64 << 10
BLOCK_DOCUMENTS = 256
BLOCK_BYTES = 512 << 10
LEVEL = 3
_STEP = 4 << 20

_DICTIONARY = "dictionary_id string, id_width int, dictionary binary"
_BLOCKS = (
    "part int, block int, first_doc long, last_doc long, part_start long, doc_ids array<long>, "
    "offsets array<long>, n_tokens array<long>, dictionary_id string, payload binary"
)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary bytes; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _frames(dictionary: bytes) -> dict:
    if len(dictionary) < 8:  # zstandard takes no shorter one
        return {}
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)}


def sampled_slice() -> Column:
    """Up to ``SAMPLE_CHARS`` characters of a text from a hashed place, each as likely to begin at."""
    last = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("doc_id", "text"), last.cast("long")).cast("int") + 1
    return F.substring("text", start, F.lit(SAMPLE_CHARS))


def sample_ids(docs: DataFrame, tokenizer: str, kind: np.dtype) -> list[bytes]:
    """Serialized ids of the sampled documents' slices, in an order of their own."""
    picked = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCUMENTS)
    picked = docs.where(F.col("doc_id").isin([x.doc_id for x in picked.collect()]))
    slices = picked.select("doc_id", sampled_slice().alias("text"))

    def serialized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(tokenizer)
        for step in steps(batches, "text", _STEP):
            ids, offsets = encoder.encode(step.column("text"))
            ids = ids.astype(kind)
            found = [ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:]) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["ids"])

    slices = slices.limit(SAMPLE_DOCUMENTS).repartition("doc_id")
    found = slices.mapInArrow(serialized, "ids binary").collect()
    return sorted(bytes(x.ids) for x in found)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_width: int = 4
) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the files.

    ``id_width`` is 2 for vocabularies of up to 65,536 ids, else 4.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[id_width]
    samples = sample_ids(docs, tokenizer, kind)
    dictionary = train_dictionary(samples)
    name = hashlib.sha256(dictionary).hexdigest()[:16]
    spark.createDataFrame([(name, id_width, dictionary)], _DICTIONARY).write.parquet(
        f"{path}/dictionary"
    )

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(tokenizer)
        shared = _frames(dictionary)
        for prepared in shared.values():
            prepared.precompute_compress(level=LEVEL)  # else each document prepares it anew
        compress = zstandard.ZstdCompressor(level=LEVEL, **shared).compress
        end = np.array([end_id], kind).tobytes()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, bytes, int]] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, start
            known = [d for d, _, _ in held if d is not None]
            places = np.cumsum([0, *(len(x) for _, x, _ in held)]).tolist()
            row = {
                "part": part,
                "block": block,
                "first_doc": min(known, default=None),
                "last_doc": max(known, default=None),
                "part_start": start,
                "doc_ids": [d for d, _, _ in held],
                "offsets": places,
                "n_tokens": [n for _, _, n in held],
                "dictionary_id": name,
                "payload": b"".join(x for _, x, _ in held),
            }
            block, start = block + 1, start + sum(row["n_tokens"])
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_blocks_schema())

        size = 0
        for step in steps(batches, "text", _STEP):
            ids, offsets = encoder.encode(step.column("text"))
            ids = ids.astype(kind)
            for doc, a, b in zip(step.column("doc_id").to_pylist(), offsets[:-1], offsets[1:]):
                frame = compress(ids[a:b].tobytes() + end)
                held.append((doc, frame, int(b - a) + 1))
                size += len(frame)
                if len(held) == BLOCK_DOCUMENTS or size >= BLOCK_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    # Rows of one doc_id are split by how their texts begin.
    ordered = docs.repartitionByRange("doc_id", F.left("text", F.lit(32)))
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, _BLOCKS).write.option("compression", "none").parquet(
        f"{path}/blocks"
    )


def _blocks_schema() -> pa.Schema:
    long = pa.int64()
    return pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("first_doc", long), ("last_doc", long)]
        + [("part_start", long)]
        + [(x, pa.list_(long)) for x in ("doc_ids", "offsets", "n_tokens")]
        + [("dictionary_id", pa.string()), ("payload", pa.binary())]
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of all documents before them.

    The parts' totals are one row per write task, which is all that one task adds up.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = blocks.groupBy("part").agg(F.sum(size).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return blocks.join(F.broadcast(totals), "part").select(
        "*", (F.col("before") + F.col("part_start")).alias("start")
    )


def read_token_files(
    spark: SparkSession,
    path: str,
    doc_ids: list[int] | None = None,
    digest: Callable[[bytes], int] | None = None,
) -> DataFrame:
    """Every document's ids from the files: doc_id, start, n_tokens, ids.

    Ids are little-endian unsigned 32-bit integers. With ``doc_ids`` only their frames are
    decompressed, and only blocks whose range of documents holds one of them are read. With
    ``digest`` a document's ids stay where they are read, and its ``digest`` comes instead.
    """
    dictionary, width = spark.read.schema(_DICTIONARY).parquet(f"{path}/dictionary").select(
        "dictionary", "id_width"
    ).first()
    dictionary = bytes(dictionary)
    blocks = read_blocks(spark, path)
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        near = F.lit(False)
        for doc in sorted(wanted):
            near = near | F.lit(doc).between(F.col("first_doc"), F.col("last_doc"))
        blocks = blocks.where(near)
    kind = np.dtype("<u2") if width == 2 else np.dtype("<u4")
    names = ["doc_id", "start", "n_tokens", "digest" if digest else "ids"]

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(**_frames(dictionary)).decompress
        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.slice(at, 1).to_pylist()[0]
                payload, places, start = block["payload"], block["offsets"], block["start"]
                rows = []
                for k, (doc, n) in enumerate(zip(block["doc_ids"], block["n_tokens"])):
                    if wanted is None or doc in wanted:
                        raw = expand(payload[places[k] : places[k + 1]])
                        ids = np.frombuffer(raw, kind).astype("<u4")
                        ids_ = ids.tobytes()
                        rows.append((doc, start, len(ids), digest(ids_) if digest else ids_))
                    start += n
                if rows:
                    last = pa.int64() if digest else pa.binary()
                    columns = zip(zip(*rows), (*[pa.int64()] * 3, last))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, kind_) for values, kind_ in columns],
                        names=names,
                    )

    slim = blocks.select("start", "doc_ids", "offsets", "n_tokens", "payload")
    last = "digest long" if digest else "ids binary"
    return slim.mapInArrow(documents, f"doc_id long, start long, n_tokens long, {last}")
