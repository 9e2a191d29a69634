"""What the operators of this folder share: scratch tables and whole texts as arrays."""

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Type of a row's key: 128 bits, for 64 would collide within 10**10 rows.
ROW_KEY = "struct<a:bigint,b:bigint>"
#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a thousand rows, for some rows are whole texts of documents.

    A batch of the default size holds ten thousand of them, in the executor and in its worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, deleted when the session's JVM ends.

    That folder is ``spark.checkpoint.dir``, which a cluster must name. A session whose tasks
    are all on one machine may leave it unset: any folder is shared there, such as the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{shared.rstrip('/')}/ledgerlake-scratch/{name}-{uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    They are computed once, and a lost executor takes none of them along.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def row_key() -> Column:
    """What tells rows apart by their doc_id and text; equal rows have one key."""
    one, other = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id")
    return F.struct(one.alias("a"), other.alias("b")).alias("row_key")


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns in which NULL equals NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def steps(
    batches: Iterator[pa.RecordBatch], column: str, most: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of the text column, NULL texts made empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        batch = batch.set_column(at, pa.field(column, pa.large_string()), texts)
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(np.diff(ends // most)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and, one longer than their number, where each begins."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
