"""From raw documents to packed sequences, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``;
where a stage changes a text, ``n_chars`` follows it. Rows that repeat a doc_id stay apart
by their text. In the near-duplicate stage rows that repeat both doc_id and text are one
document, of which one row stays.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import line_dedup, near_duplicates, packing, toxicity
from ledgerlake.llm import substring_dedup as substrings
from ledgerlake.llm.common import read_table, row_key, small_batches, written
from ledgerlake.llm.tokens import WORD_BPE, vocabulary


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), row_key())


def _with_text(rows: DataFrame, names: list[str], text: Column) -> DataFrame:
    """The columns of ``row``, with another text and its length."""
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*(changed.get(x, F.col(f"row.`{x}`")).alias(x) for x in names))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from ``docs`` and the labels."""
    small_batches(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that repeat go, but for one occurrence."""
    small_batches(spark)
    return _with_text(line_dedup.remove_repeated_chunks(docs), docs.columns, F.col("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    small_batches(spark)
    kept = near_duplicates.near_duplicates(docs).where("kept").select("row_key", "component")
    # Other rows of the smallest doc_id may be in its group: one of them stays.
    grouped = kept.where("component is not null").groupBy("component")
    chosen = grouped.agg(F.min("row_key").alias("row_key")).select("row_key")
    chosen = chosen.union(kept.where("component is null").select("row_key"))
    rows = _keyed(docs).join(chosen.distinct(), "row_key")
    return rows.dropDuplicates(["row_key"]).select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that repeat go; texts that lose none keep their white space."""
    small_batches(spark)
    left = substrings.remove_repeats(docs).where("n_removed > 0").select("row_key", "kept")
    rows = _keyed(docs).join(left.distinct(), "row_key", "left")
    return _with_text(rows, docs.columns, F.coalesce("kept", "row.text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    small_batches(spark)
    return packing.pack(docs, vocabulary(WORD_BPE), end_id=0)


STAGES = (
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
)

#: Learned weights, shingle sets and tokenizers can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
