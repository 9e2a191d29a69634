"""The landing directory of JSON lines, and the topic that feeds it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerlake.functions.lineage import line_digest
from ledgerlake.schemas import LANDING


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, blank lines included; many small files share one task."""
    return spark.read.schema(LANDING).text(path)


def stream_landing(
    spark: SparkSession, path: str, files_per_batch: int | None = None, arrival: bool = False
) -> DataFrame:
    """The landing directory as a stream; ``files_per_batch`` bounds one micro-batch.

    With ``arrival``, ``arrived`` tells when a line's file was written.
    """
    reader = spark.readStream.schema(LANDING)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path)
    if not arrival:
        return lines
    return lines.select("value", F.col("_metadata.file_modification_time").alias("arrived"))


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str = "trades",
    offsets_per_batch: int | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Message values of a Kafka topic as lines; needs Spark's Kafka package.

    With ``arrival``, ``arrived`` tells when the topic took the message.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    columns = ["CAST(value AS STRING) AS value", *["timestamp AS arrived"] * arrival]
    return reader.load().selectExpr(*columns)


def delivered_once(lines: DataFrame, within: str = "1 day") -> DataFrame:
    """Streamed lines without those that are delivered again, at most ``within`` later.

    Equal lines are one message: a message names its time and ids. Lines need ``arrived``, and the
    state holds a digest of each line of the last ``within``, dealt over all partitions, since
    digests are. What arrives later than that after newer lines is left out as late, which a
    topic of one partition or a directory read in order of its files cannot show.
    """
    return (
        lines.withColumn("digest", line_digest("value"))
        .withWatermark("arrived", within)
        .dropDuplicatesWithinWatermark(["digest"])
        .select("value")
    )


def land(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Write streamed lines to the landing directory, each exactly once."""
    return (
        lines.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
