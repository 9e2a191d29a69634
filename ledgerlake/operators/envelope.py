"""Raw lines to bronze rows, and routing of bronze rows by event type."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.lineage import line_digest
from ledgerlake.functions.times import timestamp_of
from ledgerlake.schemas import ACCOUNT_EVENT, ORDER_EVENT


def bronze_rows(lines: DataFrame) -> DataFrame:
    """Keep each line as it is and add its type, time and date.

    Both keys come out of one pass over the line; should a line repeat a key, its last
    value counts, as in the typed parse. Lines that are no JSON object, blank ones
    included, get NULL type and time and stay in bronze.
    """
    return (
        lines.withColumnRenamed("value", "raw_json")
        .select(
            "raw_json",
            F.current_timestamp().alias("ingest_time"),
            F.json_tuple("raw_json", "e", "T").alias("event_type", "event_millis"),
        )
        .select(
            "raw_json",
            "ingest_time",
            timestamp_of(F.col("event_millis")).alias("event_time"),
            "event_type",
        )
        .withColumn("event_date", F.to_date("event_time"))
    )


def line_digests(bronze: DataFrame) -> DataFrame:
    """(digest, event_date) of bronze rows; half of a SHA-256 tells lines apart."""
    return bronze.select(line_digest("raw_json").alias("digest"), "event_date")


def first_deliveries(bronze: DataFrame, known: DataFrame) -> DataFrame:
    """Bronze rows without repetitions, of each other or of lines whose digests are known.

    Equal lines have equal dates, so the digest alone decides, and lines are shuffled once: they
    meet those that are known where they met each other. A line that repeats very often is combined
    map-side, and then meets one digest.
    """
    once = bronze.withColumn("digest", line_digest("raw_json")).dropDuplicates(["digest"])
    return once.join(known.select("digest"), "digest", "left_anti").select(*bronze.columns)


def of_type(bronze: DataFrame, event_type: str) -> DataFrame:
    """Rows of one event type; prunes partitions when read from the bronze table."""
    return bronze.where(F.col("event_type") == event_type)


def unrouted(bronze: DataFrame) -> DataFrame:
    """Rows that reach neither silver table: other types, and lines without a type."""
    routed = F.col("event_type").isin(ORDER_EVENT, ACCOUNT_EVENT)
    return bronze.where(~F.coalesce(routed, F.lit(False)))
