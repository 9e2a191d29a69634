"""Typed parse of raw JSON lines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import by_key, by_name


def parse_payload(df: DataFrame, payload: tuple) -> DataFrame:
    """Parse ``raw_json`` into the payload's top-level columns, next to ``ingest_time``.

    The cast renames the parsed fields by position. ``inline`` over a one-element array
    keeps one row per line and, unlike a plain projection, does not let filters on the
    parsed columns move below the parse, where each of them would parse the line again.
    A bad field becomes NULL and the other fields survive.
    """
    parsed = F.from_json("raw_json", by_key(payload)).cast(by_name(payload))
    return df.select("ingest_time", "raw_json", F.inline(F.array(parsed)))
