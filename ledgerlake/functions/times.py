"""Epoch milliseconds to timestamps and dates."""

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def timestamp_of(millis: Column) -> Column:
    """Timestamp of epoch milliseconds given as a number or as text.

    Text that is no number and values outside the timestamp range become NULL under
    either ANSI setting, so one bad line cannot fail a whole job.
    """
    return (millis.try_cast("double") / 1000).try_cast("timestamp")


def _present(df: DataFrame, columns: list[str], purpose: str) -> list[str]:
    for name in columns:
        if name not in df.columns:
            log.warning("no column %s to turn into a %s", name, purpose)
    return [name for name in columns if name in df.columns]


def millis_to_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace epoch-millisecond columns by timestamps; absent columns are logged."""
    present = _present(df, columns, "timestamp")
    return df.withColumns({name: timestamp_of(F.col(name)) for name in present})


def timestamps_to_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace timestamp columns by their dates; absent columns are logged."""
    present = _present(df, columns, "date")
    return df.withColumns({name: F.to_date(name) for name in present})
