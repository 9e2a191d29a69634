"""Bronze account updates to silver account rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.lineage import stamp
from ledgerlake.functions.payload import parse_payload
from ledgerlake.functions.times import millis_to_timestamps, timestamps_to_dates
from ledgerlake.operators.envelope import of_type
from ledgerlake.schemas import (
    ACCOUNT_EVENT,
    ACCOUNT_PAYLOAD,
    BALANCE,
    ENVELOPE,
    POSITION,
    names,
)


def account_events(bronze: DataFrame) -> DataFrame:
    """Account updates with their typed payload, one row each, arrays kept."""
    return of_type(bronze, ACCOUNT_EVENT).transform(parse_payload, ACCOUNT_PAYLOAD)


def _one_row_per(events: DataFrame, array: str, element: str) -> DataFrame:
    # An empty or missing array keeps its event, with a NULL element.
    return events.select("*", F.explode_outer(f"body.{array}").alias(element))


def _timed(rows: DataFrame, schema_version: int) -> DataFrame:
    return (
        rows.transform(millis_to_timestamps, ["event_time", "event_received_time"])
        .transform(timestamps_to_dates, ["event_time"])
        .transform(stamp, schema_version)
    )


def balance_rows(events: DataFrame, schema_version: int = 1) -> DataFrame:
    """One row per balance, each balance once: the table to sum balance changes over."""
    return (
        _one_row_per(events, "balances", "balance")
        .select(*names(ENVELOPE), "body.event_reason", "balance.*", "ingest_time")
        .transform(_timed, schema_version)
    )


def position_rows(events: DataFrame, schema_version: int = 1) -> DataFrame:
    """One row per position, each position once: the table to sum position PnL over."""
    return (
        _one_row_per(events, "positions", "position")
        .select(*names(ENVELOPE), "body.event_reason", "position.*", "ingest_time")
        .transform(_timed, schema_version)
    )


def account_rows(events: DataFrame, schema_version: int = 1) -> DataFrame:
    """Every balance of an event beside every position of the same event.

    Values repeat within an event, so this table is for lookups; sums belong on
    :func:`balance_rows` and :func:`position_rows`. The pairing stays inside one row's
    two arrays and needs no shuffle.
    """
    return (
        events.transform(_one_row_per, "balances", "balance")
        .transform(_one_row_per, "positions", "position")
        .select(
            *names(ENVELOPE),
            "body.event_reason",
            *[f"balance.{name}" for name in names(BALANCE)],
            *[f"position.{name}" for name in names(POSITION)],
            "ingest_time",
            "raw_json",
        )
        .transform(_timed, schema_version)
    )


def silver_account(bronze: DataFrame, schema_version: int = 1) -> DataFrame:
    return bronze.transform(account_events).transform(account_rows, schema_version)
