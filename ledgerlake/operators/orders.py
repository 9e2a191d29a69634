"""Bronze order updates to silver order rows."""

from pyspark.sql import DataFrame

from ledgerlake.functions.lineage import stamp
from ledgerlake.functions.payload import parse_payload
from ledgerlake.functions.times import millis_to_timestamps, timestamps_to_dates
from ledgerlake.operators.envelope import of_type
from ledgerlake.schemas import ENVELOPE, ORDER_BODY, ORDER_EVENT, ORDER_PAYLOAD, names, narrowed


def order_events(bronze: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Order updates with their typed payload; ``only`` names the body's columns to convert."""
    payload = ORDER_PAYLOAD if only is None else narrowed(ORDER_PAYLOAD, only)
    return of_type(bronze, ORDER_EVENT).transform(parse_payload, payload)


def order_rows(events: DataFrame, schema_version: int = 1) -> DataFrame:
    """One flat row per order update; ``event_time`` ends up as the date of the event."""
    body = [x for x in names(ORDER_BODY) if x in events.schema["body"].dataType.names]
    times = ["event_time", "event_received_time", *(x for x in ("trade_time",) if x in body)]
    return (
        events.select(
            *names(ENVELOPE),
            *[f"body.{name}" for name in body],
            "ingest_time",
            "raw_json",
        )
        .transform(millis_to_timestamps, times)
        .transform(timestamps_to_dates, ["event_time"])
        .transform(stamp, schema_version)
    )


def silver_orders(
    bronze: DataFrame, schema_version: int = 1, only: tuple[str, ...] | None = None
) -> DataFrame:
    return bronze.transform(order_events, only).transform(order_rows, schema_version)
