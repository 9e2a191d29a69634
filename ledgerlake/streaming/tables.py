"""The same tables, kept up by streams.

Each function returns a writer, so the caller picks the trigger and starts it:
``trigger(availableNow=True)`` catches up and stops, ``processingTime`` keeps running.

Rows are brought together by day before they are written, so that files are few, and
``rebalance`` splits a day that holds much of a micro-batch over many tasks, as in batch.
"""

import logging
from collections.abc import Callable
from threading import Thread

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ledgerlake.operators.account import account_events
from ledgerlake.operators.days import added_sums, metrics_of_sums
from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.operators.orders import silver_orders
from ledgerlake.plans.paths import LakePaths
from ledgerlake.plans.stages import add_account, add_orders
from ledgerlake.schemas import (
    ACCOUNT_EVENTS,
    BALANCES,
    BRONZE,
    EQUITY_INSTANTS,
    EQUITY_MINUTES,
    GOLD_DAILY_METRICS,
    GOLD_TRADES,
    POSITIONS,
    SILVER_ACCOUNT,
    SILVER_ORDERS,
    TRADE_BLOOMS,
    TRADE_DAYS,
    TRADE_ORDER,
)
from ledgerlake.sources.tables import (
    BY_DAY,
    claim_name,
    compact,
    read_trade_days,
    sum_up,
    write_gold,
)

#: Loads of a stream after which it looks for parts to merge.
COMPACT_EVERY = 8


def bronze_stream(lines: DataFrame, paths: LakePaths) -> DataStreamWriter:
    """Append streamed lines to bronze, each exactly once."""
    return (
        lines.transform(bronze_rows)
        .hint("rebalance", "event_type", "event_date")
        .writeStream.format("parquet")
        .option("path", paths.streamed_bronze)
        .option("checkpointLocation", paths.checkpoint("bronze"))
        .partitionBy("event_type", "event_date")
    )


def stream_bronze(
    spark: SparkSession, paths: LakePaths, files_per_batch: int = 1000
) -> DataFrame:
    """The streamed bronze table as a stream of new rows, so many files a micro-batch."""
    reader = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(paths.streamed_bronze)


def silver_orders_stream(
    bronze: DataFrame,
    paths: LakePaths,
    name: str,
    schema_version: int = 1,
    compact_every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """Add streamed order updates to silver orders, and keep up gold's daily metrics.

    The metrics are added up from the loads' sums by day: they parse no line and keep no
    state, and a trade that arrives late counts in its day, as in batch.
    """

    def add(batch: DataFrame, load_id: str) -> None:
        add_orders(batch.hint("rebalance", "event_time"), paths, load_id)
        days = metrics_of_sums(read_trade_days(batch.sparkSession, paths.trade_days))
        write_gold(days, paths.gold_daily_metrics, GOLD_DAILY_METRICS)

    def tidy(spark: SparkSession) -> None:
        compact(spark, paths.silver_orders, SILVER_ORDERS, BY_DAY)
        compact(
            spark, paths.gold_trades, GOLD_TRADES, order=TRADE_ORDER, blooms=TRADE_BLOOMS
        )
        compact(spark, paths.late_trades, GOLD_TRADES)
        sum_up(spark, paths.trade_days, TRADE_DAYS, name, added_sums)

    return _load_each_batch(
        silver_orders(bronze, schema_version),
        paths.silver_orders,
        paths.checkpoint("silver_orders"),
        name,
        add,
        tidy,
        compact_every,
    )


def silver_account_stream(
    bronze: DataFrame,
    paths: LakePaths,
    name: str,
    schema_version: int = 1,
    compact_every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """Add streamed account updates to the silver account tables."""

    def add(batch: DataFrame, load_id: str) -> None:
        add_account(batch.hint("rebalance"), paths, load_id, schema_version)

    def tidy(spark: SparkSession) -> None:
        compact(spark, paths.account_events, ACCOUNT_EVENTS)
        compact(spark, paths.balances, BALANCES)
        compact(spark, paths.positions, POSITIONS)
        compact(spark, paths.silver_account, SILVER_ACCOUNT, BY_DAY)
        compact(spark, paths.equity_instants, EQUITY_INSTANTS, ("day",))
        compact(spark, paths.equity_minutes, EQUITY_MINUTES)

    return _load_each_batch(
        account_events(bronze),
        paths.silver_account,
        paths.checkpoint("silver_account"),
        name,
        add,
        tidy,
        compact_every,
    )


class _Beside:
    """Runs one thing at a time beside the stream; while it runs, another is not begun."""

    def __init__(self):
        self._running: Thread | None = None

    def start(self, spark: SparkSession, work: Callable[[SparkSession], None]) -> None:
        def logged() -> None:
            try:
                work(spark)
            except Exception:
                logging.getLogger(__name__).exception("parts were not merged")

        if self._running is None or not self._running.is_alive():
            self._running = Thread(target=inheritable_thread_target(spark)(logged))
            self._running.start()


def _load_each_batch(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    add: Callable[[DataFrame, str], None],
    tidy: Callable[[SparkSession], None],
    compact_every: int,
) -> DataStreamWriter:
    """Add every micro-batch as a load of its own, called by the stream's name and number.

    A micro-batch that is replayed after a failure replaces its own load. Parts are merged
    beside the stream, by a thread that commits only what did not change meanwhile; one that
    fails is logged, and the next one does its work. The name belongs to the stream that first used it: one that
    starts over on a new checkpoint fails until it has a name of its own. Routing and
    parsing belong to the streamed plan, so a stream reads only its own event type.
    """

    beside = _Beside()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        claim_name(spark, path, name, owner)
        add(batch, f"{name}-{batch_id}")
        if batch_id % compact_every == compact_every - 1:
            beside.start(spark, tidy)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
