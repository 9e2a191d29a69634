"""The batch job: landing to bronze to silver to gold."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.account import (
    account_events,
    account_rows,
    balance_rows,
    position_rows,
)
from ledgerlake.operators.days import (
    late_trades,
    metrics_of_sums,
    sharpe_of_sums,
    trade_day_sums,
)
from ledgerlake.operators.envelope import bronze_rows, first_deliveries, line_digests
from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.risk import (
    daily_drawdowns,
    equity_instants,
    equity_points,
    joined_risk,
    merged_minutes,
    minute_summaries,
)
from ledgerlake.operators.trades import closed_trades
from ledgerlake.plans.paths import LakePaths
from ledgerlake.schemas import (
    ACCOUNT_EVENTS,
    ACCOUNT_REQUIRED,
    BALANCES,
    BRONZE,
    EQUITY_INSTANTS,
    EQUITY_MINUTES,
    GOLD_DAILY_METRICS,
    GOLD_DAILY_RISK,
    GOLD_TRADES,
    LINE_DIGESTS,
    ORDER_REQUIRED,
    POSITIONS,
    SILVER_ACCOUNT,
    SILVER_ORDERS,
    TRADE_BLOOMS,
    TRADE_DAYS,
    TRADE_ORDER,
)
from ledgerlake.sources.landing import read_landing
from ledgerlake.sources.tables import (
    BY_DAY,
    Load,
    bronze_into,
    compact,
    facts_of,
    read_bronze,
    read_equity_instants,
    read_equity_minutes,
    read_loads,
    read_trade_days,
    silver_into,
    write_bronze,
    write_golds,
)


def run_bronze(
    spark: SparkSession, paths: LakePaths, load_id: str, once: bool = False
) -> None:
    """Write the lines landed for one load to bronze.

    With ``once``, lines that are in this load already, or in another one that was loaded so, are
    left out: a topic's connector delivers each message at least once. Digests of all lines
    are kept for that, by date.
    """
    rows = bronze_rows(read_landing(spark, paths.landed(load_id)))
    if not once:
        write_bronze(rows, paths.bronze, load_id)
        return
    known = read_loads(spark, paths.line_digests, LINE_DIGESTS)
    known = known.where(F.col("load_id") != load_id)
    with Load(spark, load_id) as load:
        bronze_into(load, first_deliveries(rows, known), paths.bronze)
        digests = line_digests(load.read(paths.bronze, BRONZE))
        load.write(digests.hint("rebalance", "event_date"), paths.line_digests, ("event_date",))


def orders_into(load: Load, orders: DataFrame, paths: LakePaths, lateness: str = "1 day") -> dict:
    """Add order rows to a load: silver, its trades for gold, and their sums by day.

    Trades and sums are made from the rows as written, so that no line is parsed again.
    What came too late is judged by the newest trade of the loads before this one. That time
    is written down with the load, and running the load again judges by the same.
    """
    spark = load.spark
    counts = silver_into(load, orders, ORDER_REQUIRED, paths.silver_orders)
    verdict = T.StructType([*SILVER_ORDERS, T.StructField("verdict", T.StringType())])
    clean = load.read(paths.silver_orders, verdict).where("verdict = 'clean'")
    load.blooms[paths.gold_trades] = TRADE_BLOOMS
    load.write(clustered(closed_trades(clean)), paths.gold_trades)
    known = facts_of(spark, paths.trade_days, load.load_id)
    if "newest_before" not in known:
        earlier = read_trade_days(spark, paths.trade_days, without=load.load_id)
        known = {"newest_before": earlier.agg(F.unix_micros(F.max("newest"))).first()[0]}
    load.facts |= known
    newest = F.timestamp_micros(F.lit(known["newest_before"]).cast("long"))
    trades = load.read(paths.gold_trades, GOLD_TRADES)
    load.write(trade_day_sums(trades, newest, lateness).coalesce(1), paths.trade_days)
    if known["newest_before"] is not None:
        load.write(late_trades(trades, newest, lateness), paths.late_trades)
    return counts


def clustered(trades: DataFrame) -> DataFrame:
    """Trades in order of time within each file, so that row groups can be skipped.

    A silver file has one day; so has what becomes of it, without a shuffle.
    """
    return trades.sortWithinPartitions(*TRADE_ORDER)


def account_into(
    load: Load, events: DataFrame, paths: LakePaths, schema_version: int = 1
) -> dict[str, int]:
    """Add account updates to a load: the updates, their pairs and elements, and the equity curve.

    Lines are parsed once, for the table of updates; the others are made from that.
    """
    spark = load.spark
    load.write(events, paths.account_events)
    events = load.read(paths.account_events, ACCOUNT_EVENTS)
    keep = inheritable_thread_target(spark)
    elements = ((balance_rows, paths.balances), (position_rows, paths.positions))
    with ThreadPoolExecutor(3) as pool:
        others = [
            pool.submit(keep(load.write), rows(events, schema_version), path)
            for rows, path in elements
        ]
        others.append(pool.submit(keep(_curve_into), load, events, paths))
        pairs = account_rows(events, schema_version)
        counts = silver_into(load, pairs, ACCOUNT_REQUIRED, paths.silver_account)
        for other in others:
            other.result()
    return counts


def _curve_into(load: Load, events: DataFrame, paths: LakePaths) -> None:
    instants = equity_instants(equity_points(events)).withColumn("day", F.to_date("minute"))
    load.write(instants.hint("rebalance", "day"), paths.equity_instants, ("day",))
    written = load.read(paths.equity_instants, EQUITY_INSTANTS)
    load.write(minute_summaries(written), paths.equity_minutes)


def add_orders(
    orders: DataFrame, paths: LakePaths, load_id: str, lateness: str = "1 day"
) -> dict[str, int]:
    """Add one load of order rows by itself."""
    with Load(orders.sparkSession, load_id) as load:
        return orders_into(load, orders, paths, lateness)


def add_account(
    events: DataFrame, paths: LakePaths, load_id: str, schema_version: int = 1
) -> dict[str, int]:
    """Add one load of account updates by itself."""
    with Load(events.sparkSession, load_id) as load:
        return account_into(load, events, paths, schema_version)


def run_silver(
    spark: SparkSession, paths: LakePaths, load_id: str, schema_version: int = 1
) -> dict[str, dict[str, int]]:
    """Add one load of bronze to all silver tables at once; returns row counts per feed.

    The feeds read different partitions and run side by side, so that one fills the cores
    the other's last tasks leave idle. One commit makes the load visible in all tables.
    """
    bronze = read_bronze(spark, paths.bronze, load_id)
    orders = silver_orders(bronze, schema_version)
    account = account_events(bronze)
    keep = inheritable_thread_target(spark)
    with Load(spark, load_id) as load, ThreadPoolExecutor(2) as pool:
        feeds = {
            "orders": pool.submit(keep(orders_into), load, orders, paths),
            "account": pool.submit(keep(account_into), load, account, paths, schema_version),
        }
        return {feed: counts.result() for feed, counts in feeds.items()}


def run_gold(spark: SparkSession, paths: LakePaths) -> None:
    """Make the daily gold tables from what the loads summed up; trades are there already.

    No trade and no account update is read, of whatever load: sums by day and summaries by
    minute are added up. Both tables change in one commit.
    """
    sums = read_trade_days(spark, paths.trade_days)
    minutes = merged_minutes(
        read_equity_minutes(spark, paths.equity_minutes).drop("load_id"),
        read_equity_instants(spark, paths.equity_instants).drop("load_id"),
    )
    risk = joined_risk(daily_drawdowns(minutes), sharpe_of_sums(sums))
    write_golds(
        spark,
        {
            paths.gold_daily_metrics: (metrics_of_sums(sums), GOLD_DAILY_METRICS),
            paths.gold_daily_risk: (risk, GOLD_DAILY_RISK),
        },
    )


def compact_lake(spark: SparkSession, paths: LakePaths, **options) -> int:
    """Merge parts of all tables where they are due; returns the bytes written."""
    tables = (
        (paths.bronze, BRONZE, ("event_type", "event_date")),
        (paths.silver_orders, SILVER_ORDERS, BY_DAY),
        (paths.silver_account, SILVER_ACCOUNT, BY_DAY),
        (paths.account_events, ACCOUNT_EVENTS, ()),
        (paths.balances, BALANCES, ()),
        (paths.positions, POSITIONS, ()),
        (paths.trade_days, TRADE_DAYS, ()),
        (paths.equity_instants, EQUITY_INSTANTS, ("day",)),
        (paths.equity_minutes, EQUITY_MINUTES, ()),
        (paths.late_trades, GOLD_TRADES, ()),
        (paths.line_digests, LINE_DIGESTS, ("event_date",)),
    )
    trades = compact(
        spark, paths.gold_trades, GOLD_TRADES, order=TRADE_ORDER, blooms=TRADE_BLOOMS, **options
    )
    return trades + sum(compact(spark, *table, **options) for table in tables)


def run(
    spark: SparkSession,
    paths: LakePaths,
    load_id: str,
    schema_version: int = 1,
    once: bool = False,
) -> dict[str, dict[str, int]]:
    """Bring the lines landed for one load to gold; the session stays open.

    Each batch of lines has a folder of its own, ``load_id=<load_id>`` in the landing
    directory, and costs what its own lines cost. Running a load again replaces it.
    """
    run_bronze(spark, paths, load_id, once)
    counts = run_silver(spark, paths, load_id, schema_version)
    run_gold(spark, paths)
    compact_lake(spark, paths)
    return counts
