"""Every operator as a query over the ``events`` test table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerlake.operators.account import (
    account_events,
    balance_rows,
    position_rows,
    silver_account,
)
from ledgerlake.operators.days import settled_days, window_metrics
from ledgerlake.operators.envelope import bronze_rows, unrouted
from ledgerlake.operators.equity import account_changes, carried_equity
from ledgerlake.operators.metrics import daily_metrics
from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.quality import (
    all_present,
    any_missing,
    clean_rows,
    rejected_rows,
    with_verdict,
)
from ledgerlake.operators.risk import daily_max_drawdown, daily_sharpe, equity_points
from ledgerlake.operators.trades import trades_of_bronze, trades_of_orders
from ledgerlake.plans.paths import LakePaths, scratch_lake
from ledgerlake.plans.stages import compact_lake, run, run_bronze, run_gold, run_silver
from ledgerlake.schemas import ACCOUNT_REQUIRED, ORDER_REQUIRED
from ledgerlake.sources.catalog import register_gold
from ledgerlake.sources.landing import delivered_once, land, read_landing, stream_landing
from ledgerlake.sources.tables import (
    read_balances,
    read_bronze,
    read_gold_daily_metrics,
    read_gold_daily_risk,
    read_gold_trades,
    read_late_trades,
    read_positions,
    read_quarantine,
    read_silver_account,
    read_silver_orders,
    read_trade_days,
)
from ledgerlake.streaming.tables import (
    bronze_stream,
    silver_account_stream,
    silver_orders_stream,
    stream_bronze,
)
from testbench.feed import feed_lines, read_events

Query = Callable[[SparkSession, str], DataFrame]

# Run-dependent columns, left out of query results.
_VOLATILE = ("ingest_time", "processing_time")
_LOAD = "first"
# Lines of a landed file, some 25 MB: a gzip file is read as a whole.
_FILE_LINES = 50_000


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_lines(read_events(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(_lines(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders(_bronze(spark, sf_dir)).drop(*_VOLATILE, "raw_json")


def _account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_account(_bronze(spark, sf_dir)).drop(*_VOLATILE, "raw_json")


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_of_bronze(_bronze(spark, sf_dir))


def _deliver(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Land lines as the gzip files of a connector, each small enough to be read by one task."""
    options = {"compression": "gzip", "maxRecordsPerFile": _FILE_LINES}
    lines.write.options(**options).mode(mode).text(path)


def _landed(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A lake whose landing directory holds all lines as one load."""
    paths = scratch_lake(spark)
    _deliver(_lines(spark, sf_dir), paths.landed(_LOAD))
    return paths


def _in_steps(spark: SparkSession, sf_dir: str, steps: int) -> list[DataFrame]:
    """The lines in steps that each span all days."""
    events = read_events(spark, sf_dir)
    return [feed_lines(events.where(F.col("event_id") % steps == k)) for k in range(steps)]


def _finish(writer: DataStreamWriter) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


# Lines and bronze


def raw_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _landed(spark, sf_dir)
    return read_landing(spark, paths.landed(_LOAD)).agg(
        F.count("*").alias("lines"), F.count_if(F.col("value") == "").alias("blank_lines")
    )


def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select("event_time", "event_type", "event_date")


def bronze_roundtrip_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _landed(spark, sf_dir)
    run_bronze(spark, paths, _LOAD)
    bronze = read_bronze(spark, paths.bronze)
    return bronze.groupBy("event_type", "event_date").agg(F.count("*").alias("events"))


def route_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("events"))


def unrouted_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = unrouted(_bronze(spark, sf_dir))
    return bronze.groupBy("event_type").agg(F.count("*").alias("events"))


# Silver


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(_orders(spark, sf_dir), ORDER_REQUIRED)


def clean_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(_account(spark, sf_dir), ACCOUNT_REQUIRED)


def quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(_orders(spark, sf_dir), ORDER_REQUIRED)


def quarantine_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(_account(spark, sf_dir), ACCOUNT_REQUIRED)


def split_is_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are clean, rejected, both or neither, beside all rows."""

    def counted(rows: DataFrame, feed: str, required: tuple[str, ...]) -> DataFrame:
        clean, rejected = all_present(required), any_missing(required)
        return rows.agg(
            F.lit(feed).alias("feed"),
            F.count("*").alias("row_count"),
            F.count_if(clean).alias("clean"),
            F.count_if(rejected).alias("quarantine"),
            F.count_if(clean & rejected).alias("both"),
            F.count_if(~(clean | rejected)).alias("neither"),
        )

    return counted(_orders(spark, sf_dir), "orders", ORDER_REQUIRED).unionByName(
        counted(_account(spark, sf_dir), "account", ACCOUNT_REQUIRED)
    )


def verdict_by_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).transform(with_verdict, ORDER_REQUIRED)
    account = _account(spark, sf_dir).transform(with_verdict, ACCOUNT_REQUIRED)
    verdicts = orders.select(F.lit("orders").alias("feed"), "verdict").unionByName(
        account.select(F.lit("account").alias("feed"), "verdict")
    )
    return verdicts.groupBy("feed", "verdict").agg(F.count("*").alias("row_count"))


def account_balances_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_rows(account_events(_bronze(spark, sf_dir))).drop(*_VOLATILE)


def account_positions_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_rows(account_events(_bronze(spark, sf_dir))).drop(*_VOLATILE)


def account_cross_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rows per update."""
    updates = _account(spark, sf_dir).groupBy("event_received_time")
    return updates.agg(
        F.count("*").alias("row_count"),
        F.count("asset").alias("with_balance"),
        F.count("entry_price").alias("with_position"),
    )


def decimal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("order_id", "original_quantity", "commission")


def silver_schema_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).groupBy("schema_version").agg(F.count("*").alias("row_count"))


def silver_roundtrip_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean silver rows by date."""
    paths = _landed(spark, sf_dir)
    run_bronze(spark, paths, _LOAD)
    run_silver(spark, paths, _LOAD)
    return _silver_by_date(spark, paths)


def _silver_by_date(spark: SparkSession, paths: LakePaths) -> DataFrame:
    orders = read_silver_orders(spark, paths.silver_orders)
    account = read_silver_account(spark, paths.silver_account)
    dates = orders.select(F.lit("orders").alias("feed"), "event_time").unionByName(
        account.select(F.lit("account").alias("feed"), "event_time")
    )
    return dates.groupBy("feed", "event_time").agg(F.count("*").alias("row_count"))


def quarantine_by_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _landed(spark, sf_dir)
    run_bronze(spark, paths, _LOAD)
    run_silver(spark, paths, _LOAD)
    quarantine = read_quarantine(spark, paths.silver_orders, paths.silver_account)
    return quarantine.groupBy("feed", "event_type").agg(F.count("*").alias("row_count"))


# Gold


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(_trades(spark, sf_dir))


def _built(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = _landed(spark, sf_dir)
    run(spark, paths, _LOAD)
    return paths


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gold_trades(spark, _built(spark, sf_dir).gold_trades)


def gold_trades_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades of those orders that have the ten largest profits, looked up by id."""
    trades = read_gold_trades(spark, _built(spark, sf_dir).gold_trades)
    best = trades.orderBy(F.desc_nulls_last("realized_pnl"), "order_id").limit(10)
    return trades_of_orders(trades, [x.order_id for x in best.select("order_id").collect()])


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gold_daily_metrics(spark, _built(spark, sf_dir).gold_daily_metrics)


def _gold_sql(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """A query over registered tables; ``{gold}`` is their database.

    The database goes when the query is planned: the plan knows the files by then, and
    dropping external tables leaves those alone.
    """
    paths = _built(spark, sf_dir)
    database = "gold_" + paths.root.split("/")[-2]
    register_gold(spark, paths, database)
    found = spark.sql(query.format(gold=database))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


def gold_sql_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_sql(
        spark,
        sf_dir,
        "SELECT day, total_pnl, trades_count, win_rate FROM {gold}.daily_metrics "
        "WHERE total_pnl > 0",
    )


def gold_sql_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_sql(
        spark,
        sf_dir,
        "SELECT symbol, count(*) AS trades_count, sum(realized_pnl) AS total_pnl "
        "FROM {gold}.trades GROUP BY symbol",
    )


def gold_sql_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk table through the catalog; deviations rounded as in :func:`sharpe`."""
    return _gold_sql(
        spark,
        sf_dir,
        "SELECT day, max_drawdown, running_drawdown, round(sharpe, 9) AS sharpe "
        "FROM {gold}.daily_risk",
    )


def batch_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of half the lines each, the job after each, and the first once more."""
    paths = scratch_lake(spark)
    for load_id, lines in zip(("first", "second"), _in_steps(spark, sf_dir, 2)):
        _deliver(lines, paths.landed(load_id))
        run(spark, paths, load_id)
    run(spark, paths, "first")
    return read_gold_daily_metrics(spark, paths.gold_daily_metrics)


def _three_loads(spark: SparkSession, sf_dir: str) -> LakePaths:
    """Three loads that each span all days, then wrong lines for the second, and the right ones."""
    paths = scratch_lake(spark)
    steps = _in_steps(spark, sf_dir, 3)
    for load_id, lines in zip("abc", steps):
        _deliver(lines, paths.landed(load_id))
        run(spark, paths, load_id)
    _deliver(steps[0], paths.landed("b"), "overwrite")
    run(spark, paths, "b")
    _deliver(steps[1], paths.landed("b"), "overwrite")
    run(spark, paths, "b")
    return paths


def batch_three_loads_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics added up from three loads, one of them replaced."""
    paths = _three_loads(spark, sf_dir)
    return read_gold_daily_metrics(spark, paths.gold_daily_metrics)


def batch_three_loads_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawdowns and Sharpe ratios merged from three overlapping loads, one of them replaced."""
    paths = _three_loads(spark, sf_dir)
    risk = read_gold_daily_risk(spark, paths.gold_daily_risk)
    return risk.withColumn("sharpe", F.round("sharpe", 9))


def batch_merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by feed and verdict after nine loads that are merged by tiers, two of them replaced."""
    paths = scratch_lake(spark)
    for k, lines in enumerate(_in_steps(spark, sf_dir, 9)):
        _deliver(lines, paths.landed(f"load-{k}"))
        run_bronze(spark, paths, f"load-{k}")
        run_silver(spark, paths, f"load-{k}")
        compact_lake(spark, paths, fanout=3)
    for k in (0, 7):
        run_silver(spark, paths, f"load-{k}")
    orders = read_silver_orders(spark, paths.silver_orders).select(
        F.lit("orders").alias("feed"), F.lit("clean").alias("verdict")
    )
    account = read_silver_account(spark, paths.silver_account).select(
        F.lit("account").alias("feed"), F.lit("clean").alias("verdict")
    )
    rejected = read_quarantine(spark, paths.silver_orders, paths.silver_account).select(
        "feed", F.lit("quarantine").alias("verdict")
    )
    rows = orders.unionByName(account).unionByName(rejected)
    return rows.groupBy("feed", "verdict").agg(F.count("*").alias("row_count"))


def batch_late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled days with their late trades, after four loads and the first two once more."""
    paths = scratch_lake(spark)
    for k, lines in enumerate(_in_steps(spark, sf_dir, 4)):
        _deliver(lines, paths.landed(f"load-{k}"))
    for k in (0, 1, 2, 3, 0, 1):
        run_bronze(spark, paths, f"load-{k}")
        run_silver(spark, paths, f"load-{k}")
    days = settled_days(read_trade_days(spark, paths.trade_days))
    return days.select("day", "trades_count", "late_trades")


def batch_windows_and_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's window as it closed, and what came late to it, by four loads in another order."""
    paths = scratch_lake(spark)
    for k, lines in enumerate(_in_steps(spark, sf_dir, 4)):
        _deliver(lines, paths.landed(f"load-{k}"))
    for k in (2, 0, 3, 1, 0):
        run_bronze(spark, paths, f"load-{k}")
        run_silver(spark, paths, f"load-{k}")
    windows = window_metrics(read_trade_days(spark, paths.trade_days)).select(
        "day", F.col("trades_count").alias("in_window"), F.col("total_pnl").alias("window_pnl")
    )
    late = daily_metrics(read_late_trades(spark, paths.late_trades)).select(
        "day", F.col("trades_count").alias("late"), F.col("total_pnl").alias("late_pnl")
    )
    same = windows["day"].eqNullSafe(late["day"])
    return windows.join(late, same, "left").drop(late["day"])


def batch_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics where every line is delivered twice, in one load or in two."""
    paths = scratch_lake(spark)
    first, second = _in_steps(spark, sf_dir, 2)
    for load_id, lines in (("a", first.union(first)), ("b", first.union(second))):
        _deliver(lines, paths.landed(load_id))
        run(spark, paths, load_id, once=True)
    _deliver(second, paths.landed("c"))
    run(spark, paths, "c", once=True)
    return read_gold_daily_metrics(spark, paths.gold_daily_metrics)


def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that land where each is delivered twice, by two micro-batches."""
    paths = scratch_lake(spark)
    topic = f"{paths.root}/topic"
    for _ in range(2):
        _lines(spark, sf_dir).write.mode("append").text(topic)
        delivered = delivered_once(stream_landing(spark, topic, arrival=True))
        _finish(land(delivered, paths.landing, paths.checkpoint("landing")))
    return read_landing(spark, paths.landing).select(F.md5("value").alias("digest"))


def raw_json_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all lines as bronze and silver orders keep them."""
    paths = _landed(spark, sf_dir)
    run_bronze(spark, paths, _LOAD)
    run_silver(spark, paths, _LOAD)
    bronze = read_bronze(spark, paths.bronze)
    silver = read_silver_orders(spark, paths.silver_orders)

    def digests(rows: DataFrame, table: str) -> DataFrame:
        digest = F.md5("raw_json").alias("digest")
        return rows.groupBy(F.lit(table).alias("table"), digest).agg(F.count("*").alias("lines"))

    return digests(bronze, "bronze").unionByName(digests(silver, "orders"))


def silver_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums over the tables that hold each balance and position once."""
    paths = _landed(spark, sf_dir)
    run_bronze(spark, paths, _LOAD)
    run_silver(spark, paths, _LOAD)
    balances = read_balances(spark, paths.balances).agg(
        F.lit("balances").alias("element"),
        F.count("asset").alias("row_count"),
        F.sum("balance_change").alias("total"),
    )
    positions = read_positions(spark, paths.positions).agg(
        F.lit("positions").alias("element"),
        F.count("entry_price").alias("row_count"),
        F.sum("realized_pnl").alias("total"),
    )
    return balances.unionByName(positions)


def drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_max_drawdown(equity_points(account_events(_bronze(spark, sf_dir))))


def carried_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equity at every change, where an update lists changed balances and positions only."""
    equity = carried_equity(account_changes(account_events(_bronze(spark, sf_dir))))
    return equity.withColumn("at", F.col("at").cast("timestamp_ntz"))


def carried_drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawdowns of that curve."""
    equity = carried_equity(account_changes(account_events(_bronze(spark, sf_dir))))
    return daily_max_drawdown(equity.withColumn("equity", F.col("equity").cast("double")))


def sharpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Deviations are doubles, whose last digits depend on the order of merging.
    days = daily_sharpe(_trades(spark, sf_dir))
    return days.select("day", F.round("sharpe", 9).alias("sharpe"))


# Streams


def stream_landing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines carried over from one directory, standing in for the topic, to landing."""
    paths = scratch_lake(spark)
    topic = f"{paths.root}/topic"
    _lines(spark, sf_dir).write.text(topic)
    _finish(land(stream_landing(spark, topic), paths.landing, paths.checkpoint("landing")))
    return read_landing(spark, paths.landing).agg(F.count("*").alias("lines"))


def stream_bronze_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows by type; the second start of the stream finds nothing new."""
    paths = scratch_lake(spark)
    _lines(spark, sf_dir).write.text(paths.landing)
    for _ in range(2):
        _finish(bronze_stream(stream_landing(spark, paths.landing), paths))
    bronze = read_bronze(spark, paths.streamed_bronze)
    return bronze.groupBy("event_type").agg(F.count("*").alias("events"))


def _catch_up(spark: SparkSession, paths: LakePaths) -> None:
    _finish(bronze_stream(stream_landing(spark, paths.landing), paths))
    _finish(silver_orders_stream(stream_bronze(spark, paths), paths, "orders"))


def _streamed_orders(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = scratch_lake(spark)
    _lines(spark, sf_dir).write.text(paths.landing)
    _catch_up(spark, paths)
    return paths


def _streamed_silver(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = _streamed_orders(spark, sf_dir)
    _finish(silver_account_stream(stream_bronze(spark, paths), paths, "account"))
    return paths


def stream_silver_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_by_date(spark, _streamed_silver(spark, sf_dir))


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold trades built in batch from streamed bronze and silver."""
    paths = _streamed_silver(spark, sf_dir)
    run_gold(spark, paths)
    return read_gold_trades(spark, paths.gold_trades)


def stream_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that the stream of orders keeps up."""
    paths = _streamed_orders(spark, sf_dir)
    return read_gold_daily_metrics(spark, paths.gold_daily_metrics)


def stream_settled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are over by a day, after four steps that each span all days."""
    paths = scratch_lake(spark)
    for lines in _in_steps(spark, sf_dir, 4):
        lines.write.mode("append").text(paths.landing)
        _catch_up(spark, paths)
    return settled_days(read_trade_days(spark, paths.trade_days)).drop("late_trades")


QUERIES: dict[str, Query] = {
    "raw_line_count": raw_line_count,
    "bronze_envelope": bronze_envelope,
    "bronze_roundtrip_by_partition": bronze_roundtrip_by_partition,
    "route_by_event_type": route_by_event_type,
    "unrouted_by_type": unrouted_by_type,
    "silver_orders": _orders,
    "silver_account": _account,
    "clean_orders": clean_orders,
    "clean_account": clean_account,
    "quarantine_orders": quarantine_orders,
    "quarantine_account": quarantine_account,
    "split_is_partition": split_is_partition,
    "verdict_by_feed": verdict_by_feed,
    "account_balances_exploded": account_balances_exploded,
    "account_positions_exploded": account_positions_exploded,
    "account_cross_explode": account_cross_explode,
    "decimal_parse": decimal_parse,
    "silver_schema_version": silver_schema_version,
    "silver_roundtrip_by_date": silver_roundtrip_by_date,
    "quarantine_by_feed": quarantine_by_feed,
    "gold_trades": _trades,
    "daily_metrics": flagship,
    "gold_roundtrip": gold_roundtrip,
    "gold_trades_of_orders": gold_trades_of_orders,
    "end_to_end": end_to_end,
    "gold_sql_daily": gold_sql_daily,
    "gold_sql_symbols": gold_sql_symbols,
    "gold_sql_risk": gold_sql_risk,
    "batch_two_loads": batch_two_loads,
    "batch_three_loads_metrics": batch_three_loads_metrics,
    "batch_three_loads_risk": batch_three_loads_risk,
    "batch_merged_parts": batch_merged_parts,
    "batch_late_trades": batch_late_trades,
    "batch_windows_and_late": batch_windows_and_late,
    "batch_redelivered": batch_redelivered,
    "stream_redelivered": stream_redelivered,
    "raw_json_digests": raw_json_digests,
    "silver_elements": silver_elements,
    "daily_max_drawdown": drawdown,
    "carried_equity": carried_curve,
    "carried_drawdown": carried_drawdown,
    "daily_sharpe": sharpe,
    "stream_landing_count": stream_landing_count,
    "stream_bronze_count": stream_bronze_count,
    "stream_silver_split": stream_silver_split,
    "stream_gold": stream_gold,
    "stream_daily_metrics": stream_daily_metrics,
    "stream_settled_days": stream_settled_days,
}
