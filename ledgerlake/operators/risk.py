"""Drawdown of the equity curve and Sharpe ratio of the trades, per day."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.times import timestamp_of


def equity_points(events: DataFrame) -> DataFrame:
    """Account equity at each account update: all wallet balances plus unrealized PnL.

    Each update counts as a snapshot of the whole account. It is taken before the arrays
    are exploded, so nothing is counted twice. An update without any balance says
    nothing about equity, which is then NULL.
    """
    equity = _total("balances", "wallet_balance") + F.coalesce(
        _total("positions", "unrealized_pnl"), F.lit(0)
    )
    return events.select(
        timestamp_of(F.col("event_received_time")).alias("at"),
        equity.cast("double").alias("equity"),
    )


def _total(array: str, field: str) -> Column:
    """Sum of one field over an event's array; NULL when no element has a value."""
    amounts = F.filter(
        F.transform(f"body.{array}", lambda item: item[field].cast("decimal(28,8)")),
        lambda amount: amount.isNotNull(),
    )
    total = F.aggregate(
        amounts,
        F.lit(0).cast("decimal(28,8)"),
        lambda acc, amount: (acc + amount).cast("decimal(28,8)"),
    )
    return F.when(F.size(amounts) > 0, total)


def daily_max_drawdown(points: DataFrame) -> DataFrame:
    """Largest fall from a running peak, as a fraction of that peak, by day.

    ``max_drawdown`` is the fall within the day, from the day's own peak;
    ``running_drawdown`` the fall on that day from the highest peak of the whole curve up to
    then, so that a fall over night shows. The largest of it is the curve's drawdown.

    Points of one instant are taken in ascending order of equity, which makes the result
    independent of row order. Equity at or below zero after a positive peak is a full
    loss, 1.0; without a positive peak there is NULL. Points without a time or without
    equity have no place on the curve and are left out.

    No day is ever sorted in one task. Times are cut to milliseconds, so after the first,
    map-side combined aggregation a minute has at most 60,000 rows and a day at most
    1,440 minutes, however many updates arrived; the peaks of earlier days are carried over
    one row a day. These are the largest groups a window sees.
    """
    return daily_drawdowns(minute_summaries(equity_instants(points)))


def equity_instants(points: DataFrame) -> DataFrame:
    """Least and greatest equity of each millisecond; those of several loads combine."""
    instant = F.date_trunc("millisecond", "at")
    return (
        points.groupBy(F.date_trunc("minute", "at").alias("minute"), instant.alias("at"))
        .agg(F.min("equity").alias("low"), F.max("equity").alias("high"))
        .dropna()
    )


def minute_summaries(instants: DataFrame) -> DataFrame:
    """Largest fall within each minute, and its least and greatest equity."""
    earlier = Window.partitionBy("minute").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        instants.withColumn("peak", F.greatest(F.max("high").over(earlier), "low"))
        .groupBy("minute")
        .agg(
            F.max(_fall("low", "peak")).alias("fall"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )


def merged_minutes(minutes: DataFrame, instants: DataFrame) -> DataFrame:
    """The minutes of one curve from those of several loads.

    Falls within a minute of one load are known. A minute that several loads have points of
    depends on their order, and is summed up anew from its instants, which are read for such
    minutes alone.
    """
    counted = minutes.groupBy("minute").agg(
        F.count("*").alias("loads"),
        *(F.first(x).alias(x) for x in ("fall", "low", "high")),
    )
    shared = counted.where("loads > 1").select("minute", F.to_date("minute").alias("day"))
    again = (
        instants.join(shared, ["minute", "day"], "left_semi")
        .groupBy("minute", "at")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    alone = counted.where("loads = 1").drop("loads")
    return alone.unionByName(minute_summaries(again))


def daily_drawdowns(minutes: DataFrame) -> DataFrame:
    """The drawdowns of :func:`daily_max_drawdown` from summaries of minutes."""
    minutes = minutes.withColumn("day", F.to_date("minute"))
    earlier = Window.partitionBy("day").orderBy("minute").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A fall from the larger of two peaks is the larger of the two falls, so a minute's
    # lowest equity against the peak of earlier minutes completes its own largest fall, and
    # likewise a day's against the peak of earlier days.
    days = (
        minutes.withColumn("peak", F.max("high").over(earlier))
        .groupBy("day")
        .agg(
            F.max(F.greatest("fall", _fall("low", "peak"))).alias("max_drawdown"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn("peak", F.max("high").over(before)).select(
        "day",
        "max_drawdown",
        F.greatest("max_drawdown", _fall("low", "peak")).alias("running_drawdown"),
    )


def daily_risk(points: DataFrame, trades: DataFrame) -> DataFrame:
    """Drawdowns and Sharpe ratio of every day that has an equity or a trade."""
    return joined_risk(daily_max_drawdown(points), daily_sharpe(trades))


def joined_risk(drawdowns: DataFrame, sharpes: DataFrame) -> DataFrame:
    """Drawdowns and Sharpe ratios as one table; the ratio of no day is left out."""
    risk = drawdowns.join(sharpes.dropna(subset="day"), "day", "full")
    return risk.select("day", "max_drawdown", "running_drawdown", "sharpe")


def _fall(low: str, peak: str) -> Column:
    fall = 1 - F.greatest(F.col(low), F.lit(0.0)) / F.col(peak)
    return F.when(F.col(peak) > 0, F.greatest(fall, F.lit(0.0)))


def daily_sharpe(
    trades: DataFrame, risk_free: float = 0.0, periods: float = 1.0
) -> DataFrame:
    """Mean excess PnL per trade over its sample deviation, times the root of ``periods``.

    ``risk_free`` is the PnL per trade to beat and ``periods`` the annualization factor;
    the defaults give the plain ratio. NULL with fewer than two trades or no spread.
    """
    pnl = F.col("realized_pnl")
    excess = F.try_avg(pnl).cast("double") - risk_free
    ratio = F.try_divide(excess, F.stddev_samp(pnl)) * periods**0.5
    return trades.groupBy(F.to_date("trade_time").alias("day")).agg(ratio.alias("sharpe"))
