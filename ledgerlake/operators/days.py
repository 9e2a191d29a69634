"""Sums of trades by day that add up over loads, and what becomes of them.

Second moments are exact sums of whole numbers. An amount, in units of its last digit, is
``high * 10**9 + low`` with low from 0 to 10**9 - 1, so that each product of two of those fits 64
bits and sums of them 38 digits, whatever loads they are split into. The spread about the
mean comes from them without the cancellation that a small spread around a large mean causes.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import TRADE_DAYS

_TOTAL = "decimal(28,8)"
_WHOLE = "decimal(38,0)"
_LIMB = 10**9
_UNITS = 10**8


def _day() -> Column:
    return F.to_date("trade_time").alias("day")


def _over(lateness: str) -> Column:
    """When a day is over by ``lateness``, such as ``1 day``, in the session's time zone."""
    return F.date_add("day", 1).cast("timestamp") + F.expr(f"INTERVAL {lateness}")


def _limbs(units: Column) -> tuple[Column, Column]:
    """High and low part of a whole number."""
    low = F.pmod(units, F.lit(_LIMB).cast("long"))
    return ((units - low) / _LIMB).cast("long"), low


def trade_day_sums(
    trades: DataFrame, newest: Column | datetime | None = None, lateness: str = "1 day"
) -> DataFrame:
    """Counts and sums of one load's trades by day; all combine map-side.

    ``late`` counts the trades of days that were already over by ``lateness`` when the
    newest trade of all earlier loads, at ``newest``, had come.
    """
    pnl = F.col("realized_pnl")
    late = (newest if isinstance(newest, Column) else F.lit(newest)) >= _over(lateness)
    # Below 2**60, so exact; the quotient by 10**9 is below 2**31 and exact as a double.
    high, low = _limbs((pnl * F.lit(_UNITS)).cast("long"))

    def total(product: Column) -> Column:
        return F.try_sum(product.cast("decimal(28,0)"))

    return (
        trades.withColumns({"high": high, "low": low})
        .groupBy(_day())
        .agg(
            F.count("*").alias("trades"),
            F.count(pnl).alias("known"),
            F.try_sum(pnl).alias("total"),
            F.count_if(pnl > 0).alias("wins"),
            F.try_sum(F.when(pnl > 0, pnl)).alias("win_total"),
            F.count_if(pnl < 0).alias("losses"),
            F.try_sum(F.when(pnl < 0, pnl)).alias("loss_total"),
            F.max("trade_time").alias("newest"),
            total(F.col("high")).alias("high_sum"),
            total(F.col("high") * F.col("high")).alias("high_squares"),
            total(F.col("high") * F.col("low")).alias("high_lows"),
            total(F.col("low") * F.col("low")).alias("low_squares"),
        )
        .withColumn("late", F.when(late, F.col("trades")).otherwise(F.lit(0).cast("long")))
        .select(*TRADE_DAYS.names)
    )


def late_trades(trades: DataFrame, newest: Column, lateness: str = "1 day") -> DataFrame:
    """The trades that :func:`trade_day_sums` counts as late."""
    return trades.withColumn("day", _day()).where(newest >= _over(lateness)).drop("day")


def window_metrics(sums: DataFrame) -> DataFrame:
    """Daily metrics without late trades: what each day's window held when it closed."""
    return metrics_of_sums(sums.where("late = 0"))


def added_sums(sums: DataFrame) -> DataFrame:
    """Sums of several loads as one row a day."""
    counts = ("trades", "known", "wins", "losses", "late")
    moments = ("high_sum", "high_squares", "high_lows", "low_squares")
    totals = {"total": "known", "win_total": "wins", "loss_total": "losses"}
    added = sums.groupBy("day").agg(
        *(F.sum(x).alias(x) for x in counts),
        *(_sum(total, count).alias(total) for total, count in totals.items()),
        *(F.try_sum(x).alias(x) for x in moments),
        F.max("newest").alias("newest"),
    )
    return added.select(*TRADE_DAYS.names)


def _sum(total: str, count: str) -> Column:
    """The sum over loads; NULL without values, and if a part or the whole is too large."""
    broken = F.count_if(F.col(total).isNull() & (F.col(count) > 0)) > 0
    return F.when(~broken, F.try_sum(total).try_cast(_TOTAL))


def metrics_of_sums(sums: DataFrame) -> DataFrame:
    """The daily metrics from sums of any number of loads, equal to those from the trades."""

    def average(total: str, count: str) -> Column:
        return F.try_divide(_sum(total, count), F.sum(count).cast("decimal(20,0)")).try_cast(
            "decimal(22,12)"
        )

    return sums.groupBy("day").agg(
        _sum("total", "known").alias("total_pnl"),
        F.sum("trades").alias("trades_count"),
        (F.sum("wins") / F.sum("trades")).alias("win_rate"),
        average("win_total", "wins").alias("avg_win"),
        average("loss_total", "losses").alias("avg_loss"),
    )


def settled_days(sums: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily metrics of the days that are over by ``lateness`` before the newest trade.

    ``late_trades`` of them came when their day was already over; they count all the same,
    so nothing is lost, whatever order trades come in. Trades without a time belong to no day.
    """
    newest = sums.agg(F.max("newest").alias("newest"))
    late = sums.groupBy("day").agg(F.sum("late").alias("late_trades"))
    metrics = metrics_of_sums(sums.where("day IS NOT NULL")).join(late, "day")
    # One row: the newest of all trades.
    return metrics.join(F.broadcast(newest), F.col("newest") >= _over(lateness)).drop("newest")


def sharpe_of_sums(
    sums: DataFrame, risk_free: float = 0.0, periods: float = 1.0
) -> DataFrame:
    """The Sharpe ratio by day from sums of any number of loads.

    Squares about a whole number near the mean are exact, in limbs and then as one number of 38
    digits; where that is too small, which takes a spread of more than 10**9, in doubles.
    """

    def minus(a: Column, *rest: Column) -> Column:
        for each in rest:
            a = F.try_subtract(a, each).try_cast(_WHOLE)
        return a

    def times(*factors: Column) -> Column:
        out = factors[0].cast(_WHOLE)
        for each in factors[1:]:
            out = F.try_multiply(out, each.cast("decimal(19,0)")).try_cast(_WHOLE)
        return out

    def plus(a: Column, b: Column) -> Column:
        return F.try_add(a, b).try_cast(_WHOLE)

    n, high = F.col("known"), F.col("high_sum")
    days = added_sums(sums)
    days = days.withColumn(
        "units", F.try_multiply("total", F.lit(_UNITS).cast("decimal(9,0)")).try_cast(_WHOLE)
    )
    mean = F.round(F.try_divide("units", n.cast("decimal(20,0)"))).try_cast("long")
    days = days.withColumn("near", mean)
    near_high, near_low = _limbs(F.col("near"))
    days = days.withColumns({"near_high": near_high, "near_low": near_low})
    a, b = F.col("near_high"), F.col("near_low")
    low = minus(F.col("units"), times(high, F.lit(_LIMB)))
    highs = plus(minus(F.col("high_squares"), times(high, a * 2)), times(n, a * a))
    mixed = plus(
        minus(F.col("high_lows"), times(high, b), times(low, a)), times(n, a * b)
    )
    lows = plus(minus(F.col("low_squares"), times(low, b * 2)), times(n, b * b))
    days = days.withColumns({"highs": highs, "mixed": mixed, "lows": lows})
    exact = plus(
        plus(
            times(F.col("highs"), F.lit(_LIMB), F.lit(_LIMB)),
            times(F.col("mixed"), F.lit(2 * _LIMB)),
        ),
        F.col("lows"),
    )
    rough = (
        F.col("highs").cast("double") * float(_LIMB) ** 2
        + F.col("mixed").cast("double") * 2.0 * _LIMB
        + F.col("lows").cast("double")
    )
    off = minus(F.col("units"), times(n, F.col("near"))).cast("double")
    squares = F.coalesce(exact.cast("double"), rough) - off * off / n
    deviation = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.when(n > 1, n - 1)) / float(_UNITS)
    excess = F.try_divide("total", n.cast("decimal(20,0)")).cast("double") - risk_free
    ratio = F.try_divide(excess, deviation) * periods**0.5
    return days.select("day", ratio.alias("sharpe"))
