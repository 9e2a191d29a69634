"""Daily profit metrics over gold trades."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profit_metrics() -> list[Column]:
    """Aggregates of one group of trades.

    ``win_rate`` is a fraction of all trades; a zero or NULL PnL is neither win nor loss.
    All of them combine map-side, so a day holding most of the trades costs no more
    shuffle than any other. A sum too large for its type is NULL under either ANSI
    setting instead of failing the job.
    """
    pnl = F.col("realized_pnl")
    return [
        F.try_sum(pnl).alias("total_pnl"),
        F.count("*").alias("trades_count"),
        (F.count_if(pnl > 0) / F.count("*")).alias("win_rate"),
        F.try_avg(F.when(pnl > 0, pnl)).alias("avg_win"),
        F.try_avg(F.when(pnl < 0, pnl)).alias("avg_loss"),
    ]


def daily_metrics(trades: DataFrame) -> DataFrame:
    """One row per trade day; trades without a time form the NULL day."""
    return trades.groupBy(F.to_date("trade_time").alias("day")).agg(*profit_metrics())
