"""Equity from account updates that list only what changed.

An asset keeps its last wallet balance and a position its last unrealized PnL until an update
names it again; equity is the sum of all that was known last. So each change adds the difference
to the amount before it, and equity is the running sum of those differences.

No window spans an account's history. What went before is carried in steps: from change to
change within a minute of one asset or position (at most 60,000 instants), from minute to minute
within its day by the last amounts (1,440), and from day to day by the last amounts of days. The
running sum takes the same steps. Differences of a period's first change are completed by
corrections, rows of their own, so that nothing is joined to find the amount before.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlake.functions.times import timestamp_of

_AMOUNT = "decimal(28,8)"
_KEY = ("kind", "name")


def account_changes(events: DataFrame) -> DataFrame:
    """What account updates say: (at, kind, name, amount), each balance and position once.

    A position is named by its symbol and side. A missing name is a name of its own; amounts that
    are NULL say nothing.
    """
    timed = events.select(
        F.date_trunc("millisecond", timestamp_of(F.col("event_received_time"))).alias("at"), "body"
    )

    def of(array: str, kind: str, name: Column, amount: str) -> DataFrame:
        each = timed.select("at", F.explode(f"body.{array}").alias("x"))
        return each.select(
            "at", F.lit(kind).alias("kind"), name.alias("name"), F.col(f"x.{amount}").alias("amount")
        )

    def text(field: str) -> Column:
        return F.coalesce(F.col(f"x.{field}"), F.lit(""))

    position = F.concat(text("symbol"), F.lit("/"), text("position_side"))
    changes = of("balances", "asset", text("asset"), "wallet_balance").unionByName(
        of("positions", "position", position, "unrealized_pnl")
    )
    return changes.dropna(subset=["at", "amount"])


def carried_equity(changes: DataFrame) -> DataFrame:
    """(at, equity) at every instant at which something changed, as a decimal.

    Several amounts of one name at one instant have no order; the largest of them counts.
    """
    once = changes.groupBy(F.date_trunc("minute", "at").alias("minute"), "at", *_KEY).agg(
        F.max("amount").cast(_AMOUNT).alias("amount")
    )
    # Per name: differences within minutes, then last amounts carried over minutes and days.
    before = F.lag("amount").over(Window.partitionBy(*_KEY, "minute").orderBy("at"))
    steps = once.select(
        "minute", "at", (F.col("amount") - F.coalesce(before, F.lit(0).cast(_AMOUNT))).alias("delta")
    )
    minutes = once.groupBy(*_KEY, "minute").agg(
        F.min("at").alias("at"), F.max_by("amount", "at").alias("last")
    )
    minutes = minutes.withColumn("day", F.to_date("minute"))
    by_day = Window.partitionBy(*_KEY, "day").orderBy("minute")
    days = minutes.groupBy(*_KEY, "day").agg(
        F.min_by("at", "minute").alias("at"),
        F.min("minute").alias("minute"),
        F.max_by("last", "minute").alias("last"),
    )
    carried = [
        minutes.withColumn("before", F.lag("last").over(by_day)),
        days.withColumn("before", F.lag("last").over(Window.partitionBy(*_KEY).orderBy("day"))),
    ]
    for rows in carried:
        corrections = rows.where("before IS NOT NULL").select(
            "minute", "at", (-F.col("before")).alias("delta")
        )
        steps = steps.union(corrections)
    return _running(steps.groupBy("minute", "at").agg(_total("delta").alias("delta")))


def _total(name: str) -> Column:
    # Without the cast, sums of sums would lose digits after the point to those before it.
    return F.try_sum(name).try_cast(_AMOUNT)


def _running(deltas: DataFrame) -> DataFrame:
    """Running sums over minutes, days, and all days, each from the totals of what is below."""

    def earlier(window: WindowSpec) -> Column:
        total = F.try_sum("total").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total.try_cast(_AMOUNT), F.lit(0).cast(_AMOUNT))

    minutes = deltas.groupBy("minute").agg(_total("delta").alias("total"))
    minutes = minutes.withColumn("day", F.to_date("minute"))
    days = minutes.groupBy("day").agg(_total("total").alias("total"))
    # A row a day, as in the drawdown.
    days = days.select("day", earlier(Window.orderBy("day")).alias("of_days"))
    minutes = minutes.withColumn(
        "of_minutes", earlier(Window.partitionBy("day").orderBy("minute"))
    ).join(days, "day")
    upto = Window.partitionBy("minute").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = F.try_sum("delta").over(upto).try_cast(_AMOUNT)
    equity = F.col("inside") + F.col("of_minutes") + F.col("of_days")
    return (
        deltas.withColumn("inside", inside)
        .join(minutes.select("minute", "of_minutes", "of_days"), "minute")
        .select("at", equity.try_cast(_AMOUNT).alias("equity"))
    )
