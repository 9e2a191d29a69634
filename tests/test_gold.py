from datetime import date
from decimal import Decimal

import pytest
from events import DAY, NOON, order, raw, trading_days

from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.operators.metrics import daily_metrics
from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.risk import daily_sharpe
from ledgerlake.operators.trades import closed_trades
from ledgerlake.schemas import GOLD_DAILY_METRICS, GOLD_TRADES


def trades(spark, *lines):
    return closed_trades(silver_orders(bronze_rows(raw(spark, lines))))


def metrics(spark, *lines):
    return {row.day: row for row in daily_metrics(trades(spark, *lines)).collect()}


def test_gold_matches_its_contracts(spark):
    table = trades(spark, order())
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in GOLD_TRADES
    ]
    assert [(f.name, f.dataType) for f in daily_metrics(table).schema] == [
        (f.name, f.dataType) for f in GOLD_DAILY_METRICS
    ]


def test_only_filled_sells_are_trades(spark):
    table = trades(
        spark,
        order(i=1),
        order(i=2, S="BUY"),
        order(i=3, X="PARTIALLY_FILLED"),
        order(i=4, S=None),
        order(i=5, X=None),
    )
    assert [row.order_id for row in table.collect()] == [1]


def test_price_of_a_trade_is_the_average_price(spark):
    assert trades(spark, order(p="1", ap="2")).first().price == 2


def test_three_days_with_wins_and_losses(spark):
    found = metrics(spark, *trading_days())
    rows = {
        day.day: (row.total_pnl, row.trades_count, row.win_rate, row.avg_win, row.avg_loss)
        for day, row in found.items()
    }
    assert rows == {
        17: (Decimal("7.25"), 1, 1.0, Decimal("7.25"), None),
        18: (Decimal("-1.5"), 2, 0.5, Decimal("1.6"), Decimal("-3.1")),
        19: (Decimal("-0.75"), 2, 0.0, None, Decimal("-0.75")),
    }


def test_zero_and_missing_pnl_count_as_trades_only(spark):
    row = metrics(spark, order(rp="3"), order(rp="-1"), order(rp="0"), order(rp=None))[
        date(2025, 3, 17)
    ]
    assert (row.trades_count, row.win_rate) == (4, 0.25)
    assert (row.total_pnl, row.avg_win, row.avg_loss) == (2, 3, -1)


def test_no_known_pnl_gives_no_total(spark):
    row = metrics(spark, order(rp=None))[date(2025, 3, 17)]
    assert (row.total_pnl, row.trades_count, row.win_rate) == (None, 1, 0.0)


def test_commission_is_not_subtracted(spark):
    assert metrics(spark, order(rp="1", n="5"))[date(2025, 3, 17)].total_pnl == 1


def test_days_follow_the_trade_time(spark):
    found = metrics(spark, order(T=NOON + DAY), order(T=None))
    assert set(found) == {date(2025, 3, 18), None}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_follow_the_session_time_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = metrics(spark, order(T=NOON - DAY // 2 + 1000))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(found) == {date(2025, 3, 17 if zone == "UTC" else 16)}


def test_sums_beyond_their_type_become_null(spark):
    largest = "9" * 10 + "." + "9" * 8
    many = spark.range(11 * 10**4).selectExpr(
        f"CAST('{largest}' AS DECIMAL(18,8)) AS realized_pnl", "TIMESTAMP'2025-03-17' AS trade_time"
    )
    assert daily_metrics(many).first().trades_count == 11 * 10**4
    assert daily_sharpe(many).first().sharpe is None
