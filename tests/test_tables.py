from pathlib import Path

import pytest
from events import DAY, NOON, account, balance, order, position, raw, trading_days
from pyspark.sql import functions as F

from ledgerlake.operators.account import silver_account
from ledgerlake.operators.envelope import bronze_rows, of_type
from ledgerlake.operators.orders import silver_orders
from ledgerlake.plans.stages import run, run_bronze, run_silver
from ledgerlake.schemas import (
    ACCOUNT_REQUIRED,
    BRONZE,
    GOLD_TRADES,
    ORDER_REQUIRED,
    SILVER_ACCOUNT,
    SILVER_ORDERS,
)
from ledgerlake.sources.landing import read_landing
from ledgerlake.sources.storage import folders
from ledgerlake.sources.tables import (
    BY_DAY,
    compact,
    parts,
    read_balances,
    read_bronze,
    read_gold_daily_metrics,
    read_gold_daily_risk,
    read_gold_trades,
    read_positions,
    read_quarantine,
    read_silver_account,
    read_silver_orders,
    visible_loads,
    write_bronze,
    write_gold,
    write_silver,
)


def land(paths, *lines, name="part.jsonl", load_id="first"):
    folder = Path(paths.landed(load_id))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def column(df, name):
    return sorted((row[name] for row in df.collect()), key=str)


def test_landing_keeps_every_line_of_every_file(spark, paths):
    land(paths, order(i=1), "", "é", name="a.jsonl")
    land(paths, order(i=2), name="b.jsonl")
    assert column(read_landing(spark, paths.landed("first")), "value") == sorted(
        ["", "é", order(i=1), order(i=2)]
    )


def test_bronze_comes_back_as_written(spark, paths):
    lines = [order(), order(NOON + DAY), account(), "", "{", '{"e":"7","T":"x"}', '{"e":"8"}']
    write_bronze(bronze_rows(raw(spark, lines)), paths.bronze, "first")
    back = read_bronze(spark, paths.bronze)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert column(back, "raw_json") == sorted(lines)
    assert {row.event_type for row in back.collect()} == {
        "ORDER_TRADE_UPDATE",
        "ACCOUNT_UPDATE",
        "7",
        "8",
        None,
    }


def test_bronze_of_only_numeric_types_stays_text(spark, paths):
    write_bronze(bronze_rows(raw(spark, ['{"e":"7","T":1}'])), paths.bronze, "first")
    assert read_bronze(spark, paths.bronze).first().event_type == "7"


def test_dates_far_ahead_come_back(spark, paths):
    write_bronze(bronze_rows(raw(spark, [order(10**15), order(-(10**14))])), paths.bronze, "first")
    bronze = read_bronze(spark, paths.bronze)
    assert column(bronze.selectExpr("CAST(event_date AS STRING) AS day"), "day") == [
        "+33658-09-27",
        "-1199-02-15",
    ]


def test_a_load_of_bronze_is_replaced_and_loads_add_up(spark, paths):
    write_bronze(bronze_rows(raw(spark, [order(), account()])), paths.bronze, "first")
    write_bronze(bronze_rows(raw(spark, [order(NOON + DAY)])), paths.bronze, "first")
    write_bronze(bronze_rows(raw(spark, [account(), ""])), paths.bronze, "second")
    assert read_bronze(spark, paths.bronze).count() == 3
    assert read_bronze(spark, paths.bronze, "first").count() == 1


def test_empty_tables_read_as_empty(spark, paths):
    land(paths, "")
    assert run(spark, paths, "first") == {
        "orders": {"clean": 0, "quarantine": 0},
        "account": {"clean": 0, "quarantine": 0},
    }
    assert read_silver_orders(spark, paths.silver_orders).isEmpty()
    assert read_silver_account(spark, paths.silver_account).isEmpty()
    assert read_gold_trades(spark, paths.gold_trades).isEmpty()
    assert read_gold_daily_metrics(spark, paths.gold_daily_metrics).isEmpty()
    assert read_quarantine(spark, paths.silver_orders, paths.silver_account).isEmpty()


def test_silver_holds_clean_rows_and_quarantine_the_rest(spark, paths):
    land(
        paths,
        order(i=1),
        order(i=2, s=None),
        order(i=3, envelope={"T": "abc"}),
        order(i=4, envelope={"T": "177"}),
        account(balances=[balance("A"), balance("B")], positions=[]),
        account(positions=[position("X")]),
        '{"e":"MARGIN_CALL","T":1}',
        "",
    )
    run_bronze(spark, paths, "first")
    assert run_silver(spark, paths, "first") == {
        "orders": {"clean": 1, "quarantine": 3},
        "account": {"clean": 1, "quarantine": 2},
    }
    orders = read_silver_orders(spark, paths.silver_orders)
    assert [(f.name, f.dataType) for f in orders.schema] == [
        (f.name, f.dataType) for f in SILVER_ORDERS
    ]
    assert column(orders, "order_id") == [1]
    balances = read_silver_account(spark, paths.silver_account)
    assert [(f.name, f.dataType) for f in balances.schema] == [
        (f.name, f.dataType) for f in SILVER_ACCOUNT
    ]
    assert column(balances, "symbol") == ["X"]


def test_quarantine_keeps_the_columns_of_both_feeds(spark, paths):
    land(paths, order(i=2, s=None), account(balances=[balance("A")], positions=[]))
    run_bronze(spark, paths, "first")
    run_silver(spark, paths, "first")
    quarantine = read_quarantine(spark, paths.silver_orders, paths.silver_account)
    rows = {row.feed: row for row in quarantine.collect()}
    assert rows["orders"].order_id == 2
    assert rows["orders"].asset is None
    assert rows["account"].asset == "A"
    assert rows["account"].order_id is None
    assert {*SILVER_ORDERS.names, *SILVER_ACCOUNT.names} <= set(quarantine.columns)


def test_writing_a_load_again_replaces_it_and_other_loads_add_up(spark, paths):
    def load(load_id, *lines):
        write_silver(
            silver_orders(bronze_rows(raw(spark, lines))),
            ORDER_REQUIRED,
            paths.silver_orders,
            load_id,
        )

    load("monday", order(i=1), order(i=2, s=None), order(NOON + DAY, i=3))
    load("monday", order(i=1), order(i=2, s=None), order(NOON + DAY, i=3))
    load("tuesday", order(i=4))
    assert column(read_silver_orders(spark, paths.silver_orders), "order_id") == [1, 3, 4]
    # A corrected load leaves neither old days nor old quarantined rows behind.
    load("monday", order(i=1), order(i=2))
    assert column(read_silver_orders(spark, paths.silver_orders), "order_id") == [1, 2, 4]
    no_account = silver_account(bronze_rows(raw(spark, [])))
    write_silver(no_account, ACCOUNT_REQUIRED, paths.silver_account, "monday")
    quarantine = read_quarantine(spark, paths.silver_orders, paths.silver_account)
    assert quarantine.isEmpty()


@pytest.mark.parametrize("load_id", ["", "..", "a/b", "a=b", "_tmp", ".hidden"])
def test_load_ids_are_plain_directory_names(spark, paths, load_id):
    df = silver_orders(bronze_rows(raw(spark, [order()])))
    with pytest.raises(ValueError, match="directory name"):
        write_silver(df, ORDER_REQUIRED, paths.silver_orders, load_id)


def test_clean_and_quarantined_rows_of_a_load_share_their_processing_time(spark, paths):
    land(paths, order(i=1), order(i=2, s=None))
    run_bronze(spark, paths, "first")
    run_silver(spark, paths, "first")
    clean = read_silver_orders(spark, paths.silver_orders).first()
    quarantine = read_quarantine(spark, paths.silver_orders, paths.silver_account).first()
    assert clean.processing_time == quarantine.processing_time


def test_whole_run(spark, paths):
    land(paths, *trading_days())
    for _ in range(2):
        assert run(spark, paths, "first", schema_version=3) == {
            "orders": {"clean": 10, "quarantine": 0},
            "account": {"clean": 4, "quarantine": 0},
        }
        assert of_type(read_bronze(spark, paths.bronze), "ACCOUNT_UPDATE").count() == 4
        assert read_gold_trades(spark, paths.gold_trades).count() == 5
        days = read_gold_daily_metrics(spark, paths.gold_daily_metrics).collect()
        assert sorted((row.day.day, row.trades_count, row.win_rate) for row in days) == [
            (17, 1, 1.0),
            (18, 2, 0.5),
            (19, 2, 0.0),
        ]
        risk = read_gold_daily_risk(spark, paths.gold_daily_risk).collect()
        assert sorted((x.day.day, x.max_drawdown, x.running_drawdown) for x in risk) == [
            (17, 0.0, 0.0),
            (18, 0.0, 0.0),
            (19, 0.0, 0.25),
        ]
    assert read_silver_orders(spark, paths.silver_orders).first().schema_version == 3
    assert read_balances(spark, paths.balances).count() == 4
    assert read_positions(spark, paths.positions).count() == 4


def test_each_load_counts_once_though_all_lines_stay_landed(spark, paths):
    def days():
        found = read_gold_daily_metrics(spark, paths.gold_daily_metrics).collect()
        return {row.day.day: (row.trades_count, row.total_pnl) for row in found}

    land(paths, order(rp="1"), load_id="2025-03-17")
    run(spark, paths, "2025-03-17")
    assert days() == {17: (1, 1)}
    land(paths, order(NOON + DAY, rp="2"), load_id="2025-03-18")
    run(spark, paths, "2025-03-18")
    both = {17: (1, 1), 18: (1, 2)}
    assert days() == both
    for again in ("2025-03-17", "2025-03-18"):
        run(spark, paths, again)
        assert days() == both
    # A corrected day replaces itself alone.
    land(paths, order(rp="5"), load_id="2025-03-17")
    run(spark, paths, "2025-03-17")
    assert days() == {17: (1, 5), 18: (1, 2)}


def test_gold_that_does_not_fit_its_contract_is_not_written(spark, paths):
    land(paths, *trading_days())
    run(spark, paths, "first")
    trades = read_gold_trades(spark, paths.gold_trades)
    with pytest.raises(ValueError, match="is not"):
        write_gold(trades.withColumnRenamed("price", "prize"), paths.gold_trades, GOLD_TRADES)
    assert read_gold_trades(spark, paths.gold_trades).count() == 5


def test_a_failed_write_of_gold_leaves_the_old_table(spark, paths):
    land(paths, *trading_days())
    run(spark, paths, "first")
    trades = read_gold_trades(spark, paths.gold_trades)
    broken = trades.withColumn("symbol", F.raise_error(F.lit("halfway")).cast("string"))
    with pytest.raises(Exception, match="halfway"):
        write_gold(broken, paths.gold_trades, GOLD_TRADES)
    assert trades.count() == 5
    assert read_gold_trades(spark, paths.gold_trades).count() == 5
    write_gold(trades.limit(1), paths.gold_trades, GOLD_TRADES)
    write_gold(trades.limit(1), paths.gold_trades, GOLD_TRADES)
    assert read_gold_trades(spark, paths.gold_trades).count() == 1
    assert len(folders(spark, paths.gold_trades)) == 2


def numbered(spark, paths, numbers):
    for n in numbers:
        rows = silver_orders(bronze_rows(raw(spark, [order(i=n), order(i=100 + n, s=None)])))
        write_silver(rows, ORDER_REQUIRED, paths.silver_orders, f"feed-{n}")


def test_compaction_keeps_rows_and_bounds_folders(spark, paths):
    def content():
        quarantine = read_quarantine(spark, paths.silver_orders, paths.silver_account)
        orders = read_silver_orders(spark, paths.silver_orders)
        return column(orders, "order_id"), column(quarantine, "order_id")

    def tidy(grace=0.0):
        compact(spark, paths.silver_orders, SILVER_ORDERS, BY_DAY, fanout=4, grace=grace)

    write_silver(
        silver_orders(bronze_rows(raw(spark, [order(i=77)]))),
        ORDER_REQUIRED,
        paths.silver_orders,
        "by-hand",
    )
    numbered(spark, paths, range(6))
    before = content()
    tidy(grace=900)
    assert content() == before
    assert len(parts(spark, paths.silver_orders)) == 1
    assert visible_loads(spark, paths.silver_orders) == ["by-hand", *(f"feed-{n}" for n in range(6))]
    # The replaced folders stay for a while; a replay of a merged load is safe.
    assert len(folders(spark, paths.silver_orders)) == 8
    numbered(spark, paths, [5, 6, 7])
    tidy()
    assert content()[0] == [*range(8), 77]
    assert len(parts(spark, paths.silver_orders)) == 4
    assert len(folders(spark, paths.silver_orders)) == 4


def test_a_compaction_that_did_not_finish_counts_for_nothing(spark, paths):
    numbered(spark, paths, range(3))
    half = Path(paths.silver_orders) / "load_id=_merged~0123456789ab"
    half.mkdir()
    assert column(read_silver_orders(spark, paths.silver_orders), "order_id") == [0, 1, 2]
    assert len(parts(spark, paths.silver_orders)) == 3
