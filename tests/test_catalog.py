from events import account, order, raw

from ledgerlake.operators.account import account_events
from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.operators.metrics import daily_metrics
from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.risk import daily_risk, equity_points
from ledgerlake.operators.trades import closed_trades
from ledgerlake.plans.paths import LakePaths
from ledgerlake.schemas import GOLD_DAILY_METRICS, GOLD_DAILY_RISK, GOLD_TRADES
from ledgerlake.sources.catalog import register_gold
from ledgerlake.sources.tables import read_gold_daily_metrics, write_gold


def build(spark, paths, *pnls):
    lines = [order(i=at, rp=pnl) for at, pnl in enumerate(pnls)]
    trades = closed_trades(silver_orders(bronze_rows(raw(spark, lines))))
    points = equity_points(account_events(bronze_rows(raw(spark, [account()]))))
    write_gold(trades, paths.gold_trades, GOLD_TRADES)
    write_gold(daily_metrics(trades), paths.gold_daily_metrics, GOLD_DAILY_METRICS)
    write_gold(daily_risk(points, trades), paths.gold_daily_risk, GOLD_DAILY_RISK)


def test_external_tables_have_the_contract_schemas(spark, paths):
    build(spark, paths, "1")
    register_gold(spark, paths, "gold_contract")
    assert spark.table("gold_contract.trades").schema == GOLD_TRADES
    assert spark.table("gold_contract.daily_metrics").schema == GOLD_DAILY_METRICS
    assert spark.table("gold_contract.daily_risk").schema == GOLD_DAILY_RISK
    described = {
        row.col_name: row.data_type
        for row in spark.sql("DESCRIBE EXTENDED gold_contract.trades").collect()
    }
    assert described["Type"] == "EXTERNAL"


def test_tables_follow_rewrites_and_moves(spark, paths, tmp_path):
    def total():
        return spark.sql("SELECT sum(total_pnl) AS s FROM gold_moves.daily_metrics").first().s

    build(spark, paths, "1", "2")
    register_gold(spark, paths, "gold_moves")
    assert total() == 3
    build(spark, paths, "5")
    register_gold(spark, paths, "gold_moves")
    assert total() == 5
    other = LakePaths(paths.landing, str(tmp_path / "other"))
    build(spark, other, "7")
    register_gold(spark, other, "gold_moves")
    assert total() == 7


def test_quotes_in_a_path_and_another_schema(spark, tmp_path):
    paths = LakePaths("in", str(tmp_path / "it's a lake"))
    build(spark, paths, "3")
    spark.sql("CREATE DATABASE gold_quotes")
    spark.sql("CREATE TABLE gold_quotes.daily_metrics (day DATE, old INT) USING PARQUET")
    register_gold(spark, paths, "gold_quotes")
    assert spark.table("gold_quotes.daily_metrics").first().total_pnl == 3


def test_dropping_the_database_leaves_the_files(spark, paths):
    build(spark, paths, "3")
    register_gold(spark, paths, "gold_dropped")
    spark.sql("DROP DATABASE gold_dropped CASCADE")
    assert read_gold_daily_metrics(spark, paths.gold_daily_metrics).first().total_pnl == 3
