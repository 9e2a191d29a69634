"""Plans stay the ones we want: one parse per line, pruned scans, bounded shuffles."""

import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from events import account, order, raw, trading_days

from ledgerlake.operators.account import account_events, silver_account
from ledgerlake.operators.days import metrics_of_sums
from ledgerlake.operators.envelope import bronze_rows, first_deliveries, line_digests, of_type
from ledgerlake.operators.metrics import daily_metrics
from ledgerlake.operators.orders import silver_orders
from ledgerlake.operators.quality import clean_rows, split
from ledgerlake.operators.risk import daily_max_drawdown, equity_points
from ledgerlake.operators.trades import closed_trades, trades_of_bronze, trades_of_orders
from ledgerlake.plans.stages import add_orders, clustered
from ledgerlake.schemas import ACCOUNT_REQUIRED, GOLD_TRADES, ORDER_REQUIRED, TRADE_BLOOMS
from ledgerlake.sources.tables import (
    Load,
    read_bronze,
    read_gold_trades,
    read_silver_orders,
    read_trade_days,
    write_bronze,
    write_gold,
    write_silver,
)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, df) -> int:
    return len(re.findall(pattern, physical(df)))


@pytest.fixture
def bronze(spark, paths):
    write_bronze(bronze_rows(raw(spark, [*trading_days(), order(s=None), "", "{"])), paths.bronze, "first")
    return read_bronze(spark, paths.bronze)


def test_a_line_is_parsed_once_however_it_is_filtered(bronze):
    for side in split(silver_orders(bronze), ORDER_REQUIRED):
        assert count("from_json", side) == 1
    for side in split(silver_account(bronze), ACCOUNT_REQUIRED):
        assert count("from_json", side) == 1
    assert count("from_json", daily_metrics(closed_trades(silver_orders(bronze)))) == 1


def test_trades_of_bronze_convert_nine_fields(spark, bronze):
    found = trades_of_bronze(bronze)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = physical(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall("from_json", plan)) == 1
    body = re.search(r"from_json\(.*?StructField\(o,StructType\((.*?)\),true\)\)", plan)
    fields = re.findall(r"StructField\((\w+),", body.group(1))
    assert fields == ["s", "S", "o", "q", "ap", "X", "i", "T", "rp"]
    slow = closed_trades(clean_rows(silver_orders(bronze), ORDER_REQUIRED))
    assert found.count() > 0
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, slow.collect()))


def test_unknown_fields_are_refused(bronze):
    with pytest.raises(ValueError, match="colour"):
        silver_orders(bronze, only=("colour",))


def test_the_envelope_is_one_pass_over_a_line(spark):
    rows = bronze_rows(raw(spark, [order()]))
    assert count("json_tuple", rows) == 1
    assert count("get_json_object|from_json", rows) == 0


def test_routing_prunes_partitions(bronze):
    plan = physical(of_type(bronze, "ORDER_TRADE_UPDATE"))
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "event_type" in pruned and "ORDER_TRADE_UPDATE" in pruned


def test_lines_are_shuffled_once_to_leave_out_repetitions(spark, bronze):
    known = line_digests(bronze)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # One shuffle of the lines, and one of the digests of those that are known.
        assert count("Exchange", first_deliveries(bronze, known)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_written_in_zstd(paths, bronze):
    folders = list(Path(paths.bronze).glob("load_id=*"))
    assert list(folders[0].rglob("*.parquet")) == list(folders[0].rglob("*.zstd.parquet")) != []


def test_silver_tables_need_no_shuffle(bronze):
    assert count("Exchange", silver_orders(bronze)) == 0
    assert count("Exchange", silver_account(bronze)) == 0


def test_metrics_scan_few_columns_and_push_the_trade_filter(spark, paths, bronze):
    write_silver(silver_orders(bronze), ORDER_REQUIRED, paths.silver_orders, "first")
    trades = closed_trades(read_silver_orders(spark, paths.silver_orders))
    plan = physical(daily_metrics(trades))
    for pushed in ("EqualTo(side,SELL)", "EqualTo(order_status,FILLED)"):
        assert pushed in plan
    assert "verdict" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert re.findall(r"(\w+):", columns) == ["side", "order_status", "trade_time", "realized_pnl"]


def test_metrics_shuffle_partial_sums_only(spark, paths):
    trades = closed_trades(silver_orders(bronze_rows(raw(spark, [order()]))))
    write_gold(trades, paths.gold_trades, GOLD_TRADES)
    metrics = daily_metrics(read_gold_trades(spark, paths.gold_trades))
    assert count("Exchange hashpartitioning", metrics) == 1
    assert "HashAggregate" in physical(metrics) and "partial_count" in physical(metrics)
    assert "SortAggregate" not in physical(metrics)


def test_drawdown_combines_before_its_first_shuffle_and_gathers_days_only(spark):
    lines = bronze_rows(raw(spark, [account()]))
    plan = physical(daily_max_drawdown(equity_points(account_events(lines))))
    steps = [line.lstrip(" +-*:()0123456789") for line in plan.splitlines()]
    first = max(i for i, step in enumerate(steps) if step.startswith("Exchange"))
    assert "partial_min" in steps[first + 1]
    gathered = [i for i, step in enumerate(steps) if step.startswith("Exchange SinglePartition")]
    assert len(gathered) == 1
    below = next(step for step in steps[gathered[0] + 1 :] if not step.startswith("Project"))
    assert below.startswith("HashAggregate(keys=[day")


def test_streamed_metrics_parse_nothing(spark, paths):
    add_orders(silver_orders(bronze_rows(raw(spark, [order()]))), paths, "feed-0")
    metrics = metrics_of_sums(read_trade_days(spark, paths.trade_days))
    assert count("from_json|json_tuple", metrics) == 0
    assert metrics.first().trades_count == 1


def test_a_day_of_trades_is_found_by_row_group_statistics(spark, paths):
    """Trades of 40 days in one part: a query of one day reads the row groups that hold it."""
    schema = "order_id long, symbol string, day int"
    rows = [(n, f"S{n % 5}", n % 40) for n in range(40_000)]
    trades = (
        spark.createDataFrame(rows, schema)
        .repartition(1)
        .selectExpr(
            "order_id",
            "symbol",
            "'SELL' AS side",
            "CAST(1 AS DECIMAL(18,8)) AS original_quantity",
            "CAST(1 AS DECIMAL(18,8)) AS price",
            "CAST(order_id AS DECIMAL(18,8)) AS realized_pnl",
            "TIMESTAMP'2025-01-01 12:00:00' + make_dt_interval(day, 0, 0, order_id) AS trade_time",
            "'FILLED' AS order_status",
        )
    )
    name = "parquet.block.size"
    spark.sparkContext._jsc.hadoopConfiguration().set(name, str(64 * 1024))
    try:
        with Load(spark, "one") as load:
            load.write(clustered(trades), paths.gold_trades)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset(name)
    found = read_gold_trades(spark, paths.gold_trades)
    day = found.where("trade_time >= '2025-01-05' AND trade_time < '2025-01-06' AND symbol = 'S2'")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = physical(day)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(trade_time" in plan and "EqualTo(symbol,S2)" in plan
    (file,) = Path(paths.gold_trades).glob("**/*.parquet")
    footer = pq.ParquetFile(file).metadata
    groups = [footer.row_group(k) for k in range(footer.num_row_groups)]
    at = found.columns.index("trade_time")
    spans = [(x.column(at).statistics.min, x.column(at).statistics.max) for x in groups]
    holding = [x for x in spans if str(x[0]) < "2025-01-06" and str(x[1]) >= "2025-01-05"]
    assert len(spans) >= 8
    assert len(holding) <= 2
    inside = [n for n, s, d in rows if s == "S2" and 4 <= d + (43200 + n) / 86400 < 5]
    assert day.count() == len(inside)


def scanned(df) -> int:
    """Rows that the scan of an executed plan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    leaves = plan.collectLeaves() if "Adaptive" not in plan.nodeName() else (
        plan.executedPlan().collectLeaves()
    )
    return leaves.head().metrics().apply("numOutputRows").value()


def test_an_order_is_found_by_bloom_filters(spark, paths):
    """Ids that are spread over all row groups, whose least and greatest say nothing."""
    trades = spark.range(40_000).repartition(1).selectExpr(
        "pmod(xxhash64(id), 1000000007) AS order_id",
        "'S' AS symbol",
        "'SELL' AS side",
        "CAST(1 AS DECIMAL(18,8)) AS original_quantity",
        "CAST(1 AS DECIMAL(18,8)) AS price",
        "CAST(id AS DECIMAL(18,8)) AS realized_pnl",
        "TIMESTAMP'2025-01-01 12:00:00' + make_dt_interval(0, 0, 0, id) AS trade_time",
        "'FILLED' AS order_status",
    )
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 * 1024))
    try:
        for name, blooms in (("with", TRADE_BLOOMS), ("none", ())):
            with Load(spark, name) as load:
                load.write(clustered(trades), paths.gold_trades, blooms=blooms)
    finally:
        conf.unset("parquet.block.size")
    wanted = [x.order_id for x in trades.orderBy("trade_time").take(1)]
    rows = {}
    for name in ("with", "none"):
        (folder,) = Path(paths.gold_trades).glob(f"load_id={name}*")
        found = trades_of_orders(spark.read.parquet(str(folder)), wanted)
        rows[name] = scanned(found)
        assert found.count() == 1
    assert rows["none"] == 40_000
    assert 0 < rows["with"] <= 10_000
