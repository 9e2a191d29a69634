"""Loads that become visible at once, or not at all, and parts that are merged by tiers."""

import random
import shutil
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from events import DAY, NOON, account, balance, order, raw
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerlake.operators.days import settled_days
from ledgerlake.operators.envelope import bronze_rows, first_deliveries, line_digests
from ledgerlake.plans.stages import compact_lake, run, run_bronze, run_gold, run_silver
from ledgerlake.schemas import BALANCES
from ledgerlake.sources import commits, storage
from ledgerlake.sources.catalog import register_gold
from ledgerlake.sources.commits import Change, Part, State, due, holds, tier, together
from ledgerlake.sources.tables import (
    Load,
    compact,
    parts,
    read_account_events,
    read_balances,
    read_bronze,
    read_gold_daily_metrics,
    read_gold_daily_risk,
    read_gold_trades,
    read_loads,
    read_positions,
    read_quarantine,
    read_silver_account,
    read_silver_orders,
    read_trade_days,
    visible_loads,
    write_load,
)

LOAD = st.one_of(
    st.sampled_from(["a", "b", "2025-03-07", "x-07"]),
    st.integers(0, 30).map(lambda n: f"feed-{n}"),
    st.integers(1, 30).map(lambda n: f"2025-03-{n}"),
)


def land(paths, load_id, *lines):
    folder = Path(paths.landed(load_id))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")


def ids(spark, paths):
    return sorted(x.order_id for x in read_silver_orders(spark, paths.silver_orders).collect())


# The log


@given(st.sets(LOAD))
def test_runs_of_loads_hold_the_same_loads(loads):
    short = together(loads)
    assert sorted(commits._each(short)) == sorted(loads)
    assert all(holds(short, x) for x in loads)
    assert not any(holds(short, x) for x in ("feed-31", "c", "feed-031", "2025-03"))


def test_many_commits_are_read_from_few_files(spark, tmp_path):
    log = f"{tmp_path}/_commits"
    for n in range(70):
        commits.commit(spark, log, lambda _, n=n: Change(put={"t": [Part(f"f{n}", (f"l-{n}",))]}))
    known = commits.read_state(spark, log)
    commits._KNOWN.clear()
    assert commits.read_state(spark, log) == known
    assert known.version == 70 and len(known.of("t")) == 70
    assert len(storage.files(spark, log)) <= 2 * commits.SNAPSHOT_EVERY + 1


def test_a_reader_that_knows_an_old_state_catches_up(spark, tmp_path):
    log = f"{tmp_path}/_commits"
    for n in range(40):
        if n == 5:
            old = commits._KNOWN[log]
        commits.commit(spark, log, lambda _, n=n: Change(put={"t": [Part(f"f{n}", (f"l-{n}",))]}))
    commits._KNOWN[log] = old
    assert len(commits.read_state(spark, log).of("t")) == 40


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    log = f"{tmp_path}/_commits"

    def add(n):
        commits.commit(spark, log, lambda _: Change(put={f"t{n % 3}": [Part(f"f{n}", (f"l{n}",))]}))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(48)))
    state = commits.read_state(spark, log)
    assert state.version == 48
    assert sorted(x.folder for t in range(3) for x in state.of(f"t{t}")) == sorted(
        f"f{n}" for n in range(48)
    )


def test_of_several_writers_of_a_file_one_wins(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: storage.create_text(spark, f"{tmp_path}/x", str(n)), range(16)))
    assert won.count(True) == 1
    assert storage.read_text(spark, f"{tmp_path}/x") == str(won.index(True))
    assert storage.files(spark, str(tmp_path)) == ["x"]


# Tiers


def test_rows_are_rewritten_a_logarithmic_number_of_times():
    """A load has one row; sizes are numbers of loads."""
    for n, fanout in ((200, 8), (1000, 8), (1000, 4), (3000, 2)):
        state, rewritten = State(), 0
        for k in range(n):
            state = state.after(Change(put={"t": [Part(f"f{k}", (f"l-{k}",), 1)]}))
            while chosen := due(state.of("t"), fanout, 1 << 40):
                loads = together(x for part in chosen for x in part.counting())
                size = sum(part.size for part in chosen)
                rewritten += size
                change = Change(
                    put={"t": [Part(f"m{k}-{rewritten}", loads, size)]},
                    drop={"t": [x.folder for x in chosen]},
                    merge=True,
                )
                state = state.after(change)
        tiers = tier(n, fanout) + 1
        assert rewritten <= n * tiers
        assert len(state.of("t")) <= fanout * tiers
        assert sorted(state.loads("t")) == sorted(f"l-{k}" for k in range(n))


def test_large_parts_are_left_alone():
    large = [Part(f"f{k}", (f"l{k}",), 100) for k in range(9)]
    assert due(large, 4, 100) == []
    assert len(due(large, 4, 101)) == 9


def test_tiers_that_fill_each_other_are_merged_at_once():
    merged = [Part(f"m{k}", tuple(f"l{3 * k + i}" for i in range(3)), 3) for k in range(2)]
    single = [Part(f"f{k}", (f"l{k}",), 1) for k in range(6, 9)]
    assert due([*merged, *single], 3, 1 << 40) == [*merged, *single]
    assert due([merged[0], *single], 3, 1 << 40) == single
    # Three of one load make a part that is large enough.
    assert due([*merged, *single], 3, 3) == single


def test_parts_without_partitions_are_merged_without_a_shuffle(spark, tmp_path):
    path = f"{tmp_path}/silver/numbers"
    for k in range(3):
        write_load(spark.range(k * 100, k * 100 + 100, 1, 4).toDF("n"), path, f"l-{k}")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("merge", "merge")
    try:
        compact(spark, path, NUMBERS, fanout=3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(x) for x in tracker.getJobIdsForGroup("merge")]
    assert [len(job.stageIds) for job in jobs] == [1]
    assert numbers(spark, path) == list(range(300))
    (folder,) = [part.folder for part in parts(spark, path)]
    assert len(list(Path(f"{path}/{folder}").glob("*.parquet"))) == 1


NUMBERS = T.StructType([T.StructField("n", T.LongType())])


def numbers(spark, path):
    return sorted(x.n for x in read_loads(spark, path, NUMBERS).collect())


def test_bytes_written_by_many_loads(spark, tmp_path):
    path = f"{tmp_path}/silver/numbers"
    first, rewritten = 0, 0
    for k in range(40):
        write_load(spark.range(k * 100, k * 100 + 100).toDF("n").coalesce(1), path, f"l-{k}")
        first += parts(spark, path)[-1].size
        rewritten += compact(spark, path, NUMBERS, fanout=3, grace=0)
    assert numbers(spark, path) == list(range(4000))
    assert len(parts(spark, path)) <= 3 * (tier(40, 3) + 1)
    # Merged files are smaller than the sum of theirs, which counts for the bound.
    assert rewritten <= first * (tier(40, 3) + 1)
    assert len(storage.folders(spark, path)) == len(parts(spark, path))


def test_a_merged_load_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/silver/numbers"
    for k in range(4):
        write_load(spark.range(k * 10, k * 10 + 2).toDF("n"), path, f"2025-03-1{k}")
    compact(spark, path, NUMBERS, fanout=4)
    assert len(parts(spark, path)) == 1
    write_load(spark.range(500, 501).toDF("n"), path, "2025-03-12")
    assert numbers(spark, path) == [0, 1, 10, 11, 30, 31, 500]
    write_load(spark.range(600, 601).toDF("n"), path, "2025-03-12")
    assert numbers(spark, path) == [0, 1, 10, 11, 30, 31, 600]
    assert [x.n for x in read_loads(spark, path, NUMBERS, ["2025-03-12"]).collect()] == [600]
    compact(spark, path, NUMBERS, fanout=2, grace=0)
    assert numbers(spark, path) == [0, 1, 10, 11, 30, 31, 600]
    assert visible_loads(spark, path) == [f"2025-03-1{k}" for k in range(4)]


def test_a_merge_whose_parts_changed_is_given_up(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/silver/numbers"
    for k in range(3):
        write_load(spark.range(k, k + 1).toDF("n"), path, f"l-{k}")
    size = storage.size

    def replaced_meanwhile(spark, place):
        monkeypatch.setattr(storage, "size", size)
        write_load(spark.range(70, 71).toDF("n"), path, "l-1")
        return size(spark, place)

    monkeypatch.setattr(storage, "size", replaced_meanwhile)
    assert compact(spark, path, NUMBERS, fanout=3, grace=0) == 0
    assert numbers(spark, path) == [0, 2, 70]
    assert len(storage.folders(spark, path)) == 3
    compact(spark, path, NUMBERS, fanout=3, grace=0)
    assert numbers(spark, path) == [0, 2, 70] and len(parts(spark, path)) == 1


def test_readers_that_began_before_a_merge_go_on(spark, tmp_path):
    path = f"{tmp_path}/silver/numbers"
    for k in range(3):
        write_load(spark.range(k, k + 1).toDF("n"), path, f"l-{k}")
    before = read_loads(spark, path, NUMBERS)
    compact(spark, path, NUMBERS, fanout=3)
    write_load(spark.range(9, 10).toDF("n"), path, "l-0")
    assert sorted(x.n for x in before.collect()) == [0, 1, 2]


# Loads of a lake


DAY_ONE = (order(i=1, rp="1"), order(i=2, s=None), account(balances=[balance(wallet="10")]))
DAY_TWO = (order(NOON + DAY, i=3, rp="2"), account(NOON + DAY, [balance(wallet="7")]))


def everything(spark, paths):
    tables = {
        "orders": read_silver_orders(spark, paths.silver_orders),
        "trade_days": read_trade_days(spark, paths.trade_days),
        "events": read_account_events(spark, paths.account_events),
        "balances": read_balances(spark, paths.balances),
        "positions": read_positions(spark, paths.positions),
        "account": read_silver_account(spark, paths.silver_account),
        "quarantine": read_quarantine(spark, paths.silver_orders, paths.silver_account),
        "trades": read_gold_trades(spark, paths.gold_trades),
    }
    volatile = ("ingest_time", "processing_time")
    return {k: sorted(map(str, x.drop(*volatile).collect())) for k, x in tables.items()}


def test_a_load_that_fails_is_visible_in_no_table(spark, paths, monkeypatch):
    land(paths, "one", *DAY_ONE)
    run_bronze(spark, paths, "one")
    run_silver(spark, paths, "one")
    before = everything(spark, paths)
    land(paths, "two", *DAY_TWO)
    run_bronze(spark, paths, "two")
    land(paths, "one", order(i=8, rp="5"))
    run_bronze(spark, paths, "one")
    write, tables = Load.write, sorted(
        (paths.silver_orders, paths.gold_trades, paths.trade_days, paths.account_events)
        + (paths.silver_account, paths.balances, paths.positions, paths.equity_instants)
        + (paths.equity_minutes,)
    )

    def broken_at(failing):
        def broken(self, rows, path, partitions=()):
            write(self, rows, path, partitions)
            if path == failing:
                raise OSError("no space left")

        return broken

    for at, failing in enumerate(tables):
        monkeypatch.setattr(Load, "write", broken_at(failing))
        with pytest.raises(OSError, match="no space"):
            run_silver(spark, paths, ("one", "two")[at % 2])
        monkeypatch.setattr(Load, "write", write)
        assert everything(spark, paths) == before
    run_silver(spark, paths, "two")
    assert ids(spark, paths) == [1, 3]


def test_replacing_a_load_never_empties_it(spark, paths):
    land(paths, "one", *DAY_ONE)
    run(spark, paths, "one")
    readers = {
        "bronze": read_bronze(spark, paths.bronze),
        "orders": read_silver_orders(spark, paths.silver_orders),
        "trades": read_gold_trades(spark, paths.gold_trades),
        "days": read_gold_daily_metrics(spark, paths.gold_daily_metrics),
    }
    counts = {name: reader.count() for name, reader in readers.items()}
    land(paths, "one", order(i=8, rp="5"), order(i=9, rp="6"))
    run(spark, paths, "one")
    assert {name: reader.count() for name, reader in readers.items()} == counts
    assert ids(spark, paths) == [8, 9]


def test_gold_reads_no_rows_of_earlier_loads(spark, paths):
    land(paths, "one", *DAY_ONE)
    run(spark, paths, "one")
    for path in (paths.silver_orders, paths.silver_account, paths.account_events, paths.gold_trades):
        for folder in storage.folders(spark, path):
            shutil.rmtree(f"{path}/{folder}")
    land(paths, "two", *DAY_TWO)
    run(spark, paths, "two")
    days = read_gold_daily_metrics(spark, paths.gold_daily_metrics).collect()
    assert sorted((x.day.day, x.total_pnl) for x in days) == [(17, 1), (18, 2)]
    risk = read_gold_daily_risk(spark, paths.gold_daily_risk).collect()
    assert sorted((x.day.day, round(x.running_drawdown, 9)) for x in risk) == [(17, 0), (18, 0.3)]


def test_quarantine_of_many_batch_loads_is_in_few_files(spark, paths):
    for k in range(9):
        land(paths, f"2025-03-{k + 1:02}", order(i=k, s=None), account(positions=[]))
        run_bronze(spark, paths, f"2025-03-{k + 1:02}")
        run_silver(spark, paths, f"2025-03-{k + 1:02}")
        compact_lake(spark, paths, fanout=3, grace=0)
    assert read_quarantine(spark, paths.silver_orders, paths.silver_account).count() == 18
    for path in (paths.silver_orders, paths.silver_account, paths.bronze):
        assert len(parts(spark, path)) == 1
    assert len(list(Path(paths.silver_orders).glob("**/verdict=quarantine/**/*.parquet"))) == 1
    assert read_bronze(spark, paths.bronze).count() == 18
    land(paths, "2025-03-04", order(i=40))
    run(spark, paths, "2025-03-04")
    assert ids(spark, paths) == [40]
    assert read_quarantine(spark, paths.silver_orders, paths.silver_account).count() == 16


def test_running_an_old_load_again_leaves_late_trades_as_they_were(spark, paths):
    def late():
        rows = settled_days(read_trade_days(spark, paths.trade_days)).collect()
        return {x.day.day: (x.trades_count, x.late_trades) for x in rows}

    land(paths, "a", order(i=1), order(NOON + DAY, i=2))
    land(paths, "b", order(NOON + 5 * DAY, i=3))
    land(paths, "c", order(i=4))
    for load_id in "abc":
        run(spark, paths, load_id)
    first = late()
    assert first == {17: (2, 1), 18: (1, 0)}
    for load_id in "abca":
        run(spark, paths, load_id)
        assert late() == first


def test_trades_of_loads_in_the_catalog(spark, paths):
    def trades():
        register_gold(spark, paths, "gold_loads")
        return sorted(x.order_id for x in spark.table("gold_loads.trades").collect())

    for k in range(3):
        land(paths, f"load-{k}", order(i=k, rp="1"), order(i=10 + k, rp="1"))
        run(spark, paths, f"load-{k}")
    assert trades() == [0, 1, 2, 10, 11, 12]
    compact_lake(spark, paths, fanout=3, grace=0)
    assert trades() == [0, 1, 2, 10, 11, 12]
    land(paths, "load-1", order(i=50, rp="1"))
    run(spark, paths, "load-1")
    assert trades() == [0, 2, 10, 12, 50]
    assert spark.table("gold_loads.trades").schema == read_gold_trades(spark, paths.gold_trades).schema
    names = {x.name for x in spark.catalog.listTables("gold_loads")}
    assert len(names) == 3 + len(parts(spark, paths.gold_trades))


def test_loads_in_any_order_with_merges_in_between(spark, paths):
    rng = random.Random(3)
    content = {}
    for step in range(8):
        load_id = f"l-{rng.randrange(4)}"
        content[load_id] = [100 * step + k for k in range(rng.randrange(1, 4))]
        land(paths, load_id, *(order(NOON + n * 3600000, i=n, rp=str(n)) for n in content[load_id]))
        run_bronze(spark, paths, load_id)
        run_silver(spark, paths, load_id)
        if step % 3 == 2:
            compact_lake(spark, paths, fanout=2, grace=0)
    run_gold(spark, paths)
    expected = sorted(n for own in content.values() for n in own)
    assert ids(spark, paths) == expected
    days = read_gold_daily_metrics(spark, paths.gold_daily_metrics)
    assert days.agg({"total_pnl": "sum"}).first()[0] == sum(expected)
    assert read_loads(spark, paths.balances, BALANCES).isEmpty()


def test_lines_delivered_again_count_once_in_batch(spark, paths):
    lines = [order(i=1, rp="1"), order(i=2, s=None), account(), "", "{"]
    land(paths, "one", *lines, *lines)
    run(spark, paths, "one", once=True)
    before = everything(spark, paths)
    assert ids(spark, paths) == [1]
    assert read_bronze(spark, paths.bronze).count() == 5
    land(paths, "two", *lines, order(NOON + DAY, i=3))
    for load_id in ("two", "two", "one"):
        run(spark, paths, load_id, once=True)
    assert read_bronze(spark, paths.bronze).count() == 6
    assert ids(spark, paths) == [1, 3]
    # The line that a corrected load no longer has is free to come again.
    land(paths, "one", order(i=9))
    run(spark, paths, "one", once=True)
    run(spark, paths, "two", once=True)
    assert ids(spark, paths) == [1, 3, 9]
    assert everything(spark, paths)["quarantine"] == before["quarantine"]


def test_digests_are_read_for_the_dates_of_a_load(spark):
    rows = bronze_rows(raw(spark, [order()]))
    known = line_digests(bronze_rows(raw(spark, [order()])))
    assert first_deliveries(rows, known).isEmpty()
    assert first_deliveries(rows, known.limit(0)).count() == 1
