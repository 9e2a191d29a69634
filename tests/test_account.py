from decimal import Decimal

from events import account, balance, order, position, raw

from ledgerlake.operators.account import (
    account_events,
    balance_rows,
    position_rows,
    silver_account,
)
from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.schemas import SILVER_ACCOUNT


def bronze(spark, *lines):
    return bronze_rows(raw(spark, lines))


def test_silver_account_matches_its_contract(spark):
    table = silver_account(bronze(spark, account()))
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in SILVER_ACCOUNT
    ]
    assert len(table.columns) == 18


def test_each_balance_meets_each_position_of_its_event(spark):
    line = account(
        balances=[balance("A"), balance("B")],
        positions=[position("X"), position("Y"), position("Z")],
    )
    rows = silver_account(bronze(spark, line)).collect()
    assert {(r.asset, r.symbol) for r in rows} == {(a, s) for a in "AB" for s in "XYZ"}
    assert len(rows) == 6
    assert {r.raw_json for r in rows} == {line}


def test_empty_and_missing_arrays_keep_their_event(spark):
    def shape(**arrays):
        rows = silver_account(bronze(spark, account(**arrays))).collect()
        return [(r.asset, r.symbol) for r in rows]

    two = [balance("A"), balance("B")]
    assert shape(balances=two, positions=[]) == [("A", None), ("B", None)]
    assert shape(balances=two, positions=None) == [("A", None), ("B", None)]
    assert shape(balances=[], positions=[position("X")]) == [(None, "X")]
    assert shape(balances=[], positions=[]) == [(None, None)]
    assert shape(balances=None, positions=None) == [(None, None)]


def test_missing_body(spark):
    rows = silver_account(bronze(spark, account(envelope={"a": None}))).collect()
    assert [(r.event_reason, r.asset, r.symbol) for r in rows] == [(None, None, None)]


def test_unknown_position_keys_are_ignored(spark):
    row = silver_account(bronze(spark, account(positions=[position(unrealized="0.5")]))).first()
    assert (row.unrealized_pnl, row.position_side) == (Decimal("0.5"), "BOTH")


def test_single_array_tables_hold_each_element_once(spark):
    line = account(
        balances=[balance("A", change="1"), balance("B", change="2")],
        positions=[position("X"), position("Y"), position("Z")],
    )
    events = account_events(bronze(spark, line, order()))
    assert balance_rows(events).groupBy().sum("balance_change").first()[0] == 3
    assert balance_rows(events).count() == 2
    assert position_rows(events).count() == 3
