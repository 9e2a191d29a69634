"""Equity where an update lists only what changed."""

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

from events import DAY, NOON, account, balance, position, raw

from ledgerlake.operators.account import account_events
from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.operators.equity import account_changes, carried_equity


def by_loop(changes):
    """Instant by instant, in order, with a dictionary of what is known."""
    instants = {}
    for at, kind, name, amount in changes:
        own = instants.setdefault(at, {})
        own[kind, name] = max(own.get((kind, name), amount), amount)
    known, curve = {}, {}
    for at in sorted(instants):
        known.update(instants[at])
        curve[at] = sum(known.values())
    return curve


def curve_of(spark, changes):
    schema = "at timestamp, kind string, name string, amount decimal(18,8)"
    found = carried_equity(spark.createDataFrame(changes, schema).repartition(4)).collect()
    assert len(found) == len({row.at for row in found})
    return {row.at: row.equity for row in found}


def test_curve_of_random_changes(spark):
    rng = random.Random(2)
    start = datetime(2025, 3, 17, 23, 57)
    names = [("asset", "A"), ("asset", "B"), ("position", "X/LONG"), ("position", ""), ("asset", "")]
    changes = [
        (
            start + timedelta(milliseconds=rng.randrange(0, 6 * 60000, 37)),
            *rng.choice(names),
            Decimal(rng.randrange(-(10**9), 10**9)).scaleb(-8),
        )
        for _ in range(1500)
    ]
    # Names that rest for days, and one that comes late.
    changes += [(start + timedelta(days=3, seconds=k), "asset", "A", Decimal(k)) for k in range(5)]
    changes += [(start + timedelta(days=4), "asset", "late", Decimal("0.5"))]
    assert curve_of(spark, changes) == by_loop(changes)


def test_one_change_and_none(spark):
    at = datetime(2025, 3, 17)
    assert curve_of(spark, [(at, "asset", "A", Decimal(3))]) == {at: 3}
    schema = "at timestamp, kind string, name string, amount decimal(18,8)"
    assert carried_equity(spark.createDataFrame([], schema)).isEmpty()


def test_updates_of_single_assets_and_positions(spark):
    lines = [
        account(NOON, [balance("A", "100"), balance("B", "20")], [position("X", "5")]),
        account(NOON + 10, [balance("B", "30")], []),
        account(NOON + 20, [], [position("X", "-1"), position("X", "2", side="LONG")]),
        account(NOON + DAY, [balance("A", None)], [position("X", "0")]),
        account(NOON + DAY + 5, None, None),
        account(NOON + 2 * DAY, [balance(None, "1")]),
        account(envelope={"E": None}),
        account(NOON + 3 * DAY, [balance("A", "0")], []),
    ]
    changes = account_changes(account_events(bronze_rows(raw(spark, lines))))
    rows = carried_equity(changes).orderBy("at").collect()
    assert [row.equity for row in rows] == [125, 135, 131, 132, 133, 33]


def test_no_window_spans_the_history_of_a_name(spark):
    lines = bronze_rows(raw(spark, [account()]))
    frame = carried_equity(account_changes(account_events(lines)))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    windows = [x.strip(" +-:") for x in plan.splitlines() if x.strip(" +-:").startswith("Window ")]
    assert windows
    for each in windows:
        # Windows over more than a minute or a day have one row a day, and follow the days.
        *_, names, order = re.sub(r"#\d+", "", each).split("], [") if "], [" in each else (each, "")
        within = each.count("], [") == 2 and ("minute" in names or "day" in names)
        assert within or order.startswith("day ") or names.startswith("day ")
