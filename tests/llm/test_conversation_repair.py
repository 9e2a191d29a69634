import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import conversation_repair as op
from ledgerlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
RULE = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    """The first fault of each (role, text)."""
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACES)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def every_repair(rows, faults):
    """(cost, audit, turns) of all sensible edits, without any search: at most one pair inserted."""
    done = []

    def go(at, cost, audit, turns, since):
        initials = "".join(x[:1] or "?" for x, _ in turns)
        if not re.fullmatch("s?(ua)*u?", initials):
            return
        if at == len(rows) and RULE.fullmatch(initials):
            done.append((cost, audit, turns))
        if since < 2:
            for role in ("user", "assistant"):
                go(at, cost + 2, audit + "I", [*turns, (role, "")], since + 1)
        if at == len(rows):
            return
        role, text = rows[at]
        go(at + 1, cost + 3, audit + "D", turns, 0)
        if faults[at] not in ("blank", "duplicate"):
            more = faults[at] == "truncated"
            go(at + 1, cost + more, audit + "K", [*turns, (role, text)], 0)
            for other in ("user", "assistant"):
                go(at + 1, cost + 2 + more, audit + "R", [*turns, (other, text)], 0)

    go(0, 0, "", [], 0)
    return min(done, key=lambda x: x[:2])


def by_tables(rows, faults):
    """The same by a plain table of whole strings, for longer conversations."""
    nexts = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def closed(best):
        best = dict(best)
        for _ in range(4):
            for state, (cost, audit, turns) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    into = nexts[state].get(initial)
                    if into:
                        new = (cost + 2, audit + "I", (*turns, (role, "")))
                        best[into] = min(best.get(into, new), new, key=lambda x: x[:2])
        return best

    for (role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def offer(state, value):
            new[state] = min(new.get(state, value), value, key=lambda x: x[:2])

        for state, (cost, audit, turns) in closed(best).items():
            offer(state, (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if role[:1] in nexts[state]:
                kept = (*turns, (role, text))
                offer(nexts[state][role[:1]], (cost + more, audit + "K", kept))
            for initial, other in (("u", "user"), ("a", "assistant")):
                if initial in nexts[state]:
                    changed = (*turns, (other, text))
                    offer(nexts[state][initial], (cost + 2 + more, audit + "R", changed))
        best = new
    best = closed(best)
    return min((best[x] for x in ("", "a") if x in best), key=lambda x: x[:2])


def searched(rows, faults):
    """The search by itself; also the most open edits there were."""
    search, audit, turns, cost, most = op.Search(), "", [], 0, 0

    def take(edits):
        nonlocal audit, cost
        for edit, role, row in edits:
            audit += edit
            cost += {"K": 0, "R": 2, "D": 3, "I": 2}[edit]
            if edit != "D":
                cost += row is not None and row[1] == "truncated"
                turns.append((role, row[0] if row else ""))

    for (role, text), fault in zip(rows, faults, strict=True):
        take(search.add((text, fault), role, fault in ("blank", "duplicate"), fault == "truncated"))
        most = max(most, search.open_edits())
    take(search.end())
    return (cost, audit, turns), most


ROLE = st.sampled_from(["system", "user", "assistant", "tool", "u", " ", ""])
FAULT = st.sampled_from([None, None, "truncated", "blank", "duplicate"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(ROLE, FAULT), max_size=4))
def test_the_cheapest_of_all_repairs_is_found(found):
    rows = [(role, f"text {k}") for k, (role, _) in enumerate(found)]
    faults = [fault for _, fault in found]
    expected = every_repair(rows, faults)
    assert searched(rows, faults)[0] == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ROLE, FAULT), max_size=40))
def test_longer_conversations_and_ties(found):
    rows = [(role, f"text {k}") for k, (role, _) in enumerate(found)]
    faults = [fault for _, fault in found]
    cost, audit, turns = by_tables(rows, faults)
    assert searched(rows, faults)[0] == (cost, audit, list(turns))


def test_memory_holds_only_what_is_open():
    rng = random.Random(7)
    rows = [(("user", "assistant")[k % 2], f"text {k}") for k in range(20_000)]
    for k in rng.sample(range(len(rows)), 2_000):
        rows[k] = (rng.choice(["user", "assistant", "tool", "system"]), rows[k][1])
    (_, audit, turns), most = searched(rows, [None] * len(rows))
    assert RULE.fullmatch("".join(role[0] for role, _ in turns))
    assert len(audit) >= len(rows)
    assert most < 200


def test_ties_that_stay_open_to_the_end():
    # Two chains of the same cost all the way: the end alone decides, and whole paths are compared.
    for n in (999, 1000):
        rows = [("user", f"text {k}") for k in range(n)]
        cost, audit, turns = by_tables(rows, [None] * n)
        assert searched(rows, [None] * n)[0] == (cost, audit, list(turns))


def frame(spark, rows, schema="conv_id long, turn long, role string, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def expected_summaries(rows):
    """Of rows (conv_id, turn, role, text, copies), by conversation."""
    groups = defaultdict(list)
    for conv, turn, role, text, copies in rows:
        role, text = (" " if x is None else x for x in (role, text))
        groups[conv] += [(turn, role, text)] * copies
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        pairs = [(role, text) for _, role, text in own]
        faults = faults_of(pairs)
        cost, audit, turns = by_tables(pairs, faults)
        numbers = {turn for turn, _, _ in own if turn is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [role[:1] for role, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        text = "\n".join(f"{role}:{text}" for role, text in turns)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def found_summaries(edits):
    return {row.conv_id: tuple(row)[1:] for row in op.summaries(edits).collect()}


ODD = [
    (1, 0, "user", "Hello there."),
    (1, 1, "assistant", "Good day."),
    (1, 5, "user", "no end"),
    (2, 0, "system", "Be kind."),
    (2, 1, "system", "Be kind."),
    (2, 2, "assistant", "Hm. \t\n"),
    (2, 2, "assistant", "Hm. \t\n"),
    (2, 9, "assistant", "Hm. \t\n"),
    (3, None, "user", "first?"),
    (3, None, None, None),
    (3, 4, "tool", "result!"),
    (3, 4, "", "no role."),
    (4, 0, "user", ""),
    (4, 1, "assistant", " \x0b"),
    (None, 0, "user", "no id."),
    (None, 0, "user", "no id."),
    (5, None, None, None),
    (6, 1, "user", "long " * 200_000 + "."),
    (6, 2, "assistant", "été 日本語 \U0001d518!"),
]


def test_odd_rows(spark):
    found = found_summaries(op.repair(frame(spark, ODD)))
    assert found == expected_summaries([(*row, 1) for row in ODD])


def test_turns_that_are_left_follow_the_rule(spark):
    turns = op.repaired_turns(op.repair(frame(spark, ODD))).orderBy("conv_id", "step").collect()
    by_conv = defaultdict(str)
    for row in turns:
        by_conv[row.conv_id] += row.role[0]
    assert all(RULE.fullmatch(x) for x in by_conv.values())
    assert by_conv[1] == "ua"


def test_copies_and_dropped_rows(spark):
    rows = [(*row, k % 3) for k, row in enumerate(ODD)]
    schema = "conv_id long, turn long, role string, text string, copies int"
    found = found_summaries(op.repair(frame(spark, rows, schema), copies="copies"))
    assert found == expected_summaries(rows)


def test_a_conversation_without_rows_is_kept(spark):
    schema = "conv_id long, turn long, role string, text string, copies int"
    found = found_summaries(op.repair(frame(spark, [(1, 0, "user", "x.", 0)], schema), "copies"))
    assert found == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_no_rows(spark):
    edits = op.repair(frame(spark, ODD).limit(0))
    assert edits.isEmpty()
    assert op.summaries(edits).isEmpty()


def test_clashing_columns_play_no_part(spark):
    rows = frame(spark, ODD)
    for name in ("copies", "digest", "step", "edit", "cost", "fault", "first", "n", "of", "blank"):
        rows = rows.selectExpr("*", f"'junk' AS {name}")
    assert found_summaries(op.repair(rows)) == expected_summaries([(*row, 1) for row in ODD])


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_keys(spark, kind):
    rows = frame(spark, ODD).withColumn("conv_id", op.F.col("conv_id").cast(kind))
    found = {None if k is None else int(k): v for k, v in found_summaries(op.repair(rows)).items()}
    assert found == expected_summaries([(*row, 1) for row in ODD])


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else x for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out.append((conv, turn, role, text, {0: 0, 3: 2}.get(code, 1)))
    return out


def test_the_registered_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(row) for row in table.select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()
    assert {row.conv_id: tuple(row)[1:] for row in found} == expected_summaries(damage(rows))


def test_damage_of_nulls(spark):
    rows = [(conv, turn, "user", "a.") for conv in (None, *range(40)) for turn in (None, 0, 1, 2)]
    found = [tuple(row) for row in op.damaged(frame(spark, rows)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, damage(rows)))
