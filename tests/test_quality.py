from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators.quality import (
    any_missing,
    clean_rows,
    has_rejects,
    rejected_rows,
    split,
    with_verdict,
)

NAMES = ("a", "b", "c")
ROWS = st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 9))] * 3), max_size=40)


def frame(spark, rows):
    return spark.createDataFrame(
        [(at, *row) for at, row in enumerate(rows)], "id int, a int, b int, c int"
    )


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=ROWS)
def test_split_puts_every_row_on_exactly_one_side(spark, rows):
    clean, rejected = split(frame(spark, rows), NAMES)
    good = {row.id for row in clean.collect()}
    bad = {row.id for row in rejected.collect()}
    assert good == {at for at, row in enumerate(rows) if None not in row}
    assert bad == set(range(len(rows))) - good


def test_verdict_agrees_with_the_split(spark):
    rows = [(1, 1, 1), (None, 1, 1), (1, None, None), (0, 0, 0)]
    df = frame(spark, rows)
    verdicts = {row.id: row.verdict for row in with_verdict(df, NAMES).collect()}
    assert verdicts == {0: "clean", 1: "quarantine", 2: "quarantine", 3: "clean"}
    assert df.where(any_missing(NAMES)).count() == 2


def test_only_required_columns_count(spark):
    df = frame(spark, [(1, None, None)])
    assert clean_rows(df, ("a",)).count() == 1
    assert rejected_rows(df, ("a", "b")).count() == 1


def test_has_rejects(spark):
    assert has_rejects(frame(spark, [(1, 1, 1), (1, None, 1)]), NAMES)
    assert not has_rejects(frame(spark, [(1, 1, 1)]), NAMES)
    assert not has_rejects(frame(spark, []), NAMES)
