from datetime import date, datetime

from events import NOON, account, order, raw
from pyspark.sql import functions as F

from ledgerlake.functions.times import timestamp_of
from ledgerlake.operators.envelope import bronze_rows, of_type, unrouted
from ledgerlake.schemas import BRONZE, ORDER_EVENT


def envelope(spark, line):
    return bronze_rows(raw(spark, [line])).first()


def test_bronze_matches_its_contract(spark):
    bronze = bronze_rows(raw(spark, [order()]))
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE]


def test_line_is_kept_and_stamped(spark):
    row = envelope(spark, order())
    assert row.raw_json == order()
    assert row.ingest_time is not None
    assert row.event_type == ORDER_EVENT
    assert row.event_time == datetime(2025, 3, 17, 12)
    assert row.event_date == date(2025, 3, 17)


def test_type_and_time_are_found_among_keys_differing_by_case(spark):
    row = envelope(spark, '{"E": 5, "t": 6, "T": 1500, "e": "X"}')
    assert (row.event_type, row.event_time) == ("X", datetime(1970, 1, 1, 0, 0, 1, 500000))


def test_lines_that_are_no_object_have_neither_type_nor_time(spark):
    lines = ["", "  ", "no json", order()[:-1], "[1]", "null", '{"e": "A", "T": 1, "z": bad}']
    for row in bronze_rows(raw(spark, lines)).collect():
        assert (row.event_type, row.event_time, row.event_date) == (None, None, None)


def test_bad_event_times_become_null_under_either_ansi_setting(spark):
    cases = {
        '"abc"': None,
        '""': None,
        "null": None,
        "1e300": None,
        "9223372036854775807": None,
        '"177"': datetime(1970, 1, 1, 0, 0, 0, 177000),
        "1.5": datetime(1970, 1, 1, 0, 0, 0, 1500),
        "-1": datetime(1969, 12, 31, 23, 59, 59, 999000),
    }
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for text, expected in cases.items():
                assert envelope(spark, f'{{"e":"A","T":{text}}}').event_time == expected, text
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_milliseconds_are_exact(spark):
    span = spark.range(NOON, NOON + 200000).select(
        (timestamp_of(F.col("id")) == F.timestamp_millis("id")).alias("same")
    )
    assert span.where(~F.col("same")).isEmpty()


def test_every_line_is_routed_once_or_stays_in_bronze(spark):
    lines = [order(), order(), account(), "", '{"e": "MARGIN_CALL"}', '{"T": 1}']
    bronze = bronze_rows(raw(spark, lines))
    assert of_type(bronze, ORDER_EVENT).count() == 2
    assert of_type(bronze, "ACCOUNT_UPDATE").count() == 1
    assert {row.event_type for row in unrouted(bronze).collect()} == {None, "MARGIN_CALL"}
    assert unrouted(bronze).count() == 3
