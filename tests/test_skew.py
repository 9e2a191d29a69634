"""One day holding most of the rows, all of them copies, must not end up in one task."""

from pathlib import Path

import pytest
from events import DAY, NOON, order

from ledgerlake.operators.envelope import bronze_rows
from ledgerlake.sources.landing import read_landing, stream_landing
from ledgerlake.sources.tables import read_bronze, read_silver_orders, write_bronze
from ledgerlake.streaming.tables import bronze_stream, silver_orders_stream, stream_bronze

COPIES = 8 * 4000
OTHERS = 8 * 3 * 50


def files(path, partition):
    return list(Path(path).glob(f"**/{partition}/*.parquet"))


@pytest.fixture
def small_tasks(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "64k")
    yield
    spark.conf.unset(name)


@pytest.fixture
def skewed(paths):
    Path(paths.landing).mkdir()
    others = [order(NOON + day * DAY, i=n) for day in (1, 2, 3) for n in range(50)]
    lines = [order()] * 4000 + others
    for part in range(8):
        (Path(paths.landing) / f"{part}.jsonl").write_text("\n".join(lines) + "\n")
    return paths


def test_a_busy_day_of_bronze_is_written_by_many_tasks(spark, skewed, small_tasks):
    write_bronze(bronze_rows(read_landing(spark, skewed.landing)), skewed.bronze, "first")
    assert len(files(skewed.bronze, "event_date=2025-03-17")) > 1
    assert read_bronze(spark, skewed.bronze).count() == COPIES + OTHERS


def test_a_busy_day_of_a_stream_is_written_by_many_tasks(spark, skewed, small_tasks):
    def finish(writer):
        writer.trigger(availableNow=True).start().awaitTermination()

    finish(bronze_stream(stream_landing(spark, skewed.landing), skewed))
    finish(silver_orders_stream(stream_bronze(spark, skewed), skewed, "feed"))
    assert len(files(skewed.streamed_bronze, "event_date=2025-03-17")) > 1
    assert len(files(skewed.silver_orders, "event_time=2025-03-17")) > 1
    assert read_bronze(spark, skewed.streamed_bronze).count() == COPIES + OTHERS
    assert read_silver_orders(spark, skewed.silver_orders).count() == COPIES + OTHERS
