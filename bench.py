"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores. Each query
runs in full into a sink that discards the rows; the best of BENCH_RUNS rounds counts.

The table of events is one file with one row group, which one task alone can read. Before
the clock starts its rows are dealt over a file for each core, as tables of any size are, so
that queries are timed rather than the layout of that file. BENCH_AS_IS=1 leaves it as it is.
"""

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from testbench.catalogue import QUERIES
from ledgerlake.session import SETTINGS

HEADLINES = (
    "bronze_envelope",
    "bronze_roundtrip_by_partition",
    "silver_orders",
    "silver_account",
    "clean_orders",
    "quarantine_account",
    "silver_roundtrip_by_date",
    "gold_trades",
    "daily_metrics",
    "end_to_end",
    "daily_max_drawdown",
    "daily_sharpe",
    "stream_bronze_count",
    "stream_silver_split",
    "stream_daily_metrics",
)


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerlake-bench")
    local = {
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def dealt(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events of ``sf_dir`` in as many files as there are cores."""
    folder = tempfile.mkdtemp(prefix="bench-")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    events.repartition(cores).write.parquet(f"{folder}/events.parquet")
    return folder


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    name = float(Path(sf_dir).name.removeprefix("sf"))
    try:
        if not os.environ.get("BENCH_AS_IS"):
            sf_dir = dealt(spark, sf_dir)
        rounds = [{name: timed(spark, sf_dir, name) for name in HEADLINES} for _ in range(runs)]
    finally:
        spark.stop()
    seconds = {name: round(min(each[name] for each in rounds), 3) for name in HEADLINES}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": name,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
