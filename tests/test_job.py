import os
import subprocess
import sys
from pathlib import Path

import pytest
from events import trading_days
from pyspark.sql import SparkSession

from ledgerlake.__main__ import arguments
from ledgerlake.plans.paths import LakePaths, scratch_lake
from ledgerlake.sources.tables import read_gold_daily_metrics


def test_arguments_take_both_forms():
    args = arguments(["--landing", "s3://in", "--root=s3://lake", "--load-id", "2025-03-17"])
    assert (args.landing, args.root, args.load_id) == ("s3://in", "s3://lake", "2025-03-17")
    assert args.schema_version == 1


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        arguments(["--landing", "in", "--root", "lake"])


def test_paths_join_with_one_slash():
    paths = LakePaths("in", "s3://lake/")
    assert paths.bronze == "s3://lake/bronze"
    assert paths.silver_orders == "s3://lake/silver/orders"
    assert paths.gold_daily_metrics == "s3://lake/gold/daily_metrics"
    assert paths.checkpoint("bronze") == "s3://lake/checkpoints/bronze"


def test_scratch_lakes_are_new_and_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_lake(spark), scratch_lake(spark)
    assert first.root != second.root
    assert first.root.startswith(shared.rstrip("/") + "/")


def test_session_is_left_open(spark):
    assert SparkSession.getActiveSession() is not None


def test_command_line_run(spark, paths):
    Path(paths.landed("2025-03-17")).mkdir(parents=True)
    (Path(paths.landed("2025-03-17")) / "1.jsonl").write_text("\n".join(trading_days()) + "\n")
    Path(paths.root + "-job").mkdir()
    done = subprocess.run(
        [sys.executable, "-m", "ledgerlake", "--landing", paths.landing, "--root", paths.root]
        + ["--load-id", "2025-03-17"],
        cwd=paths.root + "-job",
        env=os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])},
        capture_output=True,
        text=True,
        check=True,
        timeout=300,
    )
    assert "orders: {'clean': 10, 'quarantine': 0}" in done.stdout
    assert read_gold_daily_metrics(spark, paths.gold_daily_metrics).count() == 3
