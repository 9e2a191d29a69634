import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from ledgerlake.plans.paths import LakePaths  # noqa: E402
from ledgerlake.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(shared / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def paths(tmp_path):
    return LakePaths(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"))
