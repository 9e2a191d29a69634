"""Run the batch job: ``python -m ledgerlake --landing ... --root ... --load-id ...``."""

import argparse
import time

from pyspark.sql import SparkSession

from ledgerlake.plans.paths import LakePaths
from ledgerlake.plans.stages import run
from ledgerlake.session import SETTINGS
from ledgerlake.sources.catalog import register_gold


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerlake", description="Landing to gold.")
    parser.add_argument("--landing", required=True, help="folders load_id=... of JSON lines")
    parser.add_argument("--root", required=True, help="root directory of the lake")
    parser.add_argument("--load-id", required=True, help="name of this batch of lines")
    parser.add_argument("--database", default="gold", help="database of the gold tables")
    parser.add_argument("--schema-version", type=int, default=1, help="payload version")
    parser.add_argument("--once", action="store_true", help="leave out lines delivered again")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName("ledgerlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    started = time.monotonic()
    try:
        paths = LakePaths(args.landing, args.root)
        counted = run(spark, paths, args.load_id, args.schema_version, args.once)
        for feed, counts in counted.items():
            print(f"{feed}: {counts}")
        register_gold(spark, paths, args.database)
        print(f"took {time.monotonic() - started:.2f} s")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
