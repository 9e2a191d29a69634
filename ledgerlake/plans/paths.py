"""Where the tables of one lake live."""

import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import SparkSession

from ledgerlake.sources import storage


def load_folder(path: str, load_id: str) -> str:
    """The folder of one load in a table or in the landing directory."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", load_id):
        raise ValueError(f"load id {load_id!r} is no plain directory name")
    return f"{path}/load_id={load_id}"


@dataclass(frozen=True)
class LakePaths:
    """A landing directory of JSON lines and the root under which all tables are kept."""

    landing: str
    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def landed(self, load_id: str) -> str:
        """The lines of one batch load; streams read the landing directory itself."""
        return load_folder(self.landing.rstrip("/"), load_id)

    @property
    def bronze(self) -> str:
        return self._under("bronze")

    @property
    def line_digests(self) -> str:
        return self._under("line_digests")

    @property
    def streamed_bronze(self) -> str:
        return self._under("streamed_bronze")

    @property
    def silver_orders(self) -> str:
        return self._under("silver", "orders")

    @property
    def silver_account(self) -> str:
        return self._under("silver", "account")

    @property
    def account_events(self) -> str:
        return self._under("silver", "account_events")

    @property
    def balances(self) -> str:
        return self._under("silver", "balances")

    @property
    def positions(self) -> str:
        return self._under("silver", "positions")

    @property
    def trade_days(self) -> str:
        return self._under("silver", "trade_days")

    @property
    def late_trades(self) -> str:
        return self._under("silver", "late_trades")

    @property
    def equity_instants(self) -> str:
        return self._under("silver", "equity_instants")

    @property
    def equity_minutes(self) -> str:
        return self._under("silver", "equity_minutes")

    @property
    def gold(self) -> str:
        return self._under("gold")

    @property
    def gold_trades(self) -> str:
        return self._under("gold", "trades")

    @property
    def gold_daily_metrics(self) -> str:
        return self._under("gold", "daily_metrics")

    @property
    def gold_daily_risk(self) -> str:
        return self._under("gold", "daily_risk")

    def checkpoint(self, stream: str) -> str:
        return self._under("checkpoints", stream)


def scratch_lake(spark: SparkSession) -> LakePaths:
    """A new, empty lake in a folder that all executors share, deleted when the JVM ends.

    That folder is ``spark.checkpoint.dir``, which a cluster must name. A session without
    executors of its own has all its tasks on one machine, so there any folder is shared: the
    warehouse, if the other is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/ledgerlake/{uuid4().hex}"
    storage.delete_at_exit(spark, root)
    return LakePaths(landing=f"{root}/landing", root=f"{root}/lake")
