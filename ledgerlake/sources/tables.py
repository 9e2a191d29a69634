"""Parquet tables of the lake.

Every read names its schema: nothing is inferred from footers or directory names, and a
table that got no rows reads as empty instead of failing.

Tables consist of parts, and the lake's commits say which of them count (``commits``). A load
writes a new folder in each of its tables, and one commit makes all of them visible. Writing a load
again replaces it, in all tables at once; different loads add up. Readers that began before go
on with the folders they know, which are deleted later (``sweep``).

Parts are merged by tiers: ``FANOUT`` parts of a like number of loads become one. So a table of n
loads has some ``FANOUT * log(n)`` parts, and a row is rewritten ``log(n)`` times, whether loads come
from batch jobs or streams. A merge commits only if its parts still count as it read them, so it
may run beside loads and readers.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Self

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.quality import CLEAN, QUARANTINE, with_verdict
from ledgerlake.plans.paths import load_folder
from ledgerlake.schemas import (
    ACCOUNT_EVENTS,
    BALANCES,
    BRONZE,
    EQUITY_INSTANTS,
    EQUITY_MINUTES,
    GOLD_DAILY_METRICS,
    GOLD_DAILY_RISK,
    GOLD_TRADES,
    POSITIONS,
    SILVER_ACCOUNT,
    SILVER_ORDERS,
    TRADE_DAYS,
)
from ledgerlake.sources import storage
from ledgerlake.sources.commits import (
    Change,
    Part,
    State,
    commit,
    due,
    holds,
    new_folder,
    place,
    read_state,
    together,
)

_LOAD = T.StructField("load_id", T.StringType())
_OF_LOAD = T.StructField("of_load", T.StringType())
_VERDICT = T.StructField("verdict", T.StringType())
BY_DAY = ("verdict", "event_time")
#: Parts of like weight that are merged into one.
FANOUT = 8
#: Bytes of a part that is large enough to stay as it is.
FULL_PART = 64 << 30
#: Bytes of a merged file of a table without partitions.
MERGED_FILE = 64 << 20
#: Newest loads of a stream that are not summed up with others yet, for replays.
KEPT_LOADS = 5
#: Seconds that folders stay which count no longer, for readers that know them.
GRACE = 900.0


class Load:
    """One load's parts in any number of tables, made visible by one commit.

    Used as a context: the end of it commits, and a failure inside deletes what was written.
    """

    def __init__(self, spark: SparkSession, load_id: str):
        load_folder("", load_id)
        self.spark, self.load_id = spark, load_id
        self.facts: dict = {}
        self.blooms: dict[str, tuple[str, ...]] = {}
        self._folders: dict[str, str] = {}

    def write(
        self,
        rows: DataFrame,
        path: str,
        partitions: tuple[str, ...] = (),
        blooms: tuple[str, ...] = (),
    ) -> None:
        """Write the load's rows of a table; they count when the load is committed.

        Row groups get bloom filters on the columns ``blooms``, or on the table's in ``blooms``.
        """
        folder = new_folder(self.load_id)
        self._folders[path] = folder
        writer = _writer(rows, blooms or self.blooms.get(path, ()))
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(f"{path}/{folder}")

    def read(self, path: str, schema: T.StructType) -> DataFrame:
        """The rows as written, before the commit."""
        return self.spark.read.schema(schema).parquet(f"{path}/{self._folders[path]}")

    def __enter__(self) -> Self:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self._commit()
        else:
            for path, folder in self._folders.items():
                storage.delete(self.spark, f"{path}/{folder}")

    def _commit(self) -> None:
        change = Change(facts={self.load_id: self.facts} if self.facts else {})
        logs = set()
        for path, folder in self._folders.items():
            log, table = place(path)
            logs.add(log)
            bytes_ = storage.size(self.spark, f"{path}/{folder}")
            change.put[table] = [Part(folder, together([self.load_id]), bytes_)]
        (log,) = logs
        commit(self.spark, log, lambda _: change)


def bronze_into(load: Load, bronze: DataFrame, path: str) -> None:
    """Add bronze rows to a load, by event type and date.

    Landing files are tiny and in arrival order, so rows are brought together by
    partition first. ``rebalance`` sizes tasks at run time: it splits a type and date
    that holds much of the data over many tasks and merges the small ones.
    """
    days = ("event_type", "event_date")
    load.write(bronze.hint("rebalance", *days), path, days)


def write_bronze(bronze: DataFrame, path: str, load_id: str) -> None:
    """Write one load of bronze by itself; see :func:`bronze_into`."""
    with Load(bronze.sparkSession, load_id) as load:
        bronze_into(load, bronze, path)


def read_bronze(spark: SparkSession, path: str, load_id: str | None = None) -> DataFrame:
    """Bronze rows of one load, or all rows, whether loaded or streamed."""
    if load_id is None and not visible_loads(spark, path):
        return spark.read.schema(BRONZE).parquet(path)
    loads = None if load_id is None else [load_id]
    return read_loads(spark, path, BRONZE, loads).drop("load_id")


def write_load(rows: DataFrame, path: str, load_id: str) -> None:
    """Write one load of a table that has no other partitions."""
    with Load(rows.sparkSession, load_id) as load:
        load.write(rows, path)


def silver_into(
    load: Load, silver: DataFrame, required: tuple[str, ...], path: str
) -> dict[str, int]:
    """Add rows of a silver table to a load and return the clean and quarantined counts.

    Clean and quarantined rows go out in one pass, as two partitions, so lines are
    parsed once and nothing is cached. There is no shuffle: bronze files already hold
    one type and date each.
    """
    counts = Observation()
    rows = silver.transform(with_verdict, required).observe(
        counts,
        F.count_if(F.col("verdict") == CLEAN).alias(CLEAN),
        F.count_if(F.col("verdict") == QUARANTINE).alias(QUARANTINE),
    )
    load.write(rows, path, BY_DAY)
    return counts.get


def write_silver(
    silver: DataFrame, required: tuple[str, ...], path: str, load_id: str
) -> dict[str, int]:
    """Add one load to a silver table by itself; see :func:`silver_into`."""
    with Load(silver.sparkSession, load_id) as load:
        return silver_into(load, silver, required, path)


def _state(spark: SparkSession, path: str) -> tuple[State, str, str]:
    log, table = place(path)
    return read_state(spark, log), log, table


def visible_loads(spark: SparkSession, path: str) -> list[str]:
    """Ids of the loads that count."""
    state, _, table = _state(spark, path)
    return state.loads(table)


def parts(spark: SparkSession, path: str) -> list[Part]:
    """The folders that count."""
    state, _, table = _state(spark, path)
    return state.of(table)


def facts_of(spark: SparkSession, path: str, load_id: str) -> dict:
    """What was written down with a load."""
    return _state(spark, path)[0].facts.get(load_id, {})


def read_loads(
    spark: SparkSession, path: str, schema: T.StructType, loads: list[str] | None = None
) -> DataFrame:
    """Rows of the given or of all visible loads, with their load ids."""
    chosen = parts(spark, path)
    if loads is not None:
        chosen = [x for x in chosen if any(holds(x.loads, load) for load in loads)]
    rows = _read_parts(spark, path, schema, chosen)
    return rows if loads is None else rows.where(F.col("load_id").isin(loads))


def _read_parts(
    spark: SparkSession, path: str, schema: T.StructType, chosen: list[Part]
) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], T.StructType([*schema, _LOAD]))
    reader = spark.read.schema(T.StructType([*schema, _OF_LOAD, _LOAD])).option("basePath", path)
    rows = reader.parquet(*[f"{path}/{part.folder}" for part in chosen])
    for part in chosen:
        if part.without:
            here = F.col("load_id") == part.folder.removeprefix("load_id=")
            rows = rows.where(~(here & F.col("of_load").isin(list(part.without))))
    load = F.coalesce("of_load", F.substring_index("load_id", "~", 1))
    return rows.select(*schema.names, load.alias("load_id"))


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: tuple[str, ...] = (),
    fanout: int = FANOUT,
    grace: float = GRACE,
    full: int = FULL_PART,
    order: tuple[str, ...] = (),
    blooms: tuple[str, ...] = (),
) -> int:
    """Merge parts until no tier of them is due; returns the bytes written.

    With ``order``, rows are dealt by ranges of those columns and sorted in them, so that a
    merged part's files and row groups can be skipped by their statistics. With partitions, rows
    are dealt by those. Otherwise files are put together as they are, without a shuffle.

    A failure before the commit changes nothing that is read, and running it again is
    safe, also beside loads.
    """
    columns = [T.StructField(x, T.StringType()) for x in partitions if x not in schema.names]
    schema = T.StructType([*schema, *columns])

    def merged(rows: DataFrame) -> DataFrame:
        rows = rows.withColumnRenamed("load_id", "of_load")
        if order:
            return rows.repartitionByRange(*order).sortWithinPartitions(*order)
        if partitions:
            return rows.hint("rebalance", *partitions)
        return rows.coalesce(sum(part.size for part in chosen) // MERGED_FILE + 1)

    written = 0
    while chosen := due(parts(spark, path), fanout, full):
        size = _merge(spark, path, schema, chosen, merged, partitions, False, blooms)
        if size is None:
            break
        written += size
    sweep(spark, path, grace)
    return written


def sum_up(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    name: str,
    sums: Callable[[DataFrame], DataFrame],
    keep: int = KEPT_LOADS,
    fanout: int = FANOUT,
    grace: float = GRACE,
) -> None:
    """Merge a stream's loads of a table of sums, and add them up: one row a key for all of them.

    The newest loads stay as they are, since a micro-batch may be replayed; summed ones can't be
    replaced any more, and what was written down with them is forgotten.
    """

    def ours() -> list[Part]:
        own = [x for x in parts(spark, path) if not isinstance(x.loads[-1], str)]
        own = [x for x in own if len(x.loads) == 1 and x.loads[0][0] == name]
        own.sort(key=lambda x: x.loads[0][1])
        return own[: max(0, len(own) - keep)]

    while chosen := due(ours(), fanout, FULL_PART):
        merged = lambda rows: sums(rows.drop("load_id")).coalesce(1)
        if _merge(spark, path, schema, chosen, merged, (), summed=True) is None:
            break
    sweep(spark, path, grace)


def _writer(rows: DataFrame, blooms: tuple[str, ...]) -> DataFrameWriter:
    """Files in zstd, since lines are kept in several tables and are rewritten by merges.

    Bloom filters are as large as a row group's distinct values need, up to a megabyte.
    """
    writer = rows.write.option("compression", "zstd")
    if blooms:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def _merge(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    chosen: list[Part],
    make: Callable[[DataFrame], DataFrame],
    partitions: tuple[str, ...],
    summed: bool,
    blooms: tuple[str, ...] = (),
) -> int | None:
    """Write the parts' rows as one part in their place; None if they changed meanwhile."""
    log, table = place(path)
    folder = new_folder("_merged")
    writer = _writer(make(_read_parts(spark, path, schema, chosen)), blooms)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/{folder}")
    size = storage.size(spark, f"{path}/{folder}")
    loads = [load for part in chosen for load in part.counting()]
    new = Part(folder, together(loads), size, summed=summed)

    def make_change(state: State) -> Change | None:
        if any(part not in state.of(table) for part in chosen):
            return None
        dropped = [part.folder for part in chosen]
        forgotten = [x for x in loads if x in state.facts] if summed else []
        return Change(
            put={table: [new]}, drop={table: dropped}, forget_facts=forgotten, merge=True
        )

    if new not in commit(spark, log, make_change).of(table):
        storage.delete(spark, f"{path}/{folder}")
        return None
    return size


def sweep(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Delete folders that have not counted for so many seconds."""
    state, log, table = _state(spark, path)
    old = [x for x, at in state.gone.get(table, {}).items() if at <= time.time() - grace]
    for folder in old:
        storage.delete(spark, f"{path}/{folder}")
    if old:
        commit(spark, log, lambda _: Change(forget={table: old}))


def claim_name(spark: SparkSession, path: str, name: str, owner: str) -> None:
    """Make a stream the owner of a name of loads; fail if another one is.

    A stream that starts over on a new checkpoint is another one: its load 0 would replace
    the old load 0 and leave the others, so that rows count twice.
    """
    place = f"{path}_owners/{name}"
    if not storage.create_text(spark, place, owner):
        known = storage.read_text(spark, place)
        if known != owner:
            raise ValueError(
                f"loads {name!r} of {path} belong to stream {known}, not to {owner}: "
                "start from its checkpoint, or name the new stream's loads differently"
            )


def _read_silver(spark: SparkSession, path: str, schema: T.StructType, verdict: str) -> DataFrame:
    rows = read_loads(spark, path, T.StructType([*schema, _VERDICT]))
    return rows.where(F.col("verdict") == verdict).select(*schema.names)


def read_silver_orders(spark: SparkSession, path: str) -> DataFrame:
    """Clean order rows of all loads."""
    return _read_silver(spark, path, SILVER_ORDERS, CLEAN)


def read_silver_account(spark: SparkSession, path: str) -> DataFrame:
    """Clean account rows of all loads."""
    return _read_silver(spark, path, SILVER_ACCOUNT, CLEAN)


def read_quarantine(spark: SparkSession, orders_path: str, account_path: str) -> DataFrame:
    """Quarantined rows of both feeds, with all columns of both and the feed's name."""
    orders = _read_silver(spark, orders_path, SILVER_ORDERS, QUARANTINE)
    account = _read_silver(spark, account_path, SILVER_ACCOUNT, QUARANTINE)
    return orders.withColumn("feed", F.lit("orders")).unionByName(
        account.withColumn("feed", F.lit("account")), allowMissingColumns=True
    )


def read_account_events(
    spark: SparkSession, path: str, load_id: str | None = None
) -> DataFrame:
    """Parsed account updates, one row each, of one load or of all."""
    rows = read_loads(spark, path, ACCOUNT_EVENTS, None if load_id is None else [load_id])
    return rows.drop("load_id")


def read_balances(spark: SparkSession, path: str) -> DataFrame:
    """Every balance of every account update once."""
    return read_loads(spark, path, BALANCES).drop("load_id")


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Every position of every account update once."""
    return read_loads(spark, path, POSITIONS).drop("load_id")


def read_trade_days(
    spark: SparkSession, path: str, without: str | None = None
) -> DataFrame:
    """Sums by day of all loads, but for one."""
    rows = read_loads(spark, path, TRADE_DAYS)
    if without is not None:
        rows = rows.where(F.col("load_id") != without)
    return rows.drop("load_id")


def read_late_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trades of all loads that came when their day was over."""
    return read_loads(spark, path, GOLD_TRADES).drop("load_id")


def read_equity_minutes(spark: SparkSession, path: str) -> DataFrame:
    """Each load's summary of each minute of the equity curve, with its load."""
    return read_loads(spark, path, EQUITY_MINUTES)


def read_equity_instants(spark: SparkSession, path: str) -> DataFrame:
    """Least and greatest equity of each instant, by load."""
    return read_loads(spark, path, EQUITY_INSTANTS)


def _kinds(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(x.name, x.dataType) for x in schema]


def check_contract(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """The rows, if they have the contract's columns."""
    if _kinds(rows.schema) != _kinds(contract):
        raise ValueError(f"{rows.schema.simpleString()} is not {contract.simpleString()}")
    return rows


# No load has such a name.
_VERSION = "_version"


def write_gold(gold: DataFrame, path: str, contract: T.StructType) -> None:
    """Replace a gold table by rows that fit its contract; see :func:`write_golds`."""
    write_golds(gold.sparkSession, {path: (gold, contract)})


def write_golds(
    spark: SparkSession, tables: dict[str, tuple[DataFrame, T.StructType]]
) -> None:
    """Replace gold tables, by path, all of them in one commit.

    The rows go to new folders. Readers and failures in between meet the old tables. The folders
    before the old ones are deleted.
    """
    for rows, contract in tables.values():
        check_contract(rows, contract)
    new, before = {path: new_folder(_VERSION) for path in tables}, {}
    keep = inheritable_thread_target(spark)
    try:
        with ThreadPoolExecutor(len(tables)) as pool:
            writes = [
                pool.submit(keep(rows.write.parquet), f"{path}/{new[path]}")
                for path, (rows, _) in tables.items()
            ]
        for write in writes:
            write.result()
    except BaseException:
        for path, folder in new.items():
            storage.delete(spark, f"{path}/{folder}")
        raise
    log = {place(path)[0] for path in tables}.pop()
    sizes = {path: storage.size(spark, f"{path}/{new[path]}") for path in tables}

    def make_change(state: State) -> Change:
        change = Change(merge=True)
        for path in tables:
            table = place(path)[1]
            before[path] = list(state.gone.get(table, {}))
            change.put[table] = [Part(new[path], (_VERSION,), sizes[path])]
            change.drop[table] = [part.folder for part in state.of(table)]
            change.forget[table] = before[path]
        return change

    commit(spark, log, make_change)
    for path, folders in before.items():
        for folder in folders:
            storage.delete(spark, f"{path}/{folder}")


def is_version(part: Part) -> bool:
    """Whether a part is a whole gold table, not one of a load."""
    return part.loads == (_VERSION,)


def read_gold(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return read_loads(spark, path, contract).drop("load_id")


def read_gold_trades(spark: SparkSession, path: str) -> DataFrame:
    return read_gold(spark, path, GOLD_TRADES)


def read_gold_daily_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_gold(spark, path, GOLD_DAILY_METRICS)


def read_gold_daily_risk(spark: SparkSession, path: str) -> DataFrame:
    return read_gold(spark, path, GOLD_DAILY_RISK)
