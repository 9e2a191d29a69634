"""Gold tables in the session catalog, for ad-hoc SQL."""

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerlake.plans.paths import LakePaths
from ledgerlake.schemas import GOLD_DAILY_METRICS, GOLD_DAILY_RISK, GOLD_TRADES
from ledgerlake.sources.commits import Part
from ledgerlake.sources.tables import is_version, parts


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def register_gold(spark: SparkSession, paths: LakePaths, database: str = "gold") -> None:
    """Declare ``trades``, ``daily_metrics`` and ``daily_risk``.

    A table written as a whole is an external table, and one that is already there is pointed at
    the files that count now. Trades of loads are a view, with the declared columns, over one
    external table for each part that counts. A table with another schema is declared
    anew; its files are no concern of the catalog.
    """
    # The database has no place in the lake: dropping it must not delete the lake's files.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    for name, schema, path in (
        ("trades", GOLD_TRADES, paths.gold_trades),
        ("daily_metrics", GOLD_DAILY_METRICS, paths.gold_daily_metrics),
        ("daily_risk", GOLD_DAILY_RISK, paths.gold_daily_risk),
    ):
        counting = parts(spark, path)
        if len(counting) == 1 and is_version(counting[0]):
            _drop_other(spark, database, name, "EXTERNAL")
            _declare(spark, _name(database, name), schema, f"{path}/{counting[0].folder}")
        else:
            _drop_other(spark, database, name, "VIEW")
            _declare_parts(spark, database, name, schema, path, counting)


def _drop_other(spark: SparkSession, database: str, name: str, kind: str) -> None:
    known = {x.name: x.tableType for x in spark.catalog.listTables(database)}
    if known.get(name, kind) != kind:
        what = "VIEW" if known[name] == "VIEW" else "TABLE"
        spark.sql(f"DROP {what} {_name(database, name)}")


def _declare_parts(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType,
    path: str,
    counting: list[Part],
) -> None:
    columns = ", ".join(schema.names)
    full = T.StructType([*schema, T.StructField("of_load", T.StringType())])
    selects, kept = [], set()
    for part in counting:
        own = f"{name}_{part.folder.rpartition('~')[2]}"
        _declare(spark, _name(database, own), full, f"{path}/{part.folder}")
        gone = ", ".join(_quoted(x) for x in part.without)
        where = f" WHERE coalesce(of_load, '') NOT IN ({gone})" if gone else ""
        selects.append(f"SELECT {columns} FROM {_name(database, own)}{where}")
        kept.add(own)
    nothing = ", ".join(f"CAST(NULL AS {x.dataType.simpleString()}) AS {x.name}" for x in schema)
    query = " UNION ALL ".join(selects) or f"SELECT {nothing} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {_name(database, name)} AS {query}")
    for table in spark.catalog.listTables(database):
        if table.name.startswith(f"{name}_") and table.name not in kept:
            spark.sql(f"DROP TABLE {_name(database, table.name)}")


def _declare(spark: SparkSession, table: str, schema: T.StructType, location: str) -> None:
    if spark.catalog.tableExists(table):
        known = [(x.name, x.dataType) for x in spark.table(table).schema]
        if known != [(x.name, x.dataType) for x in schema]:
            spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    place = _quoted(location)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET LOCATION {place}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {place}")
    spark.catalog.refreshTable(table)
