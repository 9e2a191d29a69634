"""Compare a Spark result with DuckDB's, exactly."""

import datetime
import decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    if name.startswith("timestamp"):
        return "timestamp"
    return {"varchar": "string", "integer": "int", "bool": "boolean"}.get(name, name)


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def _plain(value):
    if isinstance(value, (int, float, str, decimal.Decimal, datetime.date)) or value is None:
        return value
    raise TypeError(f"unexpected {type(value)} in a result")


def rows_of_spark(df: DataFrame) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(_plain(row[name]) for name in names) for row in df.collect()]
    return [(name, _kind(types[name])) for name in names], sorted(rows, key=_key)


def rows_of_duckdb(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    columns = [(result.columns[i], _kind(str(result.types[i]))) for i in order]
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return columns, sorted(rows, key=_key)
