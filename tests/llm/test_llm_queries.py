"""The registered queries: one for each operator, and those that SQL can express against it."""

import re

import __spark_entry__ as entry
import pytest
from oracle import connect, rows_of_duckdb, rows_of_spark

from ledgerlake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    numbers = sorted(int(m[1]) for name in QUERIES if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14))
    assert "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries())
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    columns, rows = rows_of_spark(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected_rows = rows_of_duckdb(connect(SF_DIR), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows
