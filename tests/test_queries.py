"""Every registered query against SQL that computes it from the table directly."""

from functools import lru_cache

import __spark_entry__ as entry
import pytest
from oracle import connect, rows_of_duckdb, rows_of_spark

from testbench.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@lru_cache
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, name):
    columns, rows = rows_of_spark(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected_rows = rows_of_duckdb(duck(), entry.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
