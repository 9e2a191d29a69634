"""Required columns: predicates, split and verdict."""

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values of the verdict partition column.
CLEAN = "clean"
QUARANTINE = "quarantine"


def all_present(required: Iterable[str]) -> Column:
    """True when no required column is NULL, else false; never NULL."""
    return reduce(and_, (F.col(name).isNotNull() for name in required))


def any_missing(required: Iterable[str]) -> Column:
    """True when any required column is NULL, else false; never NULL."""
    return reduce(or_, (F.col(name).isNull() for name in required))


def clean_rows(df: DataFrame, required: Iterable[str]) -> DataFrame:
    return df.where(all_present(required))


def rejected_rows(df: DataFrame, required: Iterable[str]) -> DataFrame:
    return df.where(any_missing(required))


def split(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Clean and rejected rows; each row is in exactly one of the two."""
    return clean_rows(df, required), rejected_rows(df, required)


def has_rejects(df: DataFrame, required: Iterable[str]) -> bool:
    """Whether any row is rejected; stops at the first one."""
    return not rejected_rows(df, required).isEmpty()


def with_verdict(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Mark each row clean or quarantine, so that one pass can write both."""
    return df.withColumn("verdict", F.when(all_present(required), CLEAN).otherwise(QUARANTINE))
