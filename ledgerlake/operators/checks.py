"""Data tests: each returns the rows that violate it, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import semi_join_spread
from ledgerlake.operators.ranks import group_sizes


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with how often."""
    return group_sizes(df.filter(F.col(column).isNotNull()), [column], "n_records").filter("n_records > 1")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with how often."""
    return group_sizes(df, columns, "n_records").filter("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    present = child.filter(F.col(column).isNotNull())
    return semi_join_spread(present, parent.select(F.col(field).alias(column)).distinct(), column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with how often. NULL is not judged."""
    return group_sizes(df.filter(~F.col(column).isin(*values)), [column], "n_records")
