"""Versioned reference rows with validity ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def build_history(versions: DataFrame, key: str, version: str, attributes: Sequence[str]) -> DataFrame:
    """Collapse dated full copies of a reference table into one row per change.

    ``valid_from`` is the date a set of values first appears, ``valid_to`` the date the next set
    replaces it (exclusive, NULL while current). A copy that repeats the values opens no new range.
    """
    order = Window.partitionBy(key).orderBy(version)
    before = [F.lag(name).over(order).alias(f"_{name}") for name in attributes]
    changed = reduce(
        lambda a, b: a | b, [~F.col(name).eqNullSafe(F.col(f"_{name}")) for name in attributes]
    )
    starts = Window.partitionBy(key).orderBy("valid_from")
    return (
        versions.select(key, version, *attributes, F.row_number().over(order).alias("_n"), *before)
        .filter((F.col("_n") == 1) | changed)
        .select(key, *attributes, F.col(version).alias("valid_from"))
        .withColumn("valid_to", F.lead("valid_from").over(starts))
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def current_rows(history: DataFrame) -> DataFrame:
    """The reference table as of now."""
    return history.filter("is_current").drop("valid_from", "valid_to", "is_current")
