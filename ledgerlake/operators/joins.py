"""Joins that hold when a key is absent from, or repeated in, much of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Absent keys are spread over this many join keys.
SPREAD = 4096
# Parameters: a key is hot if it has at least this many rows, and at least one part in HOT_KEYS of all
# rows. The second condition means that there are never more than HOT_KEYS hot keys, however large the
# table.
HOT_ROWS = 100_000
HOT_KEYS = 100_000


def tagged(key: Column) -> Column:
    """The key in a form that no earlier shuffle or aggregation is partitioned by.

    AQE splits a hot key only where both sides of the join are shuffled for it. A side that comes from
    an aggregation or window on the same key would not be, and the hot key would stay in one task.
    """
    return F.concat(F.lit("k"), key.cast("string"))


def spread(key: Column) -> Column:
    """The tagged key, or a stand-in for a NULL, for the left side of a left join.

    Hot keys are split by AQE. NULL keys, which a plain left join hashes to one task, go to all tasks
    under stand-ins that no tagged key equals. A stand-in depends on the number of the map task only,
    so a rerun of a lost task sends the same rows to the same place.
    """
    stand_in = F.concat(F.lit("n"), F.pmod(F.spark_partition_id(), F.lit(SPREAD)).cast("string"))
    return F.coalesce(tagged(key), stand_in)


def left_join_spread(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], matched: str = "_matched"
) -> DataFrame:
    """Left join to a table with one row per key; adds ``columns`` and whether there was a match.

    Hot and NULL keys are spread, see spread().
    """
    keyed = left.withColumn("_join_key", spread(F.col(key)))
    other = right.select(tagged(F.col(key)).alias("_join_key"), *fresh(columns), F.lit(True).alias(matched))
    return (
        keyed.join(other, "_join_key", "left")
        .withColumn(matched, F.col(matched).isNotNull())
        .select(*left.columns, *columns, matched)
    )


def semi_join_spread(left: DataFrame, right: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Left rows whose key is (``left_semi``) or is not (``left_anti``) in the right table; hot keys are split."""
    other = right.select(tagged(F.col(key)).alias("_right_key"))
    return left.join(other, tagged(F.col(key)) == F.col("_right_key"), how)


def hot_keys(sizes: DataFrame, total: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys among ``sizes`` (with their count ``_n``) that hold a large part of ``total`` rows.

    Never more than HOT_KEYS rows, so the result may be broadcast.
    """
    return sizes.filter((F.col("_n") >= hot_rows) & (F.col("_n") >= total / HOT_KEYS))


def fresh(columns: Sequence[str]) -> list[Column]:
    """The columns under new identities, so that a right side drawn from the left's own table is safe."""
    return [F.col(name).alias(name) for name in columns]

