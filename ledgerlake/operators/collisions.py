"""Colliding ids: flag every copy, then resolve by an explicit policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import HOT_ROWS, hot_keys, left_join_spread
from ledgerlake.operators.ranks import group_sizes, top_one

# The policy names.
QUARANTINE_ALL = "quarantine_all"
KEEP_EARLIEST = "keep_earliest"
POLICIES = (QUARANTINE_ALL, KEEP_EARLIEST)


def flag_collisions(df: DataFrame, key: str, flag: str, occurrences: str) -> DataFrame:
    """Attach how often a required key occurs and whether it occurs more than once. Keeps every row.

    Sizes are counted with map-side combine and only ids that occur more than once are joined back,
    so a heavily repeated id is never gathered in one task, as a window over the key would do.
    """
    repeated = group_sizes(df.select(key), [key]).filter("_n > 1")
    return (
        left_join_spread(df, repeated, key, ["_n"], flag)
        .withColumn(occurrences, F.coalesce("_n", F.lit(1)).cast("bigint"))
        .drop("_n")
    )


def rows_with_unique_key(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows whose key no other row has, partitioned by the key for the joins that follow.

    Rows of the few hot ids leave before anything is shuffled, by a broadcast of those ids. All others
    meet the repeated ids, which lie by the same key since they were counted.
    """
    sizes = group_sizes(df.select(key), [key])
    repeated = sizes.filter("_n > 1")
    # The rows are counted as they are, not by adding up the sizes, which Spark would make once more for it.
    hot = hot_keys(repeated, df.agg(F.count(F.lit(1))).scalar(), hot_rows).select(key)
    return df.join(F.broadcast(hot), key, "left_anti").join(repeated.select(key), key, "left_anti")


def resolve_collisions(df: DataFrame, key: str, policy: str, order: Sequence[Column]) -> DataFrame:
    """Drop all copies of a repeated id, or keep the first by ``order``, which should be total."""
    if policy == QUARANTINE_ALL:
        return rows_with_unique_key(df, key)
    if policy == KEEP_EARLIEST:
        return top_one(df, [key], order)
    raise ValueError(f"collision policy must be one of {POLICIES}, not {policy!r}")
