"""Top row per group and row numbers, both safe for a group that holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.joins import left_join_spread


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group. Spark cuts every map task to one row per group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "_n") -> DataFrame:
    """Rows per group, combined on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# Rows between two cuts, on average.
ROWS_PER_RANGE = 500_000


def cuts_below(cuts: Column, x: Column) -> Column:
    """How many of the sorted cuts are not above x, by binary search."""

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        below = F.get(cuts, middle) <= x
        return F.when(s["low"] >= s["high"], s).otherwise(
            F.struct(F.when(below, middle + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(middle).alias("high"))
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.coalesce(F.aggregate(steps, start, halve)["low"], F.lit(0))


def with_ranges(df: DataFrame, key: str, order: Sequence[str], name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds the number of the range of ``order`` that a row of a key falls into.

    The cuts between ranges are a sample of the rows themselves, taken by a hash of key and order, so every key has
    them in proportion to its rows and a rerun has the same ones. A range has ``rows_per_range`` rows on average.
    The plan knows nothing of sizes; no job runs to make it. Rows that agree in key and all of ``order`` share a
    range.
    """
    place = F.struct(*order)
    sampled = df.select(key, *order).filter(F.pmod(F.xxhash64(key, *order), F.lit(rows_per_range)) == 0)
    cuts = sampled.groupBy(key).agg(F.array_sort(F.collect_set(place)).alias("_cuts"))
    # A row in rows_per_range; hot keys are split.
    return left_join_spread(df, cuts, key, ["_cuts"]).withColumn(name, cuts_below(F.col("_cuts"), place)).select(*df.columns, name)


def number_rows(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str],
    number: str,
    size: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the rows of each group by (time, ties) and attach the group's size.

    No group is sorted in one piece, be all its rows at one instant. Rows are numbered inside ranges of
    (time, ties), see with_ranges(); the ranges of a key are counted with map-side combine, and the count
    of all earlier ranges is added as an offset. Keys with a single row, the usual case, need no offset and
    are left out of the offsets table, which keeps it small. The key must not be NULL; a NULL time stands
    first.
    """
    ranged = with_ranges(df, key, [time, *ties], "_range", rows_per_range)
    by_range = Window.partitionBy(key).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        group_sizes(ranged, [key, "_range"])
        .select(
            key,
            "_range",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_n").over(Window.partitionBy(key)).alias("_size"),
        )
        .filter("_size > 1")
    )
    inside = Window.partitionBy(key, "_range").orderBy(time, *ties)
    return (
        ranged.join(offsets, [key, "_range"], "left")
        .withColumn(
            number,
            (F.coalesce("_offset", F.lit(0)) + F.row_number().over(inside)).cast("bigint"),
        )
        .withColumn(size, F.coalesce("_size", F.lit(1)).cast("bigint"))
        .drop("_range", "_offset", "_size")
    )
