"""As-of left joins: for each left row the newest right row of the same key at or before its time.

The right side must be unique per (key, time). Every left row comes out exactly once; rows with a
NULL key or time, or older than the key's first right row, come out with NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ledgerlake.operators.joins import fresh, spread, tagged

# Steps of the periods that validity intervals are cut into.
PERIOD_STEPS = {
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTHS",
    "year": "INTERVAL 1 YEAR",
}


def validity_intervals(right: DataFrame, by: str, time: str) -> DataFrame:
    """Add ``_until``, the key's next time, NULL for the newest row: each row holds on [time, _until).

    With dates a key has at most one row per day of the calendar, and one window over the key is
    small. With timestamps a key may have any number of rows, so the window covers a day of a key,
    and only the first time of each day meets the other days.
    """
    usable = right.filter(F.col(by).isNotNull() & F.col(time).isNotNull())
    if _is_date(right, time):
        return usable.withColumn("_until", F.lead(time).over(Window.partitionBy(by).orderBy(time)))
    by_day = usable.withColumn("_day", F.to_date(time))
    next_days = (
        by_day.groupBy(by, "_day")
        .agg(F.min(time).alias("_opens"))
        .select(by, "_day", F.lead("_opens").over(Window.partitionBy(by).orderBy("_day")).alias("_next"))
    )
    in_day = Window.partitionBy(by, "_day").orderBy(time)
    return (
        by_day.join(next_days, [by, "_day"], "left")
        .withColumn("_until", F.coalesce(F.lead(time).over(in_day), F.col("_next")))
        .drop("_day", "_next")
    )


def join_validity(
    left: DataFrame, intervals: DataFrame, by: str, at: str, start: str, until: str, columns: Sequence[str]
) -> DataFrame:
    """Left join each row to the interval of its key that holds ``at``; intervals must not overlap.

    A key that holds much of the left side, or none in most rows, is spread over tasks.
    """
    right = intervals.select(
        tagged(F.col(by)).alias("_by"), F.col(start).alias("_from"), F.col(until).alias("_until"), *fresh(columns)
    )
    matches = (
        (F.col("_key") == F.col("_by"))
        & (F.col(at) >= F.col("_from"))
        & (F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    )
    keyed = left.withColumn("_key", spread(F.col(by)))
    return keyed.join(right, matches, "left").drop("_key", "_by", "_from", "_until")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    period: str = "month",
    span: DataFrame | None = None,
) -> DataFrame:
    """As-of left join by validity intervals cut into calendar periods; adds ``columns``.

    The join is an equi join on (key, period) with the interval test as a residual. A key that holds
    much of the left side is spread over the periods, what is left of it is split by AQE, and a row is
    only compared with the few right rows of its own period instead of the key's whole history.

    Choose the period near the spacing of the right rows: a longer one means more comparisons, a shorter
    one more copies of a range. Right rows that no left time can reach are dropped first. ``span`` is
    any cheaper frame with the column ``left_time`` that covers the left times, such as the stored table
    behind ``left``. ``columns`` may include ``right_time``, which tells how old the answer is.

    The right side is never broadcast: Spark guesses its size from the files before ranges are cut, and a guess that
    is far too low would send the whole series through the driver.
    """
    covered = left if span is None else span
    reach = covered.agg(
        F.struct(F.to_date(F.min(left_time)).alias("first"), F.to_date(F.max(left_time)).alias("last"))
    )
    # The end is exclusive: a range that ends where a period starts does not reach into it.
    last_moment = F.col("_until").cast("timestamp_ntz") - F.expr("INTERVAL 0.000001 SECOND")
    cut = (
        validity_intervals(right, by, right_time)
        .withColumn("_reach", reach.scalar())
        .withColumn("_first", F.to_date(right_time))
        .withColumn("_last", F.coalesce(F.to_date(last_moment), F.col("_reach.last")))
        .filter("_first <= _reach.last AND _last >= _reach.first")
        .withColumn(
            "_period",
            F.explode(
                F.sequence(
                    F.trunc(F.greatest("_first", "_reach.first"), period),
                    F.trunc(F.least("_last", "_reach.last"), period),
                    F.expr(PERIOD_STEPS[period]),
                )
            ),
        )
        .select(
            F.col(by).alias("_by"), F.col(right_time).alias("_from"), "_until", "_period", *fresh(columns)
        )
    )
    matches = (
        (F.col(by) == F.col("_by"))
        & (F.trunc(F.to_date(left_time), period) == F.col("_period"))
        & (F.col(left_time) >= F.col("_from"))
        & (F.col("_until").isNull() | (F.col(left_time) < F.col("_until")))
    )
    return left.join(cut.hint("merge"), matches, "left").drop("_by", "_from", "_until", "_period")


def asof_join_sorted(
    left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, columns: Sequence[str]
) -> DataFrame:
    """As-of left join by sorting, for long histories with few distinct left times.

    Only the distinct (key, time) pairs of the left side are sorted together with the right rows, so a
    group is as large as a key's history, not as its rows. With timestamps it is a day of the history:
    each day starts with the newest row of the days before it. The answer is joined back by equality.
    """
    known = right.filter(F.col(by).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(by).alias("_by"),
        F.col(right_time).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*columns).alias("_row"),
    )
    asked = (
        left.select(F.col(by).alias("_by"), F.col(left_time).alias("_at"))
        .filter("_by IS NOT NULL AND _at IS NOT NULL")
        .distinct()
        .withColumn("_side", F.lit(1))
        .withColumn("_row", F.lit(None).cast(known.schema["_row"].dataType))
    )
    if _is_date(left, left_time):
        answered = _last_known(known.unionByName(asked), ["_by"])
    else:
        both = known.unionByName(asked).withColumn("_day", F.to_date("_at"))
        earlier = Window.partitionBy("_by").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
        opening = (
            both.groupBy("_by", "_day")
            .agg(
                F.max_by("_row", F.when(F.col("_side") == 0, F.col("_at"))).alias("_closing"),
                F.max("_side").alias("_asked"),
            )
            .withColumn("_row", F.last("_closing", ignorenulls=True).over(earlier))
            .filter("_asked = 1 AND _row IS NOT NULL")
            .select(
                "_by",
                F.col("_day").cast(both.schema["_at"].dataType).alias("_at"),
                F.lit(-1).alias("_side"),
                "_row",
                "_day",
            )
        )
        answered = _last_known(both.unionByName(opening), ["_by", "_day"])
    matches = (F.col(by) == F.col("_by")) & (F.col(left_time) == F.col("_at"))
    return left.join(answered.select("_by", "_at", "_row"), matches, "left").select(*left.columns, "_row.*")


def _last_known(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each asked time the newest known row at or before it within the group."""
    so_far = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_row", F.last("_row", ignorenulls=True).over(so_far)).filter("_side = 1")


def _is_date(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType == DateType()
