"""Distribution findings: correlation, quantile groups and shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.money import ratio
from ledgerlake.session import stage


def correlation(df: DataFrame, x: str, y: str, name: str = "correlation") -> DataFrame:
    return df.agg(F.corr(x, y).alias(name))


def quantile_profile(df: DataFrame, by: str, measure: str, groups: int = 5) -> DataFrame:
    """Split rows into equal groups by rank of a column; rows, bounds and mean of a measure per group.

    Exact, and no task sees the whole column. Equal values always share a group, so the rows first
    collapse to one per distinct value. These are cut into ranges of like size, whatever their
    distribution, and stored with the number of their range. The rank of a value is the count of all
    smaller ones: those in lower ranges plus those before it in its own.
    """
    values = stage(
        df.filter(F.col(by).isNotNull())
        .groupBy(F.col(by).alias("_value"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(measure).alias("_sum"),
            F.count(measure).alias("_known"),
        )
        .repartitionByRange("_value")
        .withColumn("_chunk", F.spark_partition_id()),
        "quantiles",
    )
    lower = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as many as there are shuffle partitions.
    chunks = (
        values.groupBy("_chunk")
        .agg(F.sum("_n").alias("_in_chunk"))
        .select(
            "_chunk",
            F.coalesce(F.sum("_in_chunk").over(lower), F.lit(0)).alias("_below"),
            F.sum("_in_chunk").over(Window.partitionBy()).alias("_total"),
        )
    )
    smaller = Window.partitionBy("_chunk").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("_below") + F.coalesce(F.sum("_n").over(smaller), F.lit(0))
    return (
        values.join(F.broadcast(chunks), "_chunk")
        .withColumn("quantile", (F.floor(rank * groups / F.col("_total")) + 1).cast("bigint"))
        .groupBy("quantile")
        .agg(
            F.sum("_n").alias("n_rows"),
            F.min("_value").alias(f"min_{by}"),
            F.max("_value").alias(f"max_{by}"),
            ratio(F.sum("_sum"), F.sum("_known")).alias(f"avg_{measure}"),
        )
    )


def share_of_total(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Rows and sum per group with their parts of the whole."""
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(measure).alias("total"))
    whole = groups.agg(F.struct(F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total")))
    return (
        groups.withColumn("_whole", whole.scalar())
        .withColumn("share_of_rows", ratio(F.col("n_rows"), F.col("_whole.n_rows")))
        .withColumn("share_of_total", ratio(F.col("total"), F.col("_whole.total")))
        .drop("_whole")
    )
