"""Facts as they are stored: by period, and by buckets of the claim id, so that joins on it move the other side only.

A scan that reads a bucketed table for a join hands its rows on by bucket, whatever the periods; Spark then shuffles
the other side into as many buckets and the stored side not at all. A scan that filters on the period reads the
files of those periods only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A stored fact is partitioned by this column, the first day of its day, month or year.
PERIOD = "period_start"
# Parameter: a bucket of the whole table goes through one task of a join, so grow it with the table, and choose the
# grain so that a period's bucket is a file of good size. With fewer buckets than spark.sql.shuffle.partitions Spark
# prefers to shuffle both sides.
BUCKETS = 8


@dataclass(frozen=True)
class Layout:
    """How a fact is laid out; ``row`` spreads rows that have no key over writers."""

    row: str
    day: str = "date_day"
    key: str = "claim_id"
    grain: str = "year"
    buckets: int = BUCKETS

    def clauses(self) -> str:
        return f"PARTITIONED BY ({PERIOD}) CLUSTERED BY ({self.key}) INTO {self.buckets} BUCKETS"


FACTS: Mapping[str, Layout] = {"fct_claim": Layout("claim_id"), "fct_lookup": Layout("lookup_id")}


def period_of(day: Column, grain: str) -> Column:
    return day if grain == "day" else F.trunc(day, grain)


def arranged(frame: DataFrame, layout: Layout) -> DataFrame:
    """Rows with their period, brought to tasks so that a period's bucket becomes one file.

    Rows without a key all belong to one bucket of the table. They are written by as many tasks a period as there are
    buckets, in files that hold little else, so a join that needs a key passes over most of them by their statistics.
    """
    keyless = layout.buckets + F.pmod(F.hash(layout.row), F.lit(layout.buckets))
    part = F.when(F.col(layout.key).isNull(), keyless).otherwise(F.pmod(F.hash(layout.key), F.lit(layout.buckets)))
    period = period_of(F.col(layout.day), layout.grain)
    return frame.withColumns({PERIOD: period, "_part": part}).repartition(PERIOD, "_part").drop("_part")


def save(frame: DataFrame, table: str, path: str | None = None, layout: Layout | None = None, mode: str = "errorifexists") -> None:
    """Write a table, in its layout if it has one, into its database or to a path of its own."""
    writer = (arranged(frame, layout) if layout else frame).write.format("parquet").mode(mode)
    if layout:
        writer = writer.partitionBy(PERIOD).bucketBy(layout.buckets, layout.key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def buckets_of(spark: SparkSession, table: str) -> int | None:
    """How many buckets a stored table has, by the catalog; None if it has none."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return int(described["Num Buckets"]) if "Num Buckets" in described else None
