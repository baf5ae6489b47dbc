"""Landing: read any subset of the sources, route refused records aside, write, read back."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.quarantine import CONTRACTS, clean_rows, reject_rows
from ledgerlake.sources import reference
from ledgerlake.sources.events import LINEAGE, validated_stream

# Source names.
EVENT_SOURCES = ("claims", "reverts", "lookups")
TABLE_SOURCES = {"pharmacies": reference.pharmacies, "partners": reference.partners, "nadac": reference.prices}
ROUTE = "is_reject"


def write_quarantine(validated: DataFrame, path: str) -> None:
    """Store clean and refused records in one pass over the source, in two partitions of one table."""
    routed(validated).write.mode("overwrite").partitionBy(ROUTE).parquet(path)


def routed(validated: DataFrame) -> DataFrame:
    """Add the route of each record, and keep the payload of refused ones only."""
    refused = F.col("reject_reason").isNotNull()
    return validated.withColumn("raw_payload", F.when(refused, F.col("raw_payload"))).withColumn(ROUTE, refused)


def read_quarantine(spark: SparkSession, path: str, stream: str) -> dict[str, DataFrame]:
    """The clean table and the ``_rejects`` table of a stream; each reads its own partition only."""
    contract = CONTRACTS[stream]
    # The types are stated: partition values would else be guessed from their text.
    schema = f"{contract.typed_schema}, raw_payload string, reject_reason string, source_file string, load_id string"
    stored = spark.read.schema(f"{schema}, {ROUTE} boolean").parquet(path)
    return {
        stream: clean_rows(stored.filter(~F.col(ROUTE)), contract, LINEAGE),
        f"{stream}_rejects": reject_rows(stored.filter(ROUTE), LINEAGE),
    }


def ingest(
    spark: SparkSession,
    paths: Mapping[str, str],
    target: str,
    load_id: str,
    only: Collection[str] | None = None,
    event_glob: str = "*.json",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Full refresh of the named sources (all in ``paths`` by default); returns the stored tables.

    Without ``multi_line`` prices hold no line breaks in quotes, and one huge file of them is split over tasks.
    """
    wanted = [name for name in paths if not only or name in only]
    unknown = set(only or ()) - set(paths) | {n for n in paths if n not in EVENT_SOURCES and n not in TABLE_SOURCES}
    if unknown:
        raise ValueError(f"no such source: {sorted(unknown)}")
    tables: dict[str, DataFrame] = {}
    for name in wanted:
        folder = f"{target}/{name}"
        if name in EVENT_SOURCES:
            write_quarantine(validated_stream(spark, paths[name], name, load_id, event_glob), folder)
            tables |= read_quarantine(spark, folder, name)
        else:
            options = {"multi_line": multi_line} if name == "nadac" else {}
            TABLE_SOURCES[name](spark, paths[name], load_id, **options).write.mode("overwrite").parquet(folder)
            tables[name] = spark.read.parquet(folder)
    return tables
