"""Validation of a growing folder of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.quarantine import CONTRACTS, validate
from ledgerlake.sources.events import json_files, json_records
from ledgerlake.sources.landing import ROUTE, routed


def start_quarantine(
    spark: SparkSession,
    path: str,
    stream: str,
    target: str,
    checkpoint: str,
    glob: str = "*.json",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Validate every file not seen before and store clean and refused records; ends when caught up.

    A large backlog is taken in batches of ``files_per_batch``. The batch number is the load id. A batch that is run
    again after a failure overwrites its own partitions, so records are stored once.
    """
    validated = validate(json_records(json_files(spark, path, glob, True, files_per_batch)), CONTRACTS[stream])

    def store(batch: DataFrame, batch_id: int) -> None:
        (
            routed(batch.withColumn("load_id", F.lit(str(batch_id))))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id", ROUTE)
            .parquet(target)
        )

    return (
        validated.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
