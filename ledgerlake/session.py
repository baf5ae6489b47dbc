"""Session settings the operators rely on, and tables in the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every one is a runtime SQL setting. A hot join key is split by AQE, also where the split
# costs a further shuffle downstream; small sides become broadcasts only below Spark's own
# size threshold (file statistics or measured shuffle size), never by a hint.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Below this size per partition, measured at run time, a sort-merge join becomes a hash join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

SCRATCH_SETTING = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive features that the operators count on."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared scratch folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, because other machines could not read it.
    """
    root = spark.conf.get(SCRATCH_SETTING, None) or spark.sparkContext.getConf().get(SCRATCH_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SCRATCH_SETTING} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set(SCRATCH_SETTING, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the scratch folder: computed once, safe when executors are lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
