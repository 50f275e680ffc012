"""Session helpers: a shared checkpoint folder and tables that cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder from ``spark.checkpoint.dir``; only a local master gets a temporary one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="corpuskit-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
