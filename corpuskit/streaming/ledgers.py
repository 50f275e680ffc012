"""Incremental state: streamed funnels, streamed deduplication, leases."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream over the Parquet files of a folder; the schema is that of the files present.

    A path to one file is watched through its folder.
    """
    schema = spark.read.parquet(path).schema
    base, name = path.rsplit("/", 1)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(base)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder, by the file system that it is on."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def streamed_counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Counts by key kept by a stream that takes what is there and stops; state is in the shared folder.

    Every trigger writes its changed counts with its epoch; the last epoch of a key is its count.
    """
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    counts = file_stream(spark, path).groupBy(*keys).agg(F.count("*").alias("n"))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{place}/out/epoch_part={epoch}")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    rows = spark.read.parquet(f"{place}/out")
    return rows.groupBy(*keys).agg(F.max_by("n", "epoch").alias("n"))


def streamed_new(stream: DataFrame, base: DataFrame, key: str, out: str, state: str) -> None:
    """Append rows whose key neither ``base`` nor an earlier row of the stream had; exactly once by the checkpoint."""
    fresh = stream.dropDuplicates([key])

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.join(base.select(key), key, "left_anti").write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    fresh.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def leases(events: DataFrame, owner: str, ts: str, order: str, ttl_seconds: int = 900) -> DataFrame:
    """``(owner, lease, beats, first_event)``: heartbeats no more than the time to live apart are one lease."""
    w = Window.partitionBy(owner).orderBy(ts, order)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = at - F.lag(at).over(w)
    starts = (gap.isNull() | (gap > ttl_seconds * 1_000_000)).cast("int")
    numbered = events.withColumn("__s", starts).withColumn("lease", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(owner, "lease").agg(F.count("*").alias("beats"), F.min(order).alias("first_event"))


def expired(events: DataFrame, owner: str, ts: str, now: str, ttl_seconds: int = 900) -> DataFrame:
    """Owners whose last heartbeat is older than the time to live at ``now``."""
    last = events.groupBy(owner).agg(F.max(ts).alias("last"))
    return last.where(F.unix_micros(F.col("last").cast("timestamp")) + ttl_seconds * 1_000_000 < F.unix_micros(F.to_timestamp(F.lit(now))))
