"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch between the JVM and Python. Texts may be megabytes long, so batches are short in rows.
ARROW_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``. Where that is unset and the master is local (tests), a temporary
    folder is set; on a cluster an unset folder is an error, since a machine-local one would lose data.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="corpuskit-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that long texts cannot pile up in a Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns under names that no operator makes, and the new name of each old one."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def unshielded(names: dict[str, str], made: Iterable[str] = ()) -> list[Column]:
    """The columns of a shielded table under their old names, without those of the ``made`` names."""
    return [F.col(new).alias(old) for old, new in names.items() if old not in set(made)]


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def partitions_of(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks_by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a chunk holds about ``limit`` bytes of ``column``, and one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)
