"""Mixture targets, caps, backfill, splits and dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable

#: Shares of the slices, and where the share of a parked slice goes.
SHARES = {"coding": 0.40, "math": 0.20, "general": 0.20, "tool_calling": 0.05, "long_context": 0.05, "structured_science": 0.05}
PARKED = {"general": 0.02, "tool_calling": 0.01, "long_context": 0.01, "structured_science": 0.01}


def slice_targets(spark: SparkSession, total: int, shares: dict[str, float] | None = None, extra: dict[str, float] | None = None) -> DataFrame:
    """``(slice, share, target)``: floored targets, the remainder goes to the largest one (the first named on ties)."""
    shares, extra = shares or SHARES, PARKED if extra is None else extra
    rows = [(i, k, float(v), float(extra.get(k, 0.0))) for i, (k, v) in enumerate(shares.items())]
    table = spark.createDataFrame(rows, "pos int, slice string, own double, more double").withColumn("share", F.col("own") + F.col("more"))
    everywhere = Window.partitionBy()
    table = table.withColumn("floor", F.floor(F.lit(total) * F.col("share") / F.sum("share").over(everywhere)))
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("floor"), "pos"))
    rest = F.lit(total) - F.sum("floor").over(everywhere)
    return table.select("slice", "share", (F.col("floor") + F.when(place == 1, rest).otherwise(0)).alias("target"))


def source_cap(target: Column, fraction: Column) -> Column:
    """Most rows of a source in its slice, one at least."""
    return F.greatest(F.lit(1), F.floor(target * fraction).cast("int"))


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """``df`` with a 1-based place inside each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def group_places(df: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """As ``ranked`` for groups of any size: rows are sorted by range, and a group may span many tasks.

    A row's place is its place in its partition plus the group's rows in the partitions before; only one row per
    group and partition is needed for that. ``order`` must be unique inside a group.
    """
    keys = {f"__o{i}": c for i, c in enumerate(order)}
    placed = durable(df.withColumns(keys).orderBy(*by, *keys).drop(*keys)).withColumn("__m", F.monotonically_increasing_id()).withColumn("__p", F.shiftright("__m", 33))
    heads = placed.groupBy("__p", *by).agg(F.min("__m").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    heads = heads.select(F.col("__p").alias("__q"), *(F.col(c).alias(f"__g{i}") for i, c in enumerate(by)), "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    same = F.col("__p") == F.col("__q")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    joined = placed.join(heads, same)
    return joined.withColumn(name, F.col("__before") + F.col("__m") - F.col("__first") + 1).drop("__m", "__p", "__q", "__first", "__before", *(f"__g{i}" for i in range(len(by))))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], most: Column | int) -> DataFrame:
    """The first ``most`` rows of each group. Spark limits groups before their shuffle where ``most`` is a number."""
    return ranked(df, by, order, "__place").where(F.col("__place") <= most).drop("__place")


def backfilled(df: DataFrame, slice_col: str, source_col: str, order: Column, target: Column, cap: Column) -> DataFrame:
    """Rows up to the target of each slice with ``filled``: those within the source cap come first, then the rest.

    Sources and slices may hold any share of the rows: no window has a whole one of them in a task.
    """
    df = df.withColumn("__order", order)
    df = group_places(df, [slice_col, source_col], [F.col("__order")], "__own").withColumn("filled", F.col("__own") > cap)
    df = group_places(df, [slice_col], [F.col("filled"), F.col("__order")], "__place")
    return df.where(F.col("__place") <= target).drop("__order", "__own", "__place")


def heldout_quotas(counts: DataFrame, group: str, n: str, size: int) -> DataFrame:
    """``(group, quota)``: proportional floors, the remainder goes to the largest group."""
    everywhere = Window.partitionBy()
    quota = F.floor(F.lit(size) * F.col(n) / F.sum(n).over(everywhere))
    table = counts.select(group, n, quota.alias("q"))
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc(n), group))
    return table.select(group, (F.col("q") + F.when(place == 1, F.lit(size) - F.sum("q").over(everywhere)).otherwise(0)).alias("quota"))


def dense_ids(df: DataFrame, order: list[Column], name: str = "sample_id", start: int = 0) -> DataFrame:
    """``df`` with consecutive ids from ``start`` in the given order, without moving all rows to one task.

    Rows are sorted by range and written to the shared folder; a row's id is its place in its partition plus the
    rows of the partitions before, of which one number each comes to the driver.
    """
    placed = durable(df.orderBy(*order)).withColumn("__m", F.monotonically_increasing_id()).withColumn("__p", F.shiftright("__m", 33))
    counts = sorted((r["__p"], r["count"]) for r in placed.groupBy("__p").count().collect())
    before, total = [], start
    for part, n in counts:
        before.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before or [(0, start)], "__q bigint, __before bigint")
    inside = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.join(F.broadcast(offsets), F.col("__p") == F.col("__q"))
    return joined.withColumn(name, F.col("__before") + inside).drop("__m", "__p", "__q", "__before")


def group_split(df: DataFrame, group: str, order: Column, part: int = 5) -> DataFrame:
    """``df`` with ``split``: the first ``max(1, groups // part)`` groups in ``order`` are validation."""
    groups = df.select(group).distinct().withColumn("__o", order)
    n = groups.count()
    chosen = groups.orderBy("__o", group).limit(max(1, n // part)).select(group).withColumn("__val", F.lit(True))
    return df.join(chosen, group, "left").withColumn("split", F.when(F.col("__val"), "validation").otherwise("train")).drop("__val")


def mix_in(base: DataFrame, extra: DataFrame, ratio: float, order: Column) -> DataFrame:
    """``base`` with ``round(n * r / (1 - r))`` rows of ``extra``, the first in ``order``; columns by name.

    The share of ``extra`` may be large, so rows are placed by ranges and not by a global limit.
    """
    wanted = round(base.count() * ratio / (1 - ratio))
    placed = dense_ids(extra.withColumn("__o", order), [F.col("__o")], "__place")
    return base.unionByName(placed.where(F.col("__place") < wanted).drop("__o", "__place"), allowMissingColumns=True)


def usable_mix(rows: DataFrame, reasons: dict[str, Column], order: list[Column], wanted: int) -> tuple[DataFrame, DataFrame]:
    """The first ``wanted`` usable rows, and ``(reason, n)`` of all that are not: the first of the reasons that holds.

    Fewer usable rows than wanted are an error.
    """
    why = F.lit(None).cast("string")
    for name, holds in reasons.items():
        why = F.coalesce(why, F.when(holds, name))
    marked = rows.withColumn("__why", why)
    counts = marked.groupBy(F.coalesce("__why", F.lit("usable")).alias("reason")).agg(F.count("*").alias("n"))
    placed = dense_ids(marked.where("__why is null").drop("__why"), order, "__place")
    taken = placed.where(F.col("__place") < wanted).drop("__place")
    if taken.count() < wanted:
        raise ValueError(f"fewer than {wanted} usable rows")
    return taken, counts
