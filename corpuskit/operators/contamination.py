"""Benchmark screens: exact, numeral-masked, containment and similarity; gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import gram_hashes, norm, norm_nonum, words
from ..session import durable
from . import dedup

#: Most grams that are broadcast (about 40 bytes each).
MOST_BROADCAST = 500_000


def flag_by_key(df: DataFrame, key: Column, benchmark: DataFrame, other: Column, name: str) -> DataFrame:
    """``df`` with a flag: whether some benchmark row has the same key."""
    held = benchmark.select(other.alias("__k")).distinct().withColumn("__hit", F.lit(True))
    return df.withColumn("__own", key).join(held, F.col("__own") == F.col("__k"), "left").withColumn(name, F.coalesce("__hit", F.lit(False))).drop("__own", "__k", "__hit")


def keyed(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the hashes of the normal form (``h``) and of the one with masked digits (``hn``)."""
    return df.withColumns({"h": F.md5(norm(text)), "hn": F.md5(norm_nonum(text))})


def screen(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``df`` (see ``keyed``) with ``exact`` and ``nonum``: whether a row of the keyed ``benchmark`` has the same hash."""
    return flag_by_key(flag_by_key(df, F.col("h"), benchmark, F.col("h"), "exact"), F.col("hn"), benchmark, F.col("hn"), "nonum")


def overlaps(left: DataFrame, right: DataFrame, k: int, whole_if_short: bool, small: str = "left") -> DataFrame:
    """``(l, r, shared, nl, nr)`` for rows (``id``, ``text``) that share a word ``k``-gram.

    Grams are 64-bit hashes. Those of the side that should be small are joined inside the scan of the other one if
    their number, counted first, allows a broadcast; else both are shuffled.
    """
    a = left.select(F.col("id").alias("l"), gram_hashes(words(F.col("text")), k, whole_if_short).alias("g")).withColumn("nl", F.size("g")).select("l", "nl", F.explode("g").alias("g"))
    b = right.select(F.col("id").alias("r"), gram_hashes(words(F.col("text")), k, whole_if_short).alias("g")).withColumn("nr", F.size("g")).select("r", "nr", F.explode("g").alias("g"))
    held = durable(a if small == "left" else b)
    one = F.broadcast(held) if held.count() <= MOST_BROADCAST else held
    met = one.join(b if small == "left" else a, "g")
    return met.groupBy("l", "r", "nl", "nr").agg(F.count("*").alias("shared"))


def contained(tasks: DataFrame, texts: DataFrame, k: int = 8, num: int = 3, den: int = 5, small: str = "left") -> DataFrame:
    """Tasks whose ``k``-grams lie in a text to ``num/den`` or more of the task's own: ``(l, r, shared, nl)``."""
    return overlaps(tasks, texts, k, False, small).where(F.col("shared") * den >= F.col("nl") * num).select("l", "r", "shared", "nl")


def similar(left: DataFrame, right: DataFrame, k: int = 3, num: int = 4, den: int = 5, small: str = "left") -> DataFrame:
    """Pairs of rows of two tables with Jaccard similarity ``num/den`` or more."""
    total = F.col("nl") + F.col("nr") - F.col("shared")
    return overlaps(left, right, k, True, small).where(F.col("shared") * den >= total * num).select("l", "r", "shared", total.alias("total"))


def similar_by_leads(items: DataFrame, texts: DataFrame, leads: DataFrame, k: int = 3, num: int = 4, den: int = 5) -> DataFrame:
    """As ``similar`` for few ``items``, where the ``leads`` of the texts' sets (``id``, ``n``, ``lead``) are known.

    A set that is similar to an item's shares ``lead_share`` of the smaller one in its lead (see ``dedup``), so whole
    sets are built only for texts that do; these are compared in full.
    """
    own = dedup.shingle_sets(items, "id", F.col("text"), k).where(F.size("grams") > 0)
    own = own.select(F.col("id").alias("l"), F.size("grams").alias("nl"), F.explode(dedup.lead(F.col("grams"), num, den)).alias("g"))
    held = durable(own)
    met = leads.select(F.col("id").alias("r"), F.col("n").alias("nr"), F.explode("lead").alias("g")).join(F.broadcast(held) if held.count() <= MOST_BROADCAST else held, "g")
    near = (F.col("nl") * den >= F.col("nr") * num) & (F.col("nr") * den >= F.col("nl") * num)
    least = dedup.lead_share(dedup.least_shared(F.least("nl", "nr"), num, den), num, den)
    wanted = met.where(near).groupBy("l", "r", "nl", "nr").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    # Written out, since Spark asks a set that is exploded for its size already in the scan, for every text.
    few = durable(dedup.joined_ids(texts, "id", wanted.select(F.col("r").alias("id")).distinct(), "left_semi"))
    return similar(items, few, k, num, den)


def gate(name: str, violations: DataFrame) -> DataFrame:
    """One row ``(gate, n_violations, verdict)``; raises nothing by itself."""
    return violations.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("gate"), "n_violations", F.when(F.col("n_violations") == 0, "CLEAN").otherwise("CONTAMINATED").alias("verdict"))


def require(report: DataFrame) -> None:
    """Raise if a gate of the report is not clean."""
    failed = [r["gate"] for r in report.where("verdict <> 'CLEAN'").collect()]
    if failed:
        raise ValueError(f"gates failed: {', '.join(failed)}")


def gate_state(artifact_verdict: Column, artifact_hash: Column, file_hash: Column) -> Column:
    """CLEAN only for a clean verdict on this very file; STALE for another file's; NOT_RUN without one."""
    return F.when(artifact_verdict.isNull(), "NOT_RUN").when(~artifact_hash.eqNullSafe(file_hash), "STALE").otherwise(artifact_verdict)
