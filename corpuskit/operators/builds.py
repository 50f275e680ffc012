"""Corpus builds: sources under budgets, the cascade of screens, extensions and task gates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import masked, norm, norm_words, word_count
from ..session import durable
from . import contamination, dedup
from .mixture import dense_ids, group_places

#: How much more than the target is collected, and texts below so many words are only compared whole.
OVER_COLLECTION, SHORT_WORDS = 1.35, 15


@dataclass(frozen=True)
class Source:
    """A place that prompts come from: a reader, the prompt as a column of its rows, and the most of a slice that it may fill."""

    name: str
    slice: str
    read: Callable[[SparkSession], DataFrame]
    prompt: Column
    key: Column
    cap: float


def budget(want: int, cap: float, have: int) -> int:
    """How many rows of a source are wanted when its slice already has some."""
    return min(max(1, int(want * cap)), want - have)


def collect(spark: SparkSession, sources: list[Source], want: dict[str, int], order: Callable[[Column], Column], least: int = 20, most: int = 12_000) -> tuple[DataFrame, list[tuple[str, str, int, str]]]:
    """Rows ``(key, prompt, slice, source)`` of each source within its budget, and a report ``(source, slice, collected, error)``.

    Sources are read in the given order; a prompt counts once in its source (the first in ``order`` of the key), and
    only within the length window. A source that cannot be read gives a row with its error and no prompts.
    """
    schema = "key bigint, prompt string, slice string, source string"
    pool, have, report = spark.createDataFrame([], schema), dict.fromkeys(want, 0), []
    for s in sources:
        n = budget(want[s.slice], s.cap, have[s.slice])
        if n <= 0:
            report.append((s.name, s.slice, 0, ""))
            continue
        try:
            rows = s.read(spark).select(s.key.cast("bigint").alias("key"), s.prompt.alias("prompt")).where(F.char_length("prompt").between(least, most))
            rows = rows.withColumns({"__o": order(F.col("key")), "__h": F.md5(norm(F.col("prompt")))})
            first = rows.groupBy("__h").agg(F.min(F.struct("__o", "key")).alias("__f")).select("__f.*")
            taken = durable(dense_ids(first, [F.col("__o"), F.col("key")], "__n").where(F.col("__n") < n).join(rows.drop("__o", "__h"), "key").select("key", "prompt", F.lit(s.slice).alias("slice"), F.lit(s.name).alias("source")))
        except PySparkException as e:
            report.append((s.name, s.slice, 0, type(e).__name__))
            continue
        got = taken.count()
        have[s.slice] += got
        pool = pool.unionByName(taken)
        report.append((s.name, s.slice, got, ""))
    return pool, report


def cascade(df: DataFrame, benchmark: DataFrame, id_col: str, slice_col: str, source_col: str, cap: int) -> DataFrame:
    """``(id, slice, source, status)``: the first reason to drop a row, in the order of ids, or ``kept``.

    Reasons: ``source_cap`` (its source already gave ``cap`` rows that pass all else to the slice), ``benchmark`` (equal
    normal form, with or without digits), ``dup`` (an earlier row has the same normal form, or, from ``SHORT_WORDS``
    words on, a word-shingle similarity of 0.8) and ``near_benchmark``. Copies collapse before anything is compared,
    and a source's rows are counted over ranges, so no slice or source has to fit a task.
    """
    text = F.col("text")
    # One pass over the texts: normal form, words and grams are made once and serve all screens.
    rows = df.select(F.col(id_col).alias("id"), F.col(slice_col).alias("slice"), F.col(source_col).alias("source"), norm(text).alias("normal"))
    rows = rows.select("id", "slice", "source", F.md5("normal").alias("h"), F.md5(masked(F.col("normal"))).alias("hn"), norm_words(F.col("normal")).alias("words"))
    rows = rows.select("id", "slice", "source", "h", "hn", (F.size("words") < SHORT_WORDS).alias("short"), dedup.gram_set(F.col("words")).alias("grams"))
    rows = durable(rows.select("id", "slice", "source", "h", "hn", "short", *dedup.lead_columns(F.col("grams"))))
    sets = rows.select("id", "h1", "h2", "n", "lead")
    rows = durable(rows.select("id", "slice", "source", "h", "hn", "short"))
    items = contamination.keyed(benchmark.select(F.col("item_id").alias("id"), "text"), text)
    rows = dedup.first_occurrence(contamination.screen(rows, items.select("h", "hn")), F.col("h"), "id")
    later, members = dedup.later_copies(sets, df, id_col, text)
    later = later.select(F.col("id").alias("rep")).withColumn("__later", F.lit(True))
    near = members.join(later, "rep", "left").where(F.col("__later") | (F.col("id") != F.col("rep"))).select(F.col("id").alias("__near"))
    leak = contamination.similar_by_leads(items.select("id", "text"), df.select(F.col(id_col).alias("id"), "text"), sets).select(F.col("r").alias("__leak")).distinct()
    rows = rows.join(near, F.col("id") == F.col("__near"), "left").join(leak, F.col("id") == F.col("__leak"), "left")
    why = (
        F.when(F.col("exact") | F.col("nonum"), "benchmark").when(~F.col("is_first"), "dup")
        .when(~F.col("short") & F.col("__near").isNotNull(), "dup").when(~F.col("short") & F.col("__leak").isNotNull(), "near_benchmark").otherwise("kept")
    )
    rows = durable(rows.select("id", "slice", "source", why.alias("status")))
    last = group_places(rows.where("status = 'kept'"), ["slice", "source"], [F.col("id")]).where(F.col("place") == cap)
    last = last.select(F.col("slice").alias("__s"), F.col("source").alias("__o"), F.col("id").alias("__last"))
    met = rows.join(last, F.col("slice").eqNullSafe(F.col("__s")) & F.col("source").eqNullSafe(F.col("__o")), "left")
    capped = F.coalesce(F.col("id") > F.col("__last"), F.lit(False))
    return met.select("id", "slice", "source", F.when(capped, F.when(F.col("status") == "kept", "source_cap").otherwise(F.concat(F.lit("source_cap/"), "status"))).otherwise(F.col("status")).alias("status"))


def build_funnel(statuses: DataFrame, target: Column) -> DataFrame:
    """One row per slice: collected, kept, target, drops by reason, and rows that fill up a slice short of its target.

    A row beyond its source's cap counts as ``dropped_source_cap`` whatever else is wrong with it; only those that
    pass all other screens can fill up.
    """
    count = lambda *v: F.count_if(F.col("status").isin(*v))
    t = statuses.groupBy("slice").agg(
        F.count("*").alias("collected"), count("kept").alias("__fit"), count("source_cap").alias("__spare"), count("dup").alias("dropped_dup"),
        count("benchmark", "near_benchmark").alias("dropped_benchmark"), F.count_if(F.col("status").startswith("source_cap")).alias("dropped_source_cap"),
    )
    goal = target.cast("bigint")
    filled = F.least(F.greatest(goal - F.col("__fit"), F.lit(0)), F.col("__spare"))
    return t.select("slice", "collected", (F.least(F.col("__fit"), goal) + filled).alias("kept"), goal.alias("target"), "dropped_dup", "dropped_benchmark", "dropped_source_cap", filled.alias("backfilled"))


def extension(df: DataFrame, base: Column, id_col: str, order: Column, start: int = 100_000) -> DataFrame:
    """``(id, sample_id)`` of rows outside ``base`` that no base row equals or resembles, numbered from ``start``.

    Equal means the same normal form; from ``SHORT_WORDS`` words on, a similarity of 0.8 with a base row counts too.
    """
    text = F.col("text")
    rows = durable(df.select(F.col(id_col).alias("id"), base.alias("base"), F.md5(norm(text)).alias("h"), (word_count(text) < SHORT_WORDS).alias("short"), order.alias("o")))
    pairs, members = dedup.near_duplicate_pairs(df, id_col, text)
    named = members.join(rows.select("id", "base"), "id")
    held = named.where("base").select("rep").distinct()
    beside = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(held.withColumnRenamed("rep", "a"), "a").select(F.col("b").alias("rep"))
    near = named.join(held.unionByName(beside).distinct(), "rep", "left_semi").select(F.col("id").alias("__near"))
    fresh = rows.where(~F.col("base")).join(rows.where("base").select("h").distinct(), "h", "left_anti")
    fresh = fresh.join(near, F.col("id") == F.col("__near"), "left").where(F.col("short") | F.col("__near").isNull())
    return dense_ids(fresh.select("id", "o"), [F.col("o"), F.col("id")], start=start).select("id", "sample_id")


def gate_tasks(tasks: DataFrame, held: DataFrame) -> DataFrame:
    """One row per task (``id``, ``repo``, ``text``) with a flag for each check against the held set of the same columns.

    ``instance``: the same id; ``repo``: a repository of the held set; ``text_exact``: the same normal form;
    ``text_ngram`` (asked only where the text is not equal): three fifths of its 8-grams lie in one held text.
    """
    own = tasks.select("id", "repo", F.md5(norm(F.col("text"))).alias("h"))
    other = held.select("id", "repo", F.md5(norm(F.col("text"))).alias("h"))
    out = own
    for name, key in (("instance", "id"), ("in_repo", "repo"), ("text_exact", "h")):
        out = contamination.flag_by_key(out, F.col(key), other, F.col(key), name)
    grams = contamination.contained(tasks.select("id", "text"), held.select("id", "text"), small="right").select(F.col("l").alias("__l")).distinct()
    out = out.join(grams, F.col("id") == F.col("__l"), "left")
    return out.select("id", "instance", F.col("in_repo").alias("repo"), "text_exact", (F.col("__l").isNotNull() & ~F.col("text_exact")).alias("text_ngram"))


def gate_report(flags: DataFrame) -> DataFrame:
    """One row: tasks, hits of each check, and the verdict."""
    names = ("instance", "repo", "text_exact", "text_ngram")
    row = flags.agg(F.count("*").alias("n_tasks"), *(F.count_if(n).alias(n) for n in names))
    return row.withColumn("verdict", F.when(sum((F.col(n) for n in names[1:]), F.col(names[0])) == 0, "CLEAN").otherwise("CONTAMINATED"))
