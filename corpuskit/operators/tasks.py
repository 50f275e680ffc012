"""Task tiers, difficulty, quality rules, selection and schedules."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_of, hits
from ..session import durable
from .mixture import group_places

# Keyword groups and patterns of the difficulty score, the bug families and the quality rules.
CONCEPTS = {
    "type_system": ("type inference", "type checker", "narrowing", "metaclass", "generic", "typevar", "protocol", "variance", "namedtuple", "binder", "mypy"),
    "cache_state": ("cache", "cached", "incremental", "daemon", "stale", "restore", "persistence", "state", "checksum", "run-cache"),
    "concurrency": ("async", "await", "thread", "race", "deadlock", "callback", "lock", "task token", "waitfortasktoken", "state machine"),
    "numerical": ("overflow", "precision", "dtype", "uint", "integer", "floating", "quantile", "interpolation", "timezone", "nan", "rounding"),
    "dependency": ("dependency", "dependencies", "resolver", "cmake", "compiler", "toolchain", "transitive", "build graph", "package graph"),
    "serialization": ("serialize", "serialization", "parser", "parsing", "yaml", "json", "dump", "load", "schema", "configuration", "config"),
    "lifecycle": ("lifecycle", "event handler", "session", "transaction", "backend", "resource", "retry", "rollback", "invalidation"),
}
TRIVIAL = ("empty list", "empty iterable", "rename", "re-export", "export", "typo", "invalid enum", "case insensitive", "lowercase", "deprecated alias")
LEAKS = (
    r"after i remove\b", r"the fix is to\b", r"fix(?:ed)? by changing\b", r"change [`'\"]?[^\n]{1,60}[`'\"]? to [`'\"]?[^\n]{1,60}",
    r"i have this implemented", r"ready to (?:go|submit|open a pr)", r"```diff",
)
AMBIGUOUS = (r"not (?:actually )?sure (?:that )?this is a bug", r"would like (?:an )?opinion", r"is this (?:a )?bug or", r"which (?:approach|option|behavior) should")
TEST_PATH = r"(^|/)(tests?|testing)/|(^|/)test_[^/]*$|_test\.py$"
EXACT_PLACE = (r"github\.com/[^\s]+/(?:blob|commit)/[^\s]+#l\d+", r"(?:file|line) [^\n]{0,80}:\d+")
REPRODUCED = ("to reproduce", "steps to reproduce", "expected behavior", "actual behavior")
FAMILIES = (
    ("async_concurrency", (), "concurrency"), ("cache_incremental", (), "cache_state"), ("type_system", ("mypy",), "type_system"), ("build_dependency", ("conan",), "dependency"),
    ("numeric_data", ("pandas", "dask", "modin"), "numerical"), ("parsing_serialization", (), "serialization"),
    ("filesystem_versioning", ("dvc",), ("filesystem", "directory", "path", "remote")), ("cloud_api_state", ("moto",), ("aws", "boto3", "cloud", "backend")),
    ("protocol_api", (), ("api", "request", "response", "validation", "fallback")),
)
FEATURE_TITLES = ("[feature]", "feature:", "feature request", "[enh]", "enh:", "enhancement:")
FEATURE_VERBS = r"^(add|allow|implement|support|provide|introduce|enable)\b"
ENVIRONMENT = ("windows", "cmake", "compiler", "timezone", "sleep", "timeout")


def tier(files: Column, lines: Column, failing: Column) -> Column:
    """Patch-size tier: hard from 3 files, 61 lines or 6 failing tests, easy for one file below 15 lines."""
    return F.when((files >= 3) | (lines > 60) | (failing > 5), "hard").when((files == 1) & (lines < 15), "easy").otherwise("medium")


def present(flags: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.filter(F.array(*(F.when(c, name) for name, c in flags.items())), lambda x: x.isNotNull())


def malformed(test: Column) -> Column:
    """A test id with a line break, or with a bracket that does not close it."""
    return F.contains(test, F.lit("\n")) | F.contains(test, F.lit("\r")) | (F.contains(test, F.lit("[")) & ~test.endswith("]"))


def quality_reasons(statement: Column, n_words: Column, patch: Column, files: Column, lines: Column, test_patch: Column, failing: Column) -> Column:
    """Reasons to leave a task out."""
    low = F.lower(statement)
    return present({
        "problem_statement_too_short": n_words < 35,
        "missing_gold_patch": (F.coalesce(patch, F.lit("")) == "") | (F.size(files) == 0),
        "missing_test_patch": F.coalesce(test_patch, F.lit("")) == "",
        "missing_fail_to_pass": F.size(failing) == 0,
        "malformed_fail_to_pass": F.exists(failing, malformed),
        "gold_changes_only_tests": (F.size(files) > 0) & F.forall(files, lambda f: f.rlike(TEST_PATH)),
        "oversized_for_step_limited_rollout": (F.size(files) > 8) | (lines > 350),
        "verification_set_too_large": F.size(failing) > 20,
        "ambiguous_expected_behavior": hits(low, AMBIGUOUS) > 0,
        "statement_reveals_implementation": hits(low, LEAKS) >= 2,
    })


def difficulty(statement: Column, files: Column, lines: Column, failing: Column, passing: Column) -> dict[str, Column]:
    """Components, score and label of diagnosis difficulty."""
    low = F.lower(statement)
    leaks = hits(low, LEAKS)
    localization = F.when(leaks >= 2, 0).when(hits(low, EXACT_PLACE) > 0, 1).when(any_of(low, (*REPRODUCED, "traceback")), 2).otherwise(3)
    concepts = sum((any_of(low, k).cast("int") for k in CONCEPTS.values()), F.lit(0))
    reasoning = F.when(concepts >= 2, 3).when(concepts == 1, 2).otherwise(1) - F.when(any_of(low, TRIVIAL) & (concepts <= 1), 1).otherwise(0)
    coupling = F.when((files >= 4) | (lines >= 100), 3).when((files >= 2) | (lines >= 35), 2).when(lines >= 15, 1).otherwise(0)
    validation = F.when((failing >= 4) | ((failing >= 2) & (passing >= 5)), 2).when((failing >= 2) | ((failing >= 1) & (passing >= 1)), 1).otherwise(0)
    penalty = F.least(F.lit(2), leaks)
    score = localization + reasoning + coupling + validation - penalty
    label = F.when(score >= 9, "hard").when(score >= 6, "medium").otherwise("easy")
    return {"localization": localization, "reasoning": reasoning, "coupling": coupling, "validation": validation, "hint_penalty": penalty, "score": score, "difficulty": label}


def bug_family(repo: Column, text: Column) -> Column:
    """The first family whose repository or keywords fit."""
    repo, low, out = F.lower(repo), F.lower(text), None
    for name, repos, keys in FAMILIES:
        fits = any_of(low, CONCEPTS[keys] if isinstance(keys, str) else keys)
        if repos:
            fits = fits | any_of(repo, repos)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out.otherwise("other")


def review_flags(statement: Column, title: Column, files: Column, lines: Column, passing: Column, penalty: Column) -> Column:
    """Cautions for a reviewer."""
    low, head = F.lower(statement), F.lower(title)
    starts = lambda names: F.exists(F.array(*map(F.lit, names)), lambda n: F.startswith(head, n))
    return present({
        "no_pass_to_pass": passing == 0,
        "large_gold_patch": (files >= 5) | (lines >= 150),
        "environment_or_time_sensitive": any_of(low, ENVIRONMENT),
        "statement_contains_implementation_hint": penalty > 0,
        "feature_request_not_bug": starts(FEATURE_TITLES) | head.rlike(FEATURE_VERBS) | F.contains(head, F.lit("enhancements")),
        "performance_task": starts(("perf:", "[perf]", "performance:")) | F.contains(head, F.lit("performance improvement")),
        "usage_question": starts(("how do i", "how to ", "usage:", "question:")),
        "maintenance_task": any_of(head, ("flake8", "lint", "typing cleanup", "documentation only")),
        "performance_validation_may_be_weak": F.contains(low, F.lit("benchmark")) & F.contains(low, F.lit("performance")),
    })


def stratified_cap(pool: DataFrame, tier_col: str, repo_col: str, order: Column, repo_cap: int, tier_target: Column) -> DataFrame:
    """Tasks up to the target of each tier, at most ``repo_cap`` of a repository in it; repositories take turns."""
    pool = pool.withColumn("__o", order)
    pool = pool.withColumn("repo_place", F.row_number().over(Window.partitionBy(tier_col, repo_col).orderBy("__o"))).where(F.col("repo_place") <= repo_cap)
    pool = pool.withColumn("tier_place", F.row_number().over(Window.partitionBy(tier_col).orderBy("repo_place", "__o")))
    return pool.where(F.col("tier_place") <= tier_target).drop("__o")


def interleaved(df: DataFrame, tier_col: str, order: Column, pattern: tuple[str, ...]) -> DataFrame:
    """``df`` with ``cycle`` and ``slot``, whose order repeats the pattern of tiers; used-up tiers are skipped."""
    slots = {t: [i for i, p in enumerate(pattern) if p == t] for t in dict.fromkeys(pattern)}
    cycle, slot = F.lit(None).cast("bigint"), F.lit(None).cast("int")
    for t, at in slots.items():
        here = F.col(tier_col) == t
        cycle = F.when(here, F.floor(F.col("__n") / len(at))).otherwise(cycle)
        slot = F.when(here, F.element_at(F.array(*map(F.lit, at)), (F.col("__n") % len(at) + 1).cast("int"))).otherwise(slot)
    placed = group_places(df, [tier_col], [order], "__n").withColumn("__n", F.col("__n") - 1)
    return placed.withColumns({"cycle": cycle, "slot": slot}).drop("__n")


def round_robin(df: DataFrame, by: str, order: Column, workers: int) -> DataFrame:
    """``df`` with ``worker``: rows of each group are dealt in turn."""
    return group_places(df, [by], [order], "worker").withColumn("worker", (F.col("worker") - 1) % workers)


def adaptive_stop(rollouts: DataFrame, task: str, index: str, good: str, stop_at: Column, most: Column) -> DataFrame:
    """Rollouts that would have run: before the ``stop_at``-th success and within the first ``most``."""
    w = Window.partitionBy(task).orderBy(index)
    before = F.coalesce(F.sum(F.col(good).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ran = rollouts.withColumns({"n_before": before, "__n": F.row_number().over(w)})
    return ran.where((F.col("n_before") < stop_at) & (F.col("__n") <= most)).drop("__n")


def running_guard(df: DataFrame, by: list[str], order: list[Column], cost: Column, cap: float) -> DataFrame:
    """Rows that start while the cost spent before them is within the cap, with ``spent_before``."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("spent_before", F.coalesce(F.sum(cost).over(w), F.lit(0.0))).where(F.col("spent_before") <= cap)


def balanced_greedy(pool: DataFrame, target: int, repo_cap: int = 10, family_cap: int = 18, seeds: DataFrame | None = None, most: int = 200_000) -> DataFrame:
    """``target`` tasks chosen one by one by (repo count, family count, -score, flags, id), counts rising with each pick.

    Seeds come first, as picks of their own, and count toward the caps. The pool is pruned first: of a repository and
    a family, only as many rows can be chosen as their caps allow, so the sequential step sees at most that many of each.
    Their number is counted before; above ``most`` it is an error. Columns: ``id``, ``repo``, ``family``, ``score``,
    ``n_flags`` and ``pick``.
    """
    columns = ["id", "repo", "family", "score", "n_flags"]
    if seeds is not None:
        pool = pool.join(seeds.select("id"), "id", "left_anti")
    best = Window.partitionBy("repo", "family").orderBy(F.desc("score"), "n_flags", "id")
    head = pool.withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= min(repo_cap, family_cap)).select(*columns, F.lit(False).alias("seed"))
    if seeds is not None:
        head = head.unionByName(seeds.select(*columns, F.lit(True).alias("seed")))
    head = durable(head.withColumns({"score": F.col("score").cast("int"), "n_flags": F.col("n_flags").cast("int")}))
    if head.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} repositories and families times their caps; the greedy choice is one task")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf.itertuples(index=False), key=lambda r: (not r.seed, r.id if r.seed else 0, -r.score, r.n_flags, r.id))
        repos: dict[str, int] = {}
        families: dict[str, int] = {}
        out = []
        while rows and len(out) < target:
            free = [rows[0]] if rows[0].seed else [r for r in rows if repos.get(r.repo, 0) < repo_cap and families.get(r.family, 0) < family_cap]
            if not free:
                break
            pick = min(free, key=lambda r: (repos.get(r.repo, 0), families.get(r.family, 0), -r.score, r.n_flags, r.id))
            rows.remove(pick)
            repos[pick.repo] = repos.get(pick.repo, 0) + 1
            families[pick.family] = families.get(pick.family, 0) + 1
            out.append((pick.id, pick.repo, pick.family, pick.score, pick.n_flags, len(out) + 1))
        return pd.DataFrame(out, columns=[*columns, "pick"])

    return head.groupBy().applyInPandas(choose, "id bigint, repo string, family string, score int, n_flags int, pick int")


def generate(rows: DataFrame, call: Iterator, schema: str) -> DataFrame:
    """The connector contract for generators and judges: ``call`` maps batches of rows to batches of results."""
    return rows.mapInPandas(call, schema)
