"""Sweep plans: validation, grid expansion with content ids, projected cost."""

from __future__ import annotations

import hashlib
import itertools
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Sections that a plan needs.
SECTIONS = ("grid", "gate", "budget")


def content_id(config: dict[str, Any]) -> str:
    """Twelve hex digits of the SHA-256 of a configuration with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:12]


def problems(plan: dict[str, Any]) -> list[str]:
    """What is wrong with a plan: missing sections, a reserve above the cap, trials above theirs."""
    found = [f"missing section {s}" for s in SECTIONS if s not in plan]
    budget = plan.get("budget", {})
    if budget.get("reserve", 0) >= budget.get("cap", float("inf")):
        found.append("reserve is not below cap")
    if "trial_cost" in budget and budget["trial_cost"] > budget.get("trial_cap", float("inf")):
        found.append("a trial costs more than its cap")
    return found


def expand(spark: SparkSession, axes: dict[str, list[Any]]) -> DataFrame:
    """One row per combination of the axes (a plan's, few by nature) with ``trial_id``."""
    names = sorted(axes)
    rows = [dict(zip(names, values, strict=True)) for values in itertools.product(*(axes[n] for n in names))]
    return spark.createDataFrame([(*(r[n] for n in names), content_id(r)) for r in rows], [*names, "trial_id"])


def projected_cost(n_trials: int, hours: float, rate: float) -> float:
    """Cost of a rung before it runs."""
    return n_trials * hours * rate
