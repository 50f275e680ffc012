"""Sweeps: floors from a baseline, states of trials, guards, anchors, environment drift, spend, merged fleets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gated_against(trials: DataFrame, attempts: DataFrame, baseline: DataFrame, tolerances: dict[str, float], gray: float, attempt_cap: int, key: str = "trial") -> DataFrame:
    """One row per trial with its state, the metrics below their floors, those in the gray band, and whether it is eligible.

    ``attempts`` has the key, ``state``, ``attempts``, ``env_digest`` and the metrics; ``baseline`` is one row of
    metrics with its ``env_digest``. A floor is the baseline's metric less its tolerance. A success whose environment
    is not the baseline's has failed (``env_drift``). Trials without success are ``pending`` while attempts are left,
    else ``exhausted``.
    """
    base = baseline.first()
    if base is None:
        raise ValueError("a sweep cannot be gated without its baseline")
    floors = {m: F.lit(float(base[m])) - t for m, t in tolerances.items()}
    met = trials.join(attempts, key, "left")
    drift = (F.col("state") == "success") & F.lit(base["env_digest"]).isNotNull() & ~F.col("env_digest").eqNullSafe(F.lit(base["env_digest"]))
    state = (
        F.when(drift, "env_drift").when(F.col("state") == "success", "success").when(F.coalesce("attempts", F.lit(0)) < attempt_cap, "pending").otherwise("exhausted")
    )
    below = F.filter(F.array(*(F.when(F.col(m) < f, m) for m, f in floors.items())), lambda x: x.isNotNull())
    near = F.filter(F.array(*(F.when((F.col(m) >= f) & (F.col(m) < f + gray), m) for m, f in floors.items())), lambda x: x.isNotNull())
    met = met.withColumn("state", state)
    ok = F.col("state") == "success"
    return met.withColumns({"gate_reason": F.when(ok, below), "gray_band": F.when(ok, near)}).withColumn("eligible", ok & (F.size("gate_reason") == 0))


def sweep_state(gated: DataFrame) -> DataFrame:
    """One row: trials, those completed, eligible and pending, and ``complete``, ``partial`` or ``incomplete``."""
    row = gated.agg(F.count("*").alias("n_trials"), F.count_if(F.col("state") == "success").alias("n_completed"), F.count_if("eligible").alias("n_eligible"), F.count_if(F.col("state") == "pending").alias("n_pending"))
    return row.withColumn("sweep", F.when(F.col("n_pending") == 0, "complete").when(F.col("n_completed") > 0, "partial").otherwise("incomplete"))


def spend(runs: DataFrame, by: list[str], order: list[str], hours: Column, rate: Column) -> DataFrame:
    """``runs`` with ``cost`` and ``spent``, the running total of their group; a run never lowers it."""
    cost = F.greatest(F.coalesce(hours * rate, F.lit(0.0)), F.lit(0.0))
    return runs.withColumn("cost", cost).withColumn("spent", F.sum("cost").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def next_cost(rate: Column, trial_cap: Column, wall_hours: Column, overhead_hours: float) -> Column:
    """What one more trial can cost at most."""
    return F.least(trial_cap, rate * wall_hours) + rate * overhead_hours


def halt_reason(halted: Column, spent: Column, hard_cap: Column, coming: Column, balance: Column, reserve: Column, billed: Column) -> Column:
    """Why nothing may start: the halt mark, the spend cap, a balance that cannot be read or would fall below the reserve; else null."""
    return (
        F.when(halted, "halt").when(spent >= hard_cap, "hard_cap").when(spent + coming > hard_cap, "sweep_cap").when(~billed, F.lit(None).cast("string"))
        .when(balance.isNull(), "balance_unknown").when(balance - coming < reserve, "reserve")
    )


def starts_unfinishable(started: Column, wall_seconds: Column, deadline: Column) -> Column:
    """Whether a trial that starts now cannot end before the deadline."""
    return started + wall_seconds > deadline


def anchor_ok(value: Column, least: Column) -> Column:
    """Whether the untrained anchor reaches its floor; no value is none."""
    return F.coalesce(value, F.lit(0.0)) >= least


def merged_fleet(results: DataFrame, baselines: DataFrame, metric: str, most_spread: float) -> DataFrame:
    """Trials of several machines ranked by their metric less that of their own machine's baseline.

    ``results`` has ``trial``, ``host`` and the metric, ``baselines`` ``host`` and the metric. A trial that several hosts
    report, or whose host has no baseline, is refused, and nothing is ranked if baselines spread further than
    ``most_spread``. Refused trials have no place.
    """
    base = baselines.groupBy("host").agg(F.avg(metric).alias("__base"))
    spread = base.agg(F.max("__base") - F.min("__base")).first()[0] or 0.0
    twice = results.groupBy("trial").agg(F.count("*").alias("__n"))
    met = results.join(twice, "trial").join(base, "host", "left")
    why = F.when(F.col("__n") > 1, "duplicate").when(F.col("__base").isNull(), "no_baseline").when(F.lit(spread) > most_spread, "spread")
    met = met.withColumns({"delta": F.col(metric) - F.col("__base"), "refused": why})
    place = F.row_number().over(Window.partitionBy("refused").orderBy(F.desc("delta"), "trial", "host"))
    return met.withColumn("place", F.when(F.col("refused").isNull(), place)).select("trial", "host", "delta", "refused", "place")


def composite(metrics: DataFrame, anchor: DataFrame, weights: dict[str, float], run: str) -> DataFrame:
    """The weighted sum of each run's differences to the anchor (``metric``, ``value``); what either lacks adds nothing."""
    weight = F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(v))))
    met = metrics.join(anchor.select("metric", F.col("value").alias("__a")), "metric").withColumn("__w", F.try_element_at(weight, F.col("metric"))).where(F.col("__w").isNotNull())
    return met.groupBy(run).agg(F.sum(F.col("__w") * (F.col("value") - F.col("__a"))).alias("score"), F.count("*").alias("n_metrics"))
