"""Votes, win rates, accuracies, objectives, sweeps and gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip_think, strip_white, word_count

#: The order in which tied votes resolve.
PRIORITY = {"win": 3, "loss": 2, "tie": 1}


def parsed_choice(text: Column, n_shown: Column) -> tuple[Column, Column]:
    """Zero-based choice of a judge and whether it was accepted; 0 and false for an unusable verdict.

    The thinking must be closed, a trailing number is preferred to the last one, and it must be in range.
    """
    closed = F.contains(text, F.lit("</think>")) | ~F.contains(text, F.lit("<think>"))
    said = strip_think(text)
    trailing = F.regexp_extract(said, r"(\d+)\s*$", 1)
    last = F.try_element_at(F.regexp_extract_all(said, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1))
    number = F.coalesce(F.nullif(trailing, F.lit("")), last).try_cast("int")
    ok = closed & number.between(1, n_shown)
    return F.when(ok, number - 1).otherwise(0), F.coalesce(ok, F.lit(False))


def verdict(text: Column) -> Column:
    """TIE, A or B by the answer's beginning; anything else is a tie."""
    said = F.upper(strip_think(text))
    return F.when(said.startswith("TIE"), "TIE").when(said.startswith("A"), "A").when(said.startswith("B"), "B").otherwise("TIE")


def outcome(said: Column, candidate_is_a: Column) -> Column:
    """win, loss or tie of the candidate, whose side was random."""
    return F.when(said == "TIE", "tie").when((said == "A") == candidate_is_a, "win").otherwise("loss")


def majority(votes: DataFrame, key: list[str], vote: str) -> DataFrame:
    """The most frequent vote of each key; ties resolve win, loss, tie."""
    counts = votes.groupBy(*key, vote).agg(F.count("*").alias("n"))
    rank = F.col("n") * 10 + F.create_map(*(x for k, v in PRIORITY.items() for x in (F.lit(k), F.lit(v))))[F.col(vote)]
    return counts.groupBy(*key).agg(F.max_by(vote, rank).alias("verdict"), F.sum("n").alias("n_votes"))


def win_rates(verdicts: DataFrame, slice_col: str, vote: str) -> DataFrame:
    """Counts and win rate (ties half) overall (null slice) and per slice."""
    count = lambda v: F.count_if(F.col(vote) == v)
    rows = verdicts.rollup(slice_col).agg(count("win").alias("win"), count("loss").alias("loss"), count("tie").alias("tie"), F.count("*").alias("n"))
    return rows.withColumn("win_rate", (F.col("win") + 0.5 * F.col("tie")) / F.col("n"))


def accuracies(samples: DataFrame, strict: Column, loose: Column) -> DataFrame:
    """Prompt- and instruction-level accuracy over arrays of booleans."""
    all_ = lambda a: F.forall(a, lambda x: x).cast("int")
    sum_ = lambda a: F.size(F.filter(a, lambda x: x))
    return samples.agg(
        F.count("*").alias("n"), F.avg(all_(strict)).alias("prompt_strict"), F.avg(all_(loose)).alias("prompt_loose"),
        (F.sum(sum_(strict)) / F.sum(F.size(strict))).alias("inst_strict"), (F.sum(sum_(loose)) / F.sum(F.size(loose))).alias("inst_loose"),
    )


def response_variants(text: Column) -> Column:
    """The response, the response without asterisks, and the one without blank lines."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: strip_white(x) != "")
    return F.array(text, F.replace(text, F.lit("*"), F.lit("")), F.array_join(lines, "\n"))


#: A check of an instruction: the response and the instruction's arguments (a map of strings) to a boolean.
Check = Callable[[Column, Column], Column]

#: Instructions by name. Add to it, or pass another registry to ``instruction_checks``.
CHECKS: dict[str, Check] = {
    "no_comma": lambda t, a: ~F.contains(t, F.lit(",")),
    "least_words": lambda t, a: word_count(t) >= F.try_element_at(a, F.lit("n")).cast("int"),
    "most_words": lambda t, a: word_count(t) <= F.try_element_at(a, F.lit("n")).cast("int"),
    "lower_case": lambda t, a: t == F.lower(t),
    "keyword": lambda t, a: F.contains(F.lower(t), F.lower(F.try_element_at(a, F.lit("word")))),
    "no_asterisk": lambda t, a: ~F.contains(t, F.lit("*")),
    "paragraphs": lambda t, a: F.size(F.split(t, "\n\n", -1)) == F.try_element_at(a, F.lit("n")).cast("int"),
}


def instruction_checks(samples: DataFrame, text: Column, instructions: str, checks: dict[str, Check] | None = None) -> DataFrame:
    """``samples`` with ``strict`` and ``loose``: whether the response follows each of its instructions.

    ``instructions`` is an array of ``(name, args)``. A blank response follows nothing; loosely, one of its variants
    that is not blank must follow. An instruction without a check is an error.
    """
    checks = CHECKS if checks is None else checks

    def one(t: Column, i: Column) -> Column:
        out = F.raise_error(F.concat(F.lit("no check for instruction "), i["name"])).cast("boolean")
        for name, check in checks.items():
            out = F.when(i["name"] == name, F.coalesce(check(t, i["args"]), F.lit(False))).otherwise(out)
        return out

    full = strip_white(text) != ""
    met = samples.withColumn("__variants", F.filter(response_variants(text), lambda v: strip_white(v) != ""))
    strict = F.transform(instructions, lambda i: full & one(text, i))
    loose = F.transform(instructions, lambda i: F.exists("__variants", lambda v: one(v, i)))
    return met.withColumns({"strict": strict, "loose": loose}).drop("__variants")


def first_response(*fields: Column) -> Column:
    """The first text of the first JSON list that is not empty, however deep it is nested; an error if there is none."""
    inner = lambda f: F.regexp_extract(f, r'^[\s\[]*("(?:[^"\\]|\\.)*")', 1)
    said = F.coalesce(*(F.from_json(F.concat(F.lit("["), F.nullif(inner(f), F.lit("")), F.lit("]")), "array<string>")[0] for f in fields))
    return F.coalesce(said, F.raise_error(F.lit("no response in the sample")).cast("string"))


def truncated_answer(answer: Column, part: int = 3) -> Column:
    """The beginning of an answer, one character at least: a judge must prefer the whole."""
    return F.left(answer, F.greatest(F.lit(1), F.floor(F.char_length(answer) / part)).cast("int"))


def compared(candidates: DataFrame, references: DataFrame, key: str, order: str) -> DataFrame:
    """Candidates with the reference answer of their key, the last by ``order``; those without one are left out."""
    last = references.groupBy(key).agg(F.max_by("answer", order).alias("reference"))
    return candidates.join(last, key)


def objective(metrics: DataFrame, anchor: DataFrame, run: str, metric: str, value: str) -> DataFrame:
    """Mean difference to the anchor of each run's metrics, -1 without any. A missing anchor counts as 0."""
    base = anchor.select(F.col(metric).alias("__m"), F.col(value).alias("__v"))
    met = metrics.join(base, F.col(metric) == F.col("__m"), "left")
    delta = F.col(value) - F.coalesce("__v", F.lit(0.0))
    return met.groupBy(run).agg(F.coalesce(F.avg(delta), F.lit(-1.0)).alias("score"), F.count(value).alias("n_metrics"))


def valid_metrics(metrics: Column, required: list[str]) -> Column:
    """Every required metric is there, finite and within 0 and 1."""
    one = lambda k: F.coalesce(F.try_element_at(metrics, F.lit(k)).between(0, 1) & ~F.isnan(F.try_element_at(metrics, F.lit(k))), F.lit(False))
    out = F.lit(True)
    for k in required:
        out = out & one(k)
    return out


def gated(trials: DataFrame, floors: dict[str, Column], gray: float) -> DataFrame:
    """Trials with ``gate_reason`` (metrics below their floor), ``gray_band`` and ``eligible``."""
    below = F.filter(F.array(*(F.when(F.col(m) < f, m) for m, f in floors.items())), lambda x: x.isNotNull())
    near = F.filter(F.array(*(F.when((F.col(m) >= f) & (F.col(m) < f + gray), m) for m, f in floors.items())), lambda x: x.isNotNull())
    return trials.withColumns({"gate_reason": below, "gray_band": near}).withColumn("eligible", F.size("gate_reason") == 0)


def ranked_trials(trials: DataFrame, metric: str, order: str) -> DataFrame:
    """Eligible trials with their place, the best metric first."""
    return trials.where("eligible").withColumn("place", F.row_number().over(Window.partitionBy().orderBy(F.desc(metric), order)))


def reconcile(state: Column, attempts: Column, cap: int, remote_valid: Column, alive: Column, reachable: Column) -> Column:
    """The next step of a trial."""
    return (
        F.when(state == "success", "success").when(~reachable, "indeterminate").when(remote_valid, "adopt")
        .when((state == "running") & alive, "resume").when(state == "running", "pending").when(attempts >= cap, "exhausted").otherwise("pending")
    )


def disposition(image: Column, category: Column) -> Column:
    """What becomes of a reviewed task."""
    return (
        F.when(image == "missing", "hard_exclude_missing_image").when(image != "available", "hold_indeterminate_image")
        .when(category == "bugfix", "bugfix_survivor").when(category.startswith("future_"), "future_slice").otherwise("quality_reject")
    )


def logprob_class(n: Column, completion: Column, reasoning: Column) -> Column:
    """How much of a completion has log probabilities."""
    some = (n > 0) & (F.coalesce(completion, F.lit(0)) > 0)
    content = (F.coalesce(reasoning, F.lit(0)) > 0) & (F.abs(n - (completion - reasoning)) <= 0.05 * completion)
    return F.when(some & (n >= 0.95 * completion), "FULL").when(some & content, "CONTENT-ONLY").when(some, "UNCLEAR").when(n == 0, "NO LOGPROBS").otherwise("UNKNOWN")


def cache_discount(cached: Column, cold: Column, warm: Column) -> Column:
    """Whether repeated prompts are cheaper."""
    cheaper = (cold > 0) & (warm > 0) & (warm < 0.7 * cold)
    return F.when(F.coalesce(cached, F.lit(0)) > 0, "YES").when(F.coalesce(cheaper, F.lit(False)), "COST-ONLY").otherwise("NOT OBSERVED")


def probe_class(statuses: Column) -> Column:
    """available if an attempt answered 200, missing if one answered 404, else indeterminate."""
    return F.when(F.array_contains(statuses, 200), "available").when(F.array_contains(statuses, 404), "missing").otherwise("indeterminate")
