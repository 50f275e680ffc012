"""Reviews of task pools: coverage checks, repairs, dispositions, selection under caps, validation, frozen queues."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_list, hash_order
from .evals import disposition
from .mixture import dense_ids, group_places
from .tasks import interleaved

#: Fields of a task that are kept, and what a frozen queue says of each task.
CORE = ("instance_id", "repo", "problem_statement", "base_commit", "patch", "test_patch", "version", "hints_text", "created_at")
SMOKE = {"smoke_status": "pending", "smoke_scope": "base_fail_then_gold_pass_twice"}
NO_SPEND = "teacher_spend_approved"


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``(key, side, n)`` for keys that only one side has (``missing`` on the right, ``extra`` there), or twice (``repeated``)."""
    a = left.groupBy(key).agg(F.count("*").alias("__a"))
    b = right.groupBy(key).agg(F.count("*").alias("__b"))
    met = a.join(b, key, "full").select(key, F.coalesce("__a", F.lit(0)).alias("a"), F.coalesce("__b", F.lit(0)).alias("b"))
    side = F.when(F.col("b") == 0, "missing").when(F.col("a") == 0, "extra").when((F.col("a") > 1) | (F.col("b") > 1), "repeated")
    return met.select(key, side.alias("side"), (F.col("a") + F.col("b")).alias("n")).where(F.col("side").isNotNull())


def require_coverage(left: DataFrame, right: DataFrame, key: str, what: str) -> None:
    """Raise unless both sides have the same keys, once each."""
    bad = coverage(left, right, key).orderBy("side", key).limit(5).collect()
    if bad:
        raise ValueError(f"{what} does not cover the pool one to one: {[(r['side'], r[key]) for r in bad]}")


def complete(parts: dict[str, DataFrame], whole: DataFrame) -> DataFrame:
    """One row: rows of the whole, rows of its parts, and whether the parts account for all of it."""
    count = lambda df, name, sign: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n", F.lit(sign).alias("sign"))
    rows = [count(whole, "whole", 0), *(count(df, name, 1) for name, df in parts.items())]
    both = reduce(DataFrame.unionByName, rows)
    total, inside = F.sum(F.when(F.col("sign") == 0, F.col("n"))), F.sum(F.col("n") * F.col("sign"))
    return both.agg(total.alias("n_whole"), inside.alias("n_parts"), (total == inside).alias("complete"))


def overridden(automatic: DataFrame, human: DataFrame, key: str) -> DataFrame:
    """``automatic`` with the values of ``human`` where it has some, column by column."""
    given = [c for c in human.columns if c != key]
    met = automatic.join(human.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__h_{c}") for c in given)), F.col(key) == F.col("__k"), "left")
    out = {c: F.coalesce(F.col(f"__h_{c}"), F.col(c)) if c in automatic.columns else F.col(f"__h_{c}") for c in given}
    return met.withColumns(out).drop("__k", *(f"__h_{c}" for c in given))


def append_unique(values: Column, additions: Column) -> Column:
    """``values`` as they are, then the additions that are not among them, once each and in their order."""
    have = F.coalesce(values, F.array().cast("array<string>"))
    return F.concat(have, F.array_except(F.coalesce(additions, F.array().cast("array<string>")), have))


def decorated(rows: DataFrame, source: Column, title: Column, metadata: dict[str, Column]) -> DataFrame:
    """The kept fields of a task, its test lists as arrays, where it comes from, its title and the given metadata."""
    core = [c for c in CORE if c in rows.columns]
    lists = {c: as_list(F.col(c)) if dict(rows.dtypes)[c] == "string" else F.col(c) for c in ("FAIL_TO_PASS", "PASS_TO_PASS") if c in rows.columns}
    return rows.select(*core, *(v.alias(c) for c, v in lists.items()), source.alias("candidate_source"), title.alias("problem_title"), *(v.alias(c) for c, v in metadata.items()))


def repaired(rows: DataFrame, repairs: DataFrame, key: str) -> DataFrame:
    """``rows`` with repairs applied: tests and notes added once, text appended, the status set, and what was done as a struct.

    ``repairs`` has the key, ``add_fail``, ``add_pass`` (arrays), ``append`` and ``note``; at most one row for a key.
    """
    r = repairs.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in ("add_fail", "add_pass", "append", "note")))
    met = rows.join(r, F.col(key) == F.col("__k"), "left")
    has = F.col("__k").isNotNull()
    done = F.struct(F.lit("applied").alias("status"), F.col("__add_fail").alias("added_fail"), F.col("__add_pass").alias("added_pass"), (F.coalesce("__append", F.lit("")) != "").alias("clarified"), F.col("__note").alias("note"))
    return met.withColumns({
        "fail_to_pass": F.when(has, append_unique(F.col("fail_to_pass"), F.col("__add_fail"))).otherwise(F.col("fail_to_pass")),
        "pass_to_pass": F.when(has, append_unique(F.col("pass_to_pass"), F.col("__add_pass"))).otherwise(F.col("pass_to_pass")),
        "statement": F.when(has, F.concat(F.coalesce("statement", F.lit("")), F.coalesce("__append", F.lit("")))).otherwise(F.col("statement")),
        "status": F.when(has, "retained_seed_repaired").otherwise(F.col("status")),
        "notes": F.when(has, append_unique(F.col("notes"), F.array("__note"))).otherwise(F.col("notes")),
        "repair": F.when(has, done),
    }).drop("__k", "__add_fail", "__add_pass", "__append", "__note")


def reviewed(pool: DataFrame, preflight: DataFrame, manual: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The pool with its position, the image's result, the reviewer's category and the disposition.

    ``preflight`` has the key and ``image`` and must cover the pool one to one; ``manual`` has the key and
    ``category`` and must cover the pool's rows that are no ``seed``; seeds count as ``bugfix``.
    """
    require_coverage(pool, preflight, key, "the preflight")
    require_coverage(pool.where("not seed"), manual, key, "the manual review")
    placed = dense_ids(pool, order, "position", start=1).join(preflight.select(key, "image"), key).join(manual.select(key, "category"), key, "left")
    placed = placed.withColumn("category", F.when(F.col("seed"), "bugfix").otherwise(F.col("category")))
    return placed.withColumn("disposition", disposition(F.col("image"), F.col("category")))


def frozen_dispositions(frozen: DataFrame, seeds: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """What became of every task of an earlier list: a retained seed, or the reason of its drop; each must have one."""
    met = frozen.join(seeds.select(key).distinct().withColumn("__seed", F.lit(True)), key, "left")
    require_coverage(met.where(F.col("__seed").isNull()), dropped, key, "the drop review")
    met = met.join(dropped.select(key, F.col("disposition").alias("__d"), F.col("reason").alias("__r")), key, "left")
    return met.select(*frozen.columns, F.when(F.col("__seed"), "retained_seed").otherwise(F.col("__d")).alias("disposition"), F.when(F.col("__seed"), "explicitly retained").otherwise(F.col("__r")).alias("reason"))


def excluded(rows: DataFrame, lists: dict[str, DataFrame], key: str) -> DataFrame:
    """``rows`` with ``excluded``: the first of the named id lists that has the row, in the given order, else null."""
    out, why = rows, F.lit(None).cast("string")
    for name, ids in lists.items():
        out = out.join(ids.select(F.col(key).alias(f"__in_{name}")).distinct(), F.col(key) == F.col(f"__in_{name}"), "left")
        why = F.coalesce(why, F.when(F.col(f"__in_{name}").isNotNull(), name))
    return out.withColumn("excluded", why).drop(*(f"__in_{name}" for name in lists))


def violations(output: DataFrame, known: DataFrame, seeds: DataFrame, banned: dict[str, DataFrame], key: str, mix: dict[str, int], caps: dict[str, int], least: int) -> DataFrame:
    """``(check_name, n)`` for each rule that a selected pool must keep; all zero if it does.

    Rules: no id twice, no seed lost, no unknown id, none of the banned lists (seeds apart), the exact mix of
    difficulties, at most ``caps[c]`` rows of a value of column ``c``, and no score below ``least``.
    """
    row = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n")
    ids = output.select(key).distinct()
    auto = ids.join(seeds.select(key), key, "left_anti")
    found = [
        row(output.groupBy(key).count().where("count > 1"), "duplicate_ids"), row(seeds.select(key).distinct().join(ids, key, "left_anti"), "dropped_seeds"),
        row(ids.join(known.select(key), key, "left_anti"), "unknown_ids"), row(output.where(F.col("score") < least), "below_least_score"),
        *(row(auto.join(b.select(key).distinct(), key), f"overlap_{name}") for name, b in banned.items()),
        *(row(output.groupBy(c).count().where(F.col("count") > n), f"{c}_over_cap") for c, n in caps.items()),
    ]
    counts = output.groupBy("difficulty").agg(F.count("*").alias("n")).withColumn("want", F.coalesce(F.create_map(*(x for k, v in mix.items() for x in (F.lit(k), F.lit(v))))[F.col("difficulty")], F.lit(0)))
    wrong = counts.agg(F.count_if(F.col("n") != F.col("want")).alias("__w"), F.count_if(F.col("difficulty").isin(*mix)).alias("__h"))
    found.append(wrong.select(F.lit("wrong_mix").alias("check_name"), (F.col("__w") + len(mix) - F.col("__h")).alias("n")))
    return reduce(DataFrame.unionByName, found)


def split_by_tier(survivors: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """``survivors`` with ``selected``: every tier but ``hard``, and of the hard ones those on the list; the others are held."""
    met = survivors.join(allowed.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left")
    return met.withColumn("selected", (F.col("tier") != "hard") | F.col("__k").isNotNull()).drop("__k")


def frozen_queue(selected: DataFrame, tier: str, order: Column, pattern: tuple[str, ...]) -> DataFrame:
    """The selected tasks in the order in which they run, each with its position, status and scope, and no spend approved."""
    turn = interleaved(selected, tier, order, pattern)
    queue = dense_ids(turn, [F.col("cycle"), F.col("slot")], "smoke_queue_position", start=1).drop("cycle", "slot")
    return queue.withColumns({k: F.lit(v) for k, v in SMOKE.items()} | {NO_SPEND: F.lit(False)})


def chosen_only(queue: DataFrame, key: str, only: Collection[int | str] = (), limit: int | None = None, order: str = "smoke_queue_position") -> DataFrame:
    """The named rows of a queue (an unknown name is an error), at most ``limit`` of them by position."""
    if only:
        wanted = queue.sparkSession.createDataFrame([(x,) for x in set(only)], f"{key} {dict(queue.dtypes)[key]}")
        unknown = wanted.join(queue.select(key), key, "left_anti").limit(5).collect()
        if unknown:
            raise ValueError(f"not in the queue: {sorted(r[0] for r in unknown)}")
        queue = queue.join(wanted, key, "left_semi")
    return queue if limit is None else queue.orderBy(order).limit(limit)


def smoke_progress(queue: DataFrame, ledgers: DataFrame, key: str, queue_hash: str) -> DataFrame:
    """One row per task of the queue (``passed``, ``failed``, ``pending``) and per ledger of another queue (``stale``)."""
    mine = ledgers.where(F.col("queue_sha256") == queue_hash).select(F.col(key).alias("__k"), "smoke_pass")
    stale = ledgers.where(~F.col("queue_sha256").eqNullSafe(F.lit(queue_hash))).select(key, F.lit("stale").alias("state"))
    state = F.when(F.col("__k").isNull(), "pending").when(F.coalesce("smoke_pass", F.lit(False)), "passed").otherwise("failed")
    return queue.join(mine, F.col(key) == F.col("__k"), "left").select(key, state.alias("state")).unionByName(stale)


def topped_up(chosen: DataFrame, pool: DataFrame, key: str, tier: str, repo: str, want: Column, repo_cap: int, seed: int = 42) -> DataFrame:
    """``chosen`` and, for tiers short of ``want``, rows of a second pool with ``source`` ``topped_up``.

    Rows that are chosen already do not come again. Repositories count what was chosen of them; those with fewest come
    first, and none goes above ``repo_cap``.
    """
    have = chosen.groupBy(F.col(tier).alias("__t")).agg(F.count("*").alias("__have"))
    used = chosen.groupBy(F.col(repo).alias("__r")).agg(F.count("*").alias("__used"))
    spare = pool.join(chosen.select(key), key, "left_anti").withColumn("__o", hash_order(F.col(key), seed=seed))
    spare = spare.join(used, F.col(repo) == F.col("__r"), "left").withColumn("__used", F.coalesce("__used", F.lit(0)))
    spare = group_places(spare, [repo], [F.col("__o"), F.col(key)], "__own").where(F.col("__used") + F.col("__own") <= repo_cap)
    spare = group_places(spare.withColumn("__turn", F.col("__used") + F.col("__own")), [tier], [F.col("__turn"), F.col("__o"), F.col(key)], "__place")
    short = spare.join(have, F.col(tier) == F.col("__t"), "left").where(F.col("__place") <= want - F.coalesce("__have", F.lit(0)))
    out = short.select(*pool.columns, F.lit("topped_up").alias("source"))
    return chosen.withColumn("source", F.lit("first")).unionByName(out, allowMissingColumns=True)


def harvested_ids(documents: DataFrame, text: Column, key: str = "instance_id") -> DataFrame:
    """Ids that JSON documents name, each once: the ``key`` of an object, or of every object of a list; other text is passed over."""
    parsed = F.try_parse_json(text)
    one = F.try_variant_get(parsed, f"$.{key}", "string")
    items = F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed))
    every = F.transform(items, lambda v: F.try_variant_get(v, f"$.{key}", "string"))
    return documents.select(F.explode(F.coalesce(F.when(one.isNotNull(), F.array(one)), every)).alias(key)).where(F.coalesce(key, F.lit("")) != "").distinct()


def normalized_repo(repo: Column) -> Column:
    """A repository's name as it stands in ids."""
    return F.replace(repo, F.lit("/"), F.lit("__"))


def image_name(instance: Column, prefix: str) -> Column:
    """The image of a task; registries allow no double underscore and no capitals."""
    return F.lower(F.concat(F.lit(prefix), F.replace(instance, F.lit("__"), F.lit("_s_"))))
