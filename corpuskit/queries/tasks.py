"""Task rules, selection and schedules; ``documents`` play problem statements with made-up patches, ``events`` rollouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import as_list, changed_files, changed_lines, hash_order, title, word_count
from ..operators import tasks as ops
from .corpus import HASH, N, WORDS
from .messages import ROLLS, rollouts
from .registry import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

REPOS = ("python/mypy", "pandas-dev/pandas", "conan-io/conan", "iterative/dvc", "getmoto/moto", "acme/web")
PHRASES = (
    "The fix is to change x. I have this implemented.", "Steps to reproduce: file a.py line 3:10 fails", "Traceback with a stale cache and a deadlock", "Is this a bug or not?",
    "feature: add an api for windows timeout", "The dtype overflow in yaml parsing", "rename an empty list", "see github.com/a/b/blob/main/x.py#L10", "plain words only", "benchmark performance of async json load",
)
IMAGES = ("available", "missing", "indeterminate")
CATEGORIES = ("bugfix", "future_feature", "quality", "bugfix")


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


TASKS = f"""
    WITH base AS (SELECT doc_id AS id, {sql_list(REPOS)}[1 + doc_id % 6] AS repo, {sql_list(PHRASES)}[1 + doc_id % 10] || chr(10) || text AS statement,
        doc_id % 10 AS n_files, (doc_id * 7) % 60 AS n_add, CASE WHEN doc_id % 11 = 0 THEN 'tests' ELSE 'src' END AS dir, doc_id % 23 AS n_fail, doc_id % 7 AS n_pass FROM documents),
    p AS (SELECT *, coalesce(array_to_string([('diff --git a/' || dir || '/f' || i || '.py b/' || dir || '/f' || i || '.py' || chr(10) || '--- a/x' || chr(10) || '+++ b/x' || chr(10) || repeat('+new' || chr(10), n_add) || '-old' || chr(10)) FOR i IN range(0, n_files)], ''), '') AS patch,
        CASE WHEN id % 13 = 0 THEN '' ELSE 'diff' END AS test_patch, [('test_' || i || CASE WHEN id % 17 = 0 THEN '[x' ELSE '[x]' END) FOR i IN range(0, n_fail)] AS failing FROM base),
    t AS (SELECT *, len(regexp_extract_all(patch, '(?m)^diff --git a/(\\S+) b/\\S+', 1)) AS files, regexp_extract_all(patch, '(?m)^diff --git a/(\\S+) b/\\S+', 1) AS paths,
        len(list_filter(string_split(patch, chr(10)), lambda x: (starts_with(x, '+') AND NOT starts_with(x, '+++')) OR (starts_with(x, '-') AND NOT starts_with(x, '---')))) AS lines FROM p)
"""


def task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks made of documents, with patches and test lists that follow from the id."""
    i = F.col("doc_id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    base = table(spark, sf_dir, "documents").select(
        i.alias("id"), pick(REPOS).alias("repo"), F.concat(pick(PHRASES), F.lit("\n"), "text").alias("statement"), (i % 10).cast("int").alias("n_files"),
        ((i * 7) % 60).cast("int").alias("n_add"), F.when(i % 11 == 0, "tests").otherwise("src").alias("dir"), (i % 23).cast("int").alias("n_fail"), (i % 7).cast("int").alias("n_pass"),
    )
    name = lambda k: F.concat("dir", F.lit("/f"), k.cast("string"), F.lit(".py"))
    first = lambda n, most: F.filter(F.sequence(F.lit(0), F.lit(most)), lambda k: k < n)
    one = lambda k: F.concat(F.lit("diff --git a/"), name(k), F.lit(" b/"), name(k), F.lit("\n--- a/x\n+++ b/x\n"), F.repeat(F.lit("+new\n"), F.col("n_add")), F.lit("-old\n"))
    end = F.when(F.col("id") % 17 == 0, "[x").otherwise("[x]")
    full = base.withColumns({
        "patch": F.array_join(F.transform(first(F.col("n_files"), 9), one), ""), "test_patch": F.when(F.col("id") % 13 == 0, "").otherwise("diff"),
        "failing": F.transform(first(F.col("n_fail"), 22), lambda k: F.concat(F.lit("test_"), k.cast("string"), end)),
    })
    return full.withColumns({"paths": changed_files(F.col("patch")), "lines": changed_lines(F.col("patch"))}).withColumn("files", F.size("paths"))


@R.add(TASKS + "SELECT id, CAST(files AS BIGINT) AS files, CAST(lines AS BIGINT) AS lines FROM t")
def patch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return task_table(spark, sf_dir).select("id", F.col("files").cast("bigint").alias("files"), F.col("lines").cast("bigint").alias("lines"))


TIER = "CASE WHEN files >= 3 OR lines > 60 OR n_fail > 5 THEN 'hard' WHEN files = 1 AND lines < 15 THEN 'easy' ELSE 'medium' END"


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = task_table(spark, sf_dir)
    return t.withColumn("tier", ops.tier(F.col("files"), F.col("lines"), F.col("n_fail")))


@R.add(TASKS + f"SELECT id, {TIER} AS tier FROM t")
def tier_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered(spark, sf_dir).select("id", "tier")


def sql_any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def sql_hits(text: str, patterns: tuple[str, ...]) -> str:
    return "(" + " + ".join("CAST(regexp_matches({}, '{}') AS INTEGER)".format(text, p.replace("'", "''")) for p in patterns) + ")"


LOW = "lower(statement)"
CONCEPT_SQL = "(" + " + ".join(f"CAST({sql_any(LOW, k)} AS INTEGER)" for k in ops.CONCEPTS.values()) + ")"
SCORED = f"""
    , d AS (SELECT *, {sql_hits(LOW, ops.LEAKS)} AS leaks, {CONCEPT_SQL} AS concepts FROM t),
    c AS (SELECT *, CASE WHEN leaks >= 2 THEN 0 WHEN {sql_hits(LOW, ops.EXACT_PLACE)} > 0 THEN 1 WHEN {sql_any(LOW, (*ops.REPRODUCED, "traceback"))} THEN 2 ELSE 3 END AS localization,
        CASE WHEN concepts >= 2 THEN 3 WHEN concepts = 1 THEN 2 ELSE 1 END - CASE WHEN {sql_any(LOW, ops.TRIVIAL)} AND concepts <= 1 THEN 1 ELSE 0 END AS reasoning,
        CASE WHEN files >= 4 OR lines >= 100 THEN 3 WHEN files >= 2 OR lines >= 35 THEN 2 WHEN lines >= 15 THEN 1 ELSE 0 END AS coupling,
        CASE WHEN n_fail >= 4 OR (n_fail >= 2 AND n_pass >= 5) THEN 2 WHEN n_fail >= 2 OR (n_fail >= 1 AND n_pass >= 1) THEN 1 ELSE 0 END AS validation, least(2, leaks) AS hint_penalty FROM d),
    s AS (SELECT *, localization + reasoning + coupling + validation - hint_penalty AS score FROM c)
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = task_table(spark, sf_dir)
    return t.withColumns(ops.difficulty(F.col("statement"), F.col("files"), F.col("lines"), F.col("n_fail"), F.col("n_pass")))


@R.add(TASKS + SCORED + "SELECT id, localization, reasoning, coupling, validation, hint_penalty, score, CASE WHEN score >= 9 THEN 'hard' WHEN score >= 6 THEN 'medium' ELSE 'easy' END AS difficulty FROM s")
def difficulty_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("id", "localization", "reasoning", "coupling", "validation", "hint_penalty", "score", "difficulty")


BODY = "lower(statement || chr(10) || patch)"
FAMILY = (
    "CASE " + " ".join(f"WHEN {sql_any(BODY, ops.CONCEPTS[k] if isinstance(k, str) else k)}" + (f" OR {sql_any('lower(repo)', r)}" if r else "") + f" THEN '{n}'" for n, r, k in ops.FAMILIES) + " ELSE 'other' END"
)


@R.add(TASKS + f"SELECT id, {FAMILY} AS family FROM t")
def bug_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return task_table(spark, sf_dir).select("id", ops.bug_family(F.col("repo"), F.concat("statement", F.lit("\n"), "patch")).alias("family"))


QUALITY = f"""
    , q AS (SELECT id, list_filter([CASE WHEN len({WORDS.format(N.replace("text", "statement"))}) < 35 THEN 'problem_statement_too_short' END, CASE WHEN patch = '' OR files = 0 THEN 'missing_gold_patch' END,
        CASE WHEN test_patch = '' THEN 'missing_test_patch' END, CASE WHEN n_fail = 0 THEN 'missing_fail_to_pass' END,
        CASE WHEN len(list_filter(failing, lambda x: contains(x, '[') AND NOT suffix(x, ']'))) > 0 THEN 'malformed_fail_to_pass' END,
        CASE WHEN files > 0 AND len(list_filter(paths, lambda x: regexp_matches(x, '{ops.TEST_PATH}'))) = files THEN 'gold_changes_only_tests' END,
        CASE WHEN files > 8 OR lines > 350 THEN 'oversized_for_step_limited_rollout' END, CASE WHEN n_fail > 20 THEN 'verification_set_too_large' END,
        CASE WHEN {sql_hits(LOW, ops.AMBIGUOUS)} > 0 THEN 'ambiguous_expected_behavior' END, CASE WHEN {sql_hits(LOW, ops.LEAKS)} >= 2 THEN 'statement_reveals_implementation' END], lambda x: x IS NOT NULL) AS reasons FROM t)
"""


def rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = task_table(spark, sf_dir)
    reasons = ops.quality_reasons(F.col("statement"), word_count(F.col("statement")), F.col("patch"), F.col("paths"), F.col("lines"), F.col("test_patch"), F.col("failing"))
    return t.select("id", "repo", reasons.alias("reasons"))


@R.add(TASKS + QUALITY + "SELECT id, array_to_string(reasons, ',') AS reasons FROM q")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejections(spark, sf_dir).select("id", F.array_join("reasons", ",").alias("reasons"))


@R.add(TASKS + QUALITY + "SELECT r AS reason, count(*) AS n FROM (SELECT unnest(reasons) AS r FROM q) GROUP BY r")
def excluded_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with several reasons counts once for each."""
    return rejections(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


HEAD = "lower(string_split(statement, chr(10))[1])"


@R.add(TASKS + SCORED + f"""
    SELECT id, array_to_string(list_filter([CASE WHEN n_pass = 0 THEN 'no_pass_to_pass' END, CASE WHEN files >= 5 OR lines >= 150 THEN 'large_gold_patch' END,
        CASE WHEN {sql_any(LOW, ops.ENVIRONMENT)} THEN 'environment_or_time_sensitive' END, CASE WHEN hint_penalty > 0 THEN 'statement_contains_implementation_hint' END,
        CASE WHEN {" OR ".join(f"starts_with({HEAD}, '{x}')" for x in ops.FEATURE_TITLES)} OR regexp_matches({HEAD}, '{ops.FEATURE_VERBS}') OR contains({HEAD}, 'enhancements') THEN 'feature_request_not_bug' END,
        CASE WHEN {" OR ".join(f"starts_with({HEAD}, '{x}')" for x in ("perf:", "[perf]", "performance:"))} OR contains({HEAD}, 'performance improvement') THEN 'performance_task' END,
        CASE WHEN {" OR ".join(f"starts_with({HEAD}, '{x}')" for x in ("how do i", "how to ", "usage:", "question:"))} THEN 'usage_question' END,
        CASE WHEN {sql_any(HEAD, ("flake8", "lint", "typing cleanup", "documentation only"))} THEN 'maintenance_task' END,
        CASE WHEN contains({LOW}, 'benchmark') AND contains({LOW}, 'performance') THEN 'performance_validation_may_be_weak' END], lambda x: x IS NOT NULL), ',') AS flags FROM s
""")
def review_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    flags = ops.review_flags(F.col("statement"), title(F.col("statement")), F.col("files"), F.col("lines"), F.col("n_pass"), F.col("hint_penalty"))
    return s.select("id", F.array_join(flags, ",").alias("flags"))


CAPPED = f"""
    , r AS (SELECT id, repo, {TIER} AS tier, {HASH.format(42, 'id')} AS o FROM t), a AS (SELECT *, row_number() OVER (PARTITION BY tier, repo ORDER BY o) AS repo_place FROM r),
    b AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY repo_place, o) AS tier_place FROM a WHERE repo_place <= 4),
    sel AS (SELECT * FROM b WHERE tier_place <= CASE tier WHEN 'hard' THEN 20 WHEN 'medium' THEN 12 ELSE 5 END)
"""


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(F.col("tier") == "hard", 20).when(F.col("tier") == "medium", 12).otherwise(5)
    return ops.stratified_cap(tiered(spark, sf_dir).select("id", "repo", "tier"), "tier", "repo", hash_order(F.col("id")), 4, target)


@R.add(TASKS + CAPPED + "SELECT id, repo, tier, CAST(repo_place AS INTEGER) AS repo_place, CAST(tier_place AS INTEGER) AS tier_place FROM sel")
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen(spark, sf_dir)


@R.add(TASKS + CAPPED + """
    SELECT 'duplicate_ids' AS check_name, count(*) - count(DISTINCT id) AS n FROM sel UNION ALL SELECT 'repo_over_cap', count(*) FROM (SELECT 1 FROM sel GROUP BY tier, repo HAVING count(*) > 4)
    UNION ALL SELECT 'short_tiers', count(*) FROM (SELECT tier FROM sel GROUP BY tier HAVING count(*) < CASE tier WHEN 'hard' THEN 20 WHEN 'medium' THEN 12 ELSE 5 END)
""")
def selection_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of broken selection rules."""
    sel = chosen(spark, sf_dir)
    target = F.when(F.col("tier") == "hard", 20).when(F.col("tier") == "medium", 12).otherwise(5)
    row = lambda df, name: df.select(F.lit(name).alias("check_name"), "n")
    dup = row(sel.agg((F.count("*") - F.countDistinct("id")).alias("n")), "duplicate_ids")
    over = row(sel.groupBy("tier", "repo").count().where("count > 4").agg(F.count("*").alias("n")), "repo_over_cap")
    short = row(sel.groupBy("tier").count().where(F.col("count") < target).agg(F.count("*").alias("n")), "short_tiers")
    return dup.unionByName(over).unionByName(short)


@R.add()
def balanced_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty tasks by the sequential balanced greedy; its order of picks is beyond SQL."""
    s = scored(spark, sf_dir)
    family = ops.bug_family(F.col("repo"), F.concat("statement", F.lit("\n"), "patch"))
    return ops.balanced_greedy(s.select("id", "repo", family.alias("family"), "score", F.lit(0).alias("n_flags")), 40)


@R.add(TASKS + f"""
    , r AS (SELECT id, {TIER} AS tier, {HASH.format(42, 'id')} AS o FROM t), n AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY o) - 1 AS k FROM r)
    SELECT id, tier, CASE WHEN tier = 'medium' THEN k // 2 ELSE k END AS cycle, CASE WHEN tier = 'medium' THEN 2 * (k % 2) WHEN tier = 'easy' THEN 1 ELSE 3 END AS slot FROM n
""")
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tiered(spark, sf_dir).select("id", "tier")
    out = ops.interleaved(t, "tier", hash_order(F.col("id")), ("medium", "easy", "medium", "hard"))
    return out.select("id", "tier", "cycle", F.col("slot").cast("bigint").alias("slot"))


@R.add(TASKS + f"SELECT id, {TIER} AS tier, (row_number() OVER (PARTITION BY {TIER} ORDER BY id) - 1) % 3 AS worker FROM t")
def worker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.round_robin(tiered(spark, sf_dir).select("id", "tier"), "tier", F.col("id"), 3).withColumn("worker", F.col("worker").cast("bigint"))


@R.add(f"""
    WITH r AS (SELECT task, rollout, good, coalesce(sum(good::INT) OVER w, 0) AS before, row_number() OVER (PARTITION BY task ORDER BY rollout) AS k FROM {ROLLS} WINDOW w AS (PARTITION BY task ORDER BY rollout ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT task, rollout, good, CAST(before AS BIGINT) AS n_before FROM r WHERE before < 1 + task % 2 AND k <= 4
""")
def adaptive_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.adaptive_stop(rollouts(spark, sf_dir).select("task", "rollout", "good"), "task", "rollout", "good", F.col("task") % 2 + 1, F.lit(4))


@R.add(f"SELECT event_type AS tier, task % 7 AS repo, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM {ROLLS} GROUP BY ROLLUP (event_type, task % 7)")
def tier_repo_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and cost by tier and repository, with subtotals (null keys)."""
    r = rollouts(spark, sf_dir).select(F.col("event_type").alias("tier"), (F.col("task") % 7).alias("repo"), F.round(F.col("value") * 100).cast("bigint").alias("c"))
    return r.rollup("tier", "repo").agg(F.count("*").alias("n"), F.sum("c").alias("cents"))


@R.add(f"""
    WITH t AS (SELECT task % 3 AS tier, task, bool_or(good) AS ok FROM {ROLLS} GROUP BY 1, 2), a AS (SELECT tier, count(*) AS tasks, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS verified FROM t GROUP BY tier),
    b AS (SELECT task % 3 AS tier, count(*) AS rollouts, CAST(count(*) FILTER (WHERE good) AS BIGINT) AS successes, avg(nullif(rollout % 9, 0)) AS mean_steps FROM {ROLLS} GROUP BY 1)
    SELECT tier, tasks, verified, rollouts, successes, mean_steps FROM a JOIN b USING (tier)
""")
def rehearsal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task and rollout counts by tier; steps of 0 do not count for the mean."""
    r = rollouts(spark, sf_dir).withColumn("tier", F.col("task") % 3)
    a = r.groupBy("tier", "task").agg(F.bool_or("good").alias("ok")).groupBy("tier").agg(F.count("*").alias("tasks"), F.count_if("ok").alias("verified"))
    b = r.groupBy("tier").agg(F.count("*").alias("rollouts"), F.count_if("good").alias("successes"), F.avg(F.nullif(F.col("rollout") % 9, F.lit(0))).alias("mean_steps"))
    return a.join(b, "tier")


@R.add(f"""
    WITH r AS (SELECT task, rollout, CAST(round(value * 100) AS BIGINT) AS c FROM {ROLLS}), s AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY task ORDER BY rollout ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM r)
    SELECT task, rollout, CAST(b AS BIGINT) AS spent_before FROM s WHERE b <= 5000
""")
def cost_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rollouts(spark, sf_dir).select("task", "rollout", F.round(F.col("value") * 100).cast("bigint").alias("c"))
    return ops.running_guard(r, ["task"], [F.col("rollout")], F.col("c"), 5000).select("task", "rollout", F.col("spent_before").cast("bigint").alias("spent_before"))


@R.add(f"""
    WITH s AS (SELECT task, rollout, count(*) OVER w AS n, CAST(sum(good::INT) OVER w AS BIGINT) AS k FROM {ROLLS} WINDOW w AS (PARTITION BY task ORDER BY rollout ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
    SELECT task, rollout, n, k, task % 5 <> 0 AND n >= 30 AND k < 0.1 * n AS paused FROM s
""")
def rolling_rate_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("task").orderBy("rollout").rowsBetween(-49, 0)
    s = rollouts(spark, sf_dir).select("task", "rollout", F.count("*").over(w).alias("n"), F.sum(F.col("good").cast("int")).over(w).alias("k"))
    # Tasks with a decision of their own (every fifth here) are exempt.
    return s.withColumn("paused", (F.col("task") % 5 != 0) & (F.col("n") >= 30) & (F.col("k") < 0.1 * F.col("n")))


@R.add(f"""
    SELECT p_partkey AS id, lower('registry/' || replace(p_name, ' ', '_s_')) AS image, {sql_list(IMAGES)}[1 + p_partkey % 3] AS result, {sql_list(CATEGORIES)}[1 + p_partkey % 4] AS category,
    CASE p_partkey % 3 WHEN 1 THEN 'hard_exclude_missing_image' WHEN 2 THEN 'hold_indeterminate_image' ELSE CASE WHEN {sql_list(CATEGORIES)}[1 + p_partkey % 4] = 'bugfix' THEN 'bugfix_survivor' WHEN p_partkey % 4 = 1 THEN 'future_slice' ELSE 'quality_reject' END END AS disposition FROM part
""")
def disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.evals import disposition as decide

    k = F.col("p_partkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    p = table(spark, sf_dir, "part").select(k.alias("id"), F.lower(F.concat(F.lit("registry/"), F.replace("p_name", F.lit(" "), F.lit("_s_")))).alias("image"), pick(IMAGES).alias("result"), pick(CATEGORIES).alias("category"))
    return p.withColumn("disposition", decide(F.col("result"), F.col("category")))


@R.add("SELECT p_brand AS repo, CAST(count(*) FILTER (WHERE p_partkey % 3 = 0) AS BIGINT) AS available, CAST(count(*) FILTER (WHERE p_partkey % 3 = 1) AS BIGINT) AS missing, CAST(count(*) FILTER (WHERE p_partkey % 3 = 2) AS BIGINT) AS indeterminate FROM part GROUP BY p_brand")
def preflight_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.element_at(F.array(*map(F.lit, IMAGES)), (F.col("p_partkey") % 3 + 1).cast("int"))
    counts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("repo"), result.alias("result")).groupBy("repo").pivot("result", list(IMAGES)).agg(F.count(F.lit(1)))
    return counts.na.fill(0)


@R.add("WITH a AS (SELECT o_custkey AS image, list(CASE o_orderkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 503 END) AS s FROM orders GROUP BY o_custkey) SELECT image, CASE WHEN list_contains(s, 200) THEN 'available' WHEN list_contains(s, 404) THEN 'missing' ELSE 'indeterminate' END AS result FROM a")
def probe_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.evals import probe_class as classify

    k = F.col("o_orderkey") % 5
    tries = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("image")).agg(F.collect_set(F.when(k == 0, 200).when(k == 1, 404).otherwise(503)).alias("s"))
    return tries.select("image", classify(F.col("s")).alias("result"))


@R.add("SELECT event_id, CASE WHEN props IS NULL THEN [] WHEN event_id % 3 = 0 THEN [event_type, 'x y'] ELSE [props] END AS items FROM events")
def list_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polymorphic list fields: a JSON list is its items, any other text is one item."""
    mixed = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('["'), "event_type", F.lit('", "x y"]'))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", as_list(F.when(F.col("props").isNotNull(), mixed)).alias("items"))


@R.add("SELECT p_partkey AS id, p_partkey % 5 = 0 AS is_base, p_size AS score FROM part WHERE p_partkey % 4 <> 0")
def id_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool without the ids of an exclusion list."""
    part = table(spark, sf_dir, "part")
    banned = part.where("p_partkey % 4 = 0").select("p_partkey")
    return part.join(banned, "p_partkey", "left_anti").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 5 == 0).alias("is_base"), F.col("p_size").alias("score"))


@R.add("SELECT p_brand AS repo, p_type AS family, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_type))")
def by_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("repo"), F.col("p_type").alias("family"))
    return part.groupingSets([["repo"], ["family"]], "repo", "family").agg(F.count("*").alias("n"))


