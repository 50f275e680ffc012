"""Reviews, selections and sweeps over real joins: orders are tasks, their line items preflights, reviews and attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hash_order, title
from ..operators import evals, review, sweeps
from ..operators.contamination import gate
from ..session import durable
from .corpus import HASH, N, WORDS, docs
from .registry import Registry, table
from .tasks import TASKS, scored

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

# ---------------------------------------------------------------- coverage and review

POOL_SQL = """
    WITH pool AS (SELECT o_orderkey AS id, o_orderstatus = 'F' AS seed, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
    pre AS (SELECT l_orderkey AS id, CASE min(l_returnflag) WHEN 'N' THEN 'available' WHEN 'R' THEN 'missing' ELSE 'indeterminate' END AS image FROM lineitem GROUP BY l_orderkey),
    man AS (SELECT l_orderkey AS id, CASE max(l_linenumber) % 3 WHEN 0 THEN 'bugfix' WHEN 1 THEN 'future_feature' ELSE 'quality' END AS category FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT pool.id, position, seed, image, CASE WHEN seed THEN 'bugfix' ELSE category END AS category FROM pool JOIN pre USING (id) LEFT JOIN man USING (id)),
    d AS (SELECT *, CASE WHEN image = 'missing' THEN 'hard_exclude_missing_image' WHEN image <> 'available' THEN 'hold_indeterminate_image' WHEN category = 'bugfix' THEN 'bugfix_survivor' WHEN starts_with(category, 'future_') THEN 'future_slice' ELSE 'quality_reject' END AS disposition FROM j)
"""


def pool_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A pool of orders that have line items, a preflight and a manual review of each."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_returnflag").alias("f"), F.max("l_linenumber").alias("n"))
    pre = lines.select("id", F.when(F.col("f") == "N", "available").when(F.col("f") == "R", "missing").otherwise("indeterminate").alias("image"))
    man = lines.select("id", F.when(F.col("n") % 3 == 0, "bugfix").when(F.col("n") % 3 == 1, "future_feature").otherwise("quality").alias("category"))
    pool = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").alias("seed")).join(lines.select("id"), "id", "left_semi")
    return pool, pre, man


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool, pre, man = pool_tables(spark, sf_dir)
    return review.reviewed(pool, pre, man.join(pool.where("not seed").select("id"), "id", "left_semi"), "id", [F.col("id")])


@R.add(POOL_SQL + "SELECT id, position, seed, image, category, disposition FROM d")
def review_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool with its preflight, review and disposition; both must cover it one to one."""
    return reviewed(spark, sf_dir).select("id", "position", "seed", "image", "category", "disposition")


@R.add(POOL_SQL + "SELECT count(*) AS n_whole, CAST(count(*) FILTER (WHERE disposition IN ('bugfix_survivor', 'future_slice', 'quality_reject', 'hard_exclude_missing_image')) AS BIGINT) AS n_parts, count(*) FILTER (WHERE disposition = 'hold_indeterminate_image') = 0 AS complete FROM d")
def partition_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the named parts account for the whole review; rows on hold are in none."""
    r = reviewed(spark, sf_dir)
    return review.complete({d: r.where(F.col("disposition") == d) for d in ("bugfix_survivor", "future_slice", "quality_reject", "hard_exclude_missing_image")}, r)


@R.add("""
    WITH a AS (SELECT doc_id, count(*) AS a FROM documents GROUP BY 1), b AS (SELECT doc_id, count(*) AS b FROM (SELECT doc_id FROM labels UNION ALL SELECT item_id * 7 FROM benchmark) GROUP BY 1),
    m AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM a FULL JOIN b USING (doc_id))
    SELECT doc_id, CASE WHEN b = 0 THEN 'missing' WHEN a = 0 THEN 'extra' ELSE 'repeated' END AS side, CAST(a + b AS BIGINT) AS n FROM m WHERE a = 0 OR b = 0 OR a > 1 OR b > 1
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that only one of two tables has, or that one has twice."""
    other = table(spark, sf_dir, "labels").select("doc_id").unionByName(table(spark, sf_dir, "benchmark").select((F.col("item_id") * 7).alias("doc_id")))
    return review.coverage(docs(spark, sf_dir).select("doc_id"), other, "doc_id")


@R.add("""
    WITH s AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey < 5), f AS (SELECT s_suppkey AS id, s_name FROM supplier)
    SELECT id, f.s_name, CASE WHEN id IN (SELECT id FROM s) THEN 'retained_seed' WHEN n.n_regionkey = 0 THEN 'drop_region' ELSE 'drop_other' END AS disposition, CASE WHEN id IN (SELECT id FROM s) THEN 'explicitly retained' ELSE n.n_name END AS reason
    FROM f JOIN supplier x ON x.s_suppkey = f.id JOIN nation n ON n.n_nationkey = x.s_nationkey
""")
def frozen_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each task of an earlier list; suppliers are tasks, their nations the reviewers' reasons."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", "s_nationkey")
    why = s.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).where("s_nationkey >= 5")
    dropped = why.select("id", F.when(F.col("n_regionkey") == 0, "drop_region").otherwise("drop_other").alias("disposition"), F.col("n_name").alias("reason"))
    return review.frozen_dispositions(s.select("id", "s_name"), s.where("s_nationkey < 5").select("id"), dropped, "id")


@R.add("""
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'auto' ELSE 'human' END AS judged_by, coalesce(l.quality, CASE WHEN length(d.text) > 500 THEN 1 ELSE 0 END) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def human_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic values, replaced by a human's where there is one."""
    auto = docs(spark, sf_dir).select("doc_id", F.lit("auto").alias("judged_by"), F.when(F.char_length("text") > 500, 1).otherwise(0).alias("quality"))
    human = table(spark, sf_dir, "labels").select("doc_id", F.lit("human").alias("judged_by"), "quality")
    return review.overridden(auto, human, "doc_id")


@R.add("""
    WITH r AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_returnflag)) AS add_fail, list_sort(list(DISTINCT l_linestatus)) AS add_pass FROM lineitem WHERE l_quantity > 48 GROUP BY 1),
    o AS (SELECT o_orderkey AS id, ['A', 'x'] AS f, ['O'] AS p, o_orderpriority AS statement FROM orders)
    SELECT o.id, array_to_string(CASE WHEN r.id IS NULL THEN f ELSE list_concat(f, list_filter(add_fail, lambda x: NOT list_contains(f, x))) END, ',') AS fail_to_pass, array_to_string(CASE WHEN r.id IS NULL THEN p ELSE list_concat(p, list_filter(add_pass, lambda x: NOT list_contains(p, x))) END, ',') AS pass_to_pass,
        CASE WHEN r.id IS NULL THEN statement WHEN o.id % 2 = 0 THEN statement || ' clarified' ELSE statement END AS statement, CASE WHEN r.id IS NULL THEN 'retained' ELSE 'retained_seed_repaired' END AS status,
        CASE WHEN r.id IS NULL THEN 'seen' ELSE 'seen,repaired' END AS notes, CASE WHEN r.id IS NOT NULL THEN o.id % 2 = 0 END AS clarified FROM o LEFT JOIN r USING (id)
""")
def seed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of retained tasks: tests added once, text appended, status and notes set."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 48").groupBy(F.col("l_orderkey").alias("id"))
    repairs = lines.agg(F.array_sort(F.collect_set("l_returnflag")).alias("add_fail"), F.array_sort(F.collect_set("l_linestatus")).alias("add_pass")).select("*", F.when(F.col("id") % 2 == 0, " clarified").otherwise("").alias("append"), F.lit("repaired").alias("note"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array(F.lit("A"), F.lit("x")).alias("fail_to_pass"), F.array(F.lit("O")).alias("pass_to_pass"), F.col("o_orderpriority").alias("statement"), F.lit("retained").alias("status"), F.array(F.lit("seen")).alias("notes"))
    out = review.repaired(o, repairs, "id")
    return out.select("id", *(F.array_join(c, ",").alias(c) for c in ("fail_to_pass", "pass_to_pass", "notes")), "statement", "status", F.col("repair.clarified").alias("clarified"))


@R.add(TASKS + f"SELECT id, repo, 'pool' AS candidate_source, left(coalesce(list_filter(list_transform(string_split(statement, chr(10)), lambda x: trim(regexp_replace(trim(x), '^#+', ''))), lambda x: x <> '')[1], ''), 180) AS problem_title, CAST(len(failing) AS BIGINT) AS n_fail, CASE WHEN {{tier}} THEN 'big' ELSE 'small' END AS size, row_number() OVER (ORDER BY {HASH.format(42, 'id')}, id) AS position FROM t".replace("{tier}", "files >= 3"))
def review_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept fields of each task with its title, metadata and 1-based position."""
    from ..operators.mixture import dense_ids
    from .tasks import task_table

    t = task_table(spark, sf_dir).withColumnsRenamed({"id": "instance_id", "statement": "problem_statement", "failing": "FAIL_TO_PASS"})
    rows = review.decorated(t, F.lit("pool"), title(F.col("problem_statement")), {"size": F.when(F.col("files") >= 3, "big").otherwise("small"), "o": hash_order(F.col("instance_id"))})
    rows = rows.select(F.col("instance_id").alias("id"), "repo", "candidate_source", "problem_title", F.size("FAIL_TO_PASS").cast("bigint").alias("n_fail"), "size", "o")
    return dense_ids(rows, [F.col("o"), F.col("id")], "position", start=1).drop("o")


# ---------------------------------------------------------------- selection


@R.add("""
    WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 49), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_discount > 0.09), c AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_tax > 0.07)
    SELECT coalesce(CASE WHEN p_partkey IN (SELECT k FROM a) THEN 'lite_member' WHEN p_partkey IN (SELECT k FROM b) THEN 'prior' WHEN p_partkey IN (SELECT k FROM c) THEN 'rejected' END, 'eligible') AS reason, count(*) AS n FROM part GROUP BY 1
""")
def ordered_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by the first of three id lists that holds a task."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "id")
    lists = {"lite_member": lines.where("l_quantity > 49"), "prior": lines.where("l_discount > 0.09"), "rejected": lines.where("l_tax > 0.07")}
    out = review.excluded(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")), {k: v.select("id") for k, v in lists.items()}, "id")
    return out.groupBy(F.coalesce("excluded", F.lit("eligible")).alias("reason")).agg(F.count("*").alias("n"))


OUT_SQL = """
    WITH o AS (SELECT p_partkey AS id, p_brand AS repo, p_type AS bug_family, p_size AS score, CASE WHEN p_size >= 30 THEN 'hard' ELSE 'medium' END AS difficulty FROM part WHERE p_size >= 10 UNION ALL SELECT p_partkey, p_brand, p_type, 3, 'hard' FROM part WHERE p_size = 50),
    s AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity >= 50), b AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_discount >= 0.1), k AS (SELECT p_partkey AS id FROM part WHERE p_size < 50),
    i AS (SELECT DISTINCT id FROM o), au AS (SELECT id FROM i WHERE id NOT IN (SELECT id FROM s))
"""


@R.add(OUT_SQL + """
    SELECT 'duplicate_ids' AS check_name, count(*) AS n FROM (SELECT id FROM o GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'dropped_seeds', count(*) FROM s WHERE id NOT IN (SELECT id FROM i)
    UNION ALL SELECT 'unknown_ids', count(*) FROM i WHERE id NOT IN (SELECT id FROM k) UNION ALL SELECT 'below_least_score', count(*) FROM o WHERE score < 6
    UNION ALL SELECT 'overlap_prior', count(*) FROM au WHERE id IN (SELECT id FROM b) UNION ALL SELECT 'repo_over_cap', count(*) FROM (SELECT repo FROM o GROUP BY repo HAVING count(*) > 60)
    UNION ALL SELECT 'bug_family_over_cap', count(*) FROM (SELECT bug_family FROM o GROUP BY bug_family HAVING count(*) > 25)
    UNION ALL SELECT 'wrong_mix', (SELECT count(*) FROM (SELECT difficulty, count(*) AS n FROM o GROUP BY 1) WHERE n <> CASE difficulty WHEN 'hard' THEN 100 WHEN 'medium' THEN 50 ELSE 0 END) + 2 - (SELECT count(DISTINCT difficulty) FROM o WHERE difficulty IN ('hard', 'medium'))
""")
def output_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of broken rules of a selected pool, rule by rule."""
    part, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "id")
    row = lambda df, score, d: df.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("repo"), F.col("p_type").alias("bug_family"), score.alias("score"), d.alias("difficulty"))
    out = row(part.where("p_size >= 10"), F.col("p_size"), F.when(F.col("p_size") >= 30, "hard").otherwise("medium")).unionByName(row(part.where("p_size = 50"), F.lit(3), F.lit("hard")))
    known = part.where("p_size < 50").select(F.col("p_partkey").alias("id"))
    seeds, prior = lines.where("l_quantity >= 50").select("id").distinct(), lines.where("l_discount >= 0.1").select("id").distinct()
    return review.violations(out, known, seeds, {"prior": prior}, "id", {"hard": 100, "medium": 50}, {"repo": 60, "bug_family": 25}, 6)


@R.add()
def seeded_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balanced greedy after seeds, whose repositories and families count from the start; its order of picks is beyond SQL."""
    from ..operators import tasks as ops

    s = scored(spark, sf_dir)
    pool = s.select("id", "repo", ops.bug_family(F.col("repo"), F.concat("statement", F.lit("\n"), "patch")).alias("family"), "score", F.lit(0).alias("n_flags"))
    pool = durable(pool)  # read three times; texts are scored once
    seeds = pool.join(table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")), "id", "left_semi").orderBy("id").limit(6)
    return ops.balanced_greedy(pool, 40, seeds=seeds)


TIERED_SQL = POOL_SQL + """
    , a AS (SELECT o_orderkey AS id FROM orders WHERE o_totalprice > 200000), v AS (SELECT d.id, CASE o_orderpriority WHEN '1-URGENT' THEN 'hard' WHEN '2-HIGH' THEN 'medium' ELSE 'easy' END AS tier FROM d JOIN orders ON o_orderkey = d.id WHERE disposition = 'bugfix_survivor'),
    z AS (SELECT *, tier <> 'hard' OR id IN (SELECT id FROM a) AS selected FROM v)
"""


def tiered_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    tier = F.when(F.col("o_orderpriority") == "1-URGENT", "hard").when(F.col("o_orderpriority") == "2-HIGH", "medium").otherwise("easy")
    alive = reviewed(spark, sf_dir).where("disposition = 'bugfix_survivor'").select("id").join(orders.select(F.col("o_orderkey").alias("id"), tier.alias("tier")), "id")
    return review.split_by_tier(alive, "id", orders.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("id")))


@R.add(TIERED_SQL + "SELECT tier, selected, count(*) AS n FROM z GROUP BY tier, selected")
def tier_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors by tier, selected or held."""
    return tiered_survivors(spark, sf_dir).groupBy("tier", "selected").agg(F.count("*").alias("n"))


@R.add(TIERED_SQL + f"""
    , n AS (SELECT id, tier, row_number() OVER (PARTITION BY tier ORDER BY {HASH.format(42, 'id')}) - 1 AS k FROM z WHERE selected),
    c AS (SELECT *, CASE WHEN tier = 'medium' THEN k // 2 ELSE k END AS cycle, CASE WHEN tier = 'medium' THEN 2 * (k % 2) WHEN tier = 'easy' THEN 1 ELSE 3 END AS slot FROM n)
    SELECT id, tier, row_number() OVER (ORDER BY cycle, slot) AS smoke_queue_position, 'pending' AS smoke_status, 'base_fail_then_gold_pass_twice' AS smoke_scope, FALSE AS teacher_spend_approved FROM c
""")
def frozen_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected tasks in the order in which they run."""
    chosen = tiered_survivors(spark, sf_dir).where("selected").drop("selected")
    return review.frozen_queue(chosen, "tier", hash_order(F.col("id")), ("medium", "easy", "medium", "hard"))


@R.add("""
    WITH q AS (SELECT o_orderkey AS id FROM orders), l AS (SELECT l_orderkey AS id, min(l_linestatus) AS queue_sha256, bool_and(l_quantity > 5) AS smoke_pass FROM lineitem GROUP BY 1)
    SELECT q.id, CASE WHEN l.id IS NULL THEN 'pending' WHEN smoke_pass THEN 'passed' ELSE 'failed' END AS state FROM q LEFT JOIN (SELECT * FROM l WHERE queue_sha256 = 'F') l USING (id)
    UNION ALL SELECT id, 'stale' FROM l WHERE queue_sha256 <> 'F'
""")
def smoke_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks passed, failed and pending, and ledgers of another queue."""
    ledgers = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_linestatus").alias("queue_sha256"), F.bool_and(F.col("l_quantity") > 5).alias("smoke_pass"))
    return review.smoke_progress(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), ledgers, "id", "F")


@R.add(f"""
    WITH c AS (SELECT p_partkey AS id, p_brand AS repo, p_type AS tier FROM part WHERE p_size > 40), h AS (SELECT tier, count(*) AS have FROM c GROUP BY 1), u AS (SELECT repo, count(*) AS used FROM c GROUP BY 1),
    s AS (SELECT p_partkey AS id, p_brand AS repo, p_type AS tier, {HASH.format(42, 'p_partkey')} AS o, coalesce(used, 0) AS used FROM part LEFT JOIN u ON u.repo = p_brand WHERE p_partkey NOT IN (SELECT id FROM c)),
    w AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY o, id) AS own FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY used + own, o, id) AS place FROM w WHERE used + own <= 40)
    SELECT id, repo, tier, 'first' AS source FROM c UNION ALL SELECT k.id, k.repo, k.tier, 'topped_up' FROM k LEFT JOIN h USING (tier) WHERE place <= 30 - coalesce(have, 0)
""")
def topped_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers short of their target get tasks of a second pool, repositories with fewest first."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("repo"), F.col("p_type").alias("tier"), "p_size")
    return review.topped_up(p.where("p_size > 40").drop("p_size"), p.drop("p_size"), "id", "tier", "repo", F.lit(30), 40)


@R.add("SELECT DISTINCT props->>'$.k' AS instance_id FROM events WHERE props->>'$.k' IS NOT NULL AND props->>'$.k' <> ''")
def harvested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that JSON documents name."""
    return review.harvested_ids(table(spark, sf_dir, "events"), F.col("props"), "k").withColumnRenamed("k", "instance_id")


@R.add("SELECT doc_id, lower('registry/' || replace(source || '__' || lang, '__', '_s_')) AS image, replace('Org/' || source, '/', '__') AS repo_id, to_base64(encode(left(source, 3))) AS encoded FROM documents")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of images and repositories as registries and ids spell them, and their transport form."""
    return docs(spark, sf_dir).select("doc_id", review.image_name(F.concat("source", F.lit("__"), "lang"), "registry/").alias("image"), review.normalized_repo(F.concat(F.lit("Org/"), "source")).alias("repo_id"), F.base64(F.left("source", F.lit(3)).cast("binary")).alias("encoded"))


@R.add("SELECT doc_id, left(text, 120) AS head, right(text, 500) AS tail, array_to_string(string_split(text, ' ')[1:15], ' ') AS words FROM documents")
def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut previews that reports show: first and last characters, first words."""
    return docs(spark, sf_dir).select("doc_id", F.left("text", F.lit(120)).alias("head"), F.right("text", F.lit(500)).alias("tail"), F.array_join(F.slice(F.split("text", " ", -1), 1, 15), " ").alias("words"))


@R.add("SELECT 'one_language' AS gate, count(*) AS n_violations, CASE WHEN count(*) = 0 THEN 'CLEAN' ELSE 'CONTAMINATED' END AS verdict FROM documents WHERE lang <> 'en'")
def format_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are not of the one format that a pack takes."""
    return gate("one_language", docs(spark, sf_dir).where("lang <> 'en'"))


# ---------------------------------------------------------------- evaluation



@R.add(f"""
    WITH v AS (SELECT doc_id, text AS t, replace(text, '*', '') AS n, array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s', ' ', 'g')) <> ''), chr(10)) AS b FROM documents),
    w AS (SELECT doc_id, {{f}} AS ft, {{f2}} AS fn, {{f3}} AS fb, trim(regexp_replace(t, '\\s', ' ', 'g')) <> '' AS is_full, trim(regexp_replace(n, '\\s', ' ', 'g')) <> '' AS nfull FROM v)
    SELECT doc_id, [(is_full AND x) FOR x IN ft] AS strict, [((is_full AND ft[i]) OR (nfull AND fn[i]) OR (is_full AND fb[i])) FOR i IN range(1, 4)] AS loose FROM w
""".replace("{f}", f"[NOT contains(t, ','), len({WORDS.format(N.replace('text', 't'))}) >= 120, NOT contains(t, '*')]").replace("{f2}", f"[NOT contains(n, ','), len({WORDS.format(N.replace('text', 'n'))}) >= 120, NOT contains(n, '*')]").replace("{f3}", f"[NOT contains(b, ','), len({WORDS.format(N.replace('text', 'b'))}) >= 120, NOT contains(b, '*')]"))
def instruction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three instructions, checked on each response as it is and, loosely, on its variants."""
    none = F.create_map().cast("map<string,string>")
    asked = F.array(F.struct(F.lit("no_comma").alias("name"), none.alias("args")), F.struct(F.lit("least_words").alias("name"), F.create_map(F.lit("n"), F.lit("120")).alias("args")), F.struct(F.lit("no_asterisk").alias("name"), none.alias("args")))
    out = evals.instruction_checks(docs(spark, sf_dir).withColumn("asked", asked), F.col("text"), "asked")
    return out.select("doc_id", "strict", "loose")


@R.add("""
    WITH r AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS reference FROM orders GROUP BY 1)
    SELECT c_custkey AS k, c_name AS candidate, reference, left(reference, greatest(1, length(reference) // 3)) AS truncated FROM customer JOIN r ON k = c_custkey
""")
def judge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates beside the last reference of their key, and the shortened reference that a judge must not prefer."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("candidate"))
    refs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("answer"), "o_orderkey")
    return evals.compared(c, refs, "k", "o_orderkey").withColumn("truncated", evals.truncated_answer(F.col("reference")))


FORMS = ('[["a b"]]', '["c"]', '[[["d, \\"e\\""]]]')


@R.add(f"SELECT doc_id, ['a b', 'c', 'd, \"e\"'][1 + doc_id % 3] AS response FROM documents")
def sample_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response of a sample, however deep its lists are nested, from the first field that has one."""
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("doc_id") % 3 + 1).cast("int"))
    first = F.when(F.col("doc_id") % 2 == 0, form).otherwise("[]")
    return docs(spark, sf_dir).select("doc_id", evals.first_response(first, form).alias("response"))


# ---------------------------------------------------------------- sweeps

#: Customers are trials, their orders attempts, and the customer with the least key is the baseline.
SWEEP_SQL = """
    WITH a AS (SELECT o_custkey AS trial, CASE WHEN max(o_orderstatus) = 'P' THEN 'failed' ELSE 'success' END AS state, count(*) AS attempts, arg_max(o_orderstatus, o_orderkey) AS env_digest, (sum(o_orderkey) % 100) / 100.0::DOUBLE AS m1, (count(*) * 7 % 100) / 100.0::DOUBLE AS m2 FROM orders GROUP BY 1),
    b AS (SELECT * FROM a WHERE state = 'success' ORDER BY trial LIMIT 1),
    j AS (SELECT c_custkey AS trial, a.* EXCLUDE (trial), (SELECT m1 FROM b) - 0.125 AS f1, (SELECT m2 FROM b) - 0.25 AS f2, (SELECT env_digest FROM b) AS env FROM customer LEFT JOIN a ON a.trial = c_custkey),
    g AS (SELECT trial, m1, CASE WHEN state = 'success' AND env_digest IS DISTINCT FROM env THEN 'env_drift' WHEN state = 'success' THEN 'success' WHEN coalesce(attempts, 0) < 9 THEN 'pending' ELSE 'exhausted' END AS state,
        list_filter([CASE WHEN m1 < f1 THEN 'm1' END, CASE WHEN m2 < f2 THEN 'm2' END], lambda x: x IS NOT NULL) AS why, list_filter([CASE WHEN m1 >= f1 AND m1 < f1 + 0.0625 THEN 'm1' END, CASE WHEN m2 >= f2 AND m2 < f2 + 0.0625 THEN 'm2' END], lambda x: x IS NOT NULL) AS near FROM j),
    k AS (SELECT trial, m1, state, CASE WHEN state = 'success' THEN array_to_string(why, ',') END AS gate_reason, CASE WHEN state = 'success' THEN array_to_string(near, ',') END AS gray_band, state = 'success' AND len(why) = 0 AS eligible FROM g)
"""


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("trial")).agg(
        F.when(F.max("o_orderstatus") == "P", "failed").otherwise("success").alias("state"), F.count("*").alias("attempts"), F.max_by("o_orderstatus", "o_orderkey").alias("env_digest"),
        (F.sum("o_orderkey") % 100 / F.lit(100.0)).alias("m1"), (F.count("*") * 7 % 100 / F.lit(100.0)).alias("m2"),
    )
    baseline = o.where("state = 'success'").orderBy("trial").limit(1)
    return sweeps.gated_against(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("trial")), o, baseline, {"m1": 0.125, "m2": 0.25}, 0.0625, 9)


@R.add(SWEEP_SQL + "SELECT trial, state, gate_reason, gray_band, eligible FROM k")
def sweep_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials against the floors of their baseline, with drifted environments and open attempts."""
    return gated(spark, sf_dir).select("trial", "state", F.array_join("gate_reason", ",").alias("gate_reason"), F.array_join("gray_band", ",").alias("gray_band"), "eligible")


@R.add(SWEEP_SQL + """
    , r AS (SELECT count(*) AS n_trials, CAST(count(*) FILTER (WHERE state = 'success') AS BIGINT) AS n_completed, CAST(count(*) FILTER (WHERE eligible) AS BIGINT) AS n_eligible, CAST(count(*) FILTER (WHERE state = 'pending') AS BIGINT) AS n_pending FROM k)
    SELECT *, CASE WHEN n_pending = 0 THEN 'complete' WHEN n_completed > 0 THEN 'partial' ELSE 'incomplete' END AS sweep FROM r
""")
def sweep_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweeps.sweep_state(gated(spark, sf_dir))


@R.add("""
    WITH c AS (SELECT o_custkey AS box, o_orderkey AS run, greatest(coalesce((o_orderkey % 8) * 0.5::DOUBLE * ((o_custkey % 4) * 0.25::DOUBLE), 0), 0) AS cost FROM orders),
    s AS (SELECT *, sum(cost) OVER (PARTITION BY box ORDER BY run ROWS UNBOUNDED PRECEDING) AS spent FROM c), g AS (SELECT *, least(2.0::DOUBLE, (box % 4) * 0.25::DOUBLE * 1.5) + (box % 4) * 0.25::DOUBLE * 0.25 AS coming FROM s)
    SELECT box, run, spent, CASE WHEN run % 101 = 0 THEN 'halt' WHEN spent >= 8 THEN 'hard_cap' WHEN spent + coming > 8 THEN 'sweep_cap' WHEN box % 5 = 0 THEN NULL WHEN run % 7 = 0 THEN 'balance_unknown' WHEN 9 - spent - coming < 2 THEN 'reserve' END AS reason,
        run % 24 + 1.5 > 20 AS unfinishable, coalesce(nullif(run % 10, 0) / 10.0::DOUBLE, 0) >= 0.375 AS anchor_ok FROM g
""")
def spend_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend so far of each run's box, and why the next may not start."""
    rate, run, box = (F.col("o_custkey") % 4) * 0.25, F.col("run"), F.col("box")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("box"), F.col("o_orderkey").alias("run"), rate.alias("rate"), (F.col("o_orderkey") % 8 * 0.5).alias("hours"))
    s = sweeps.spend(o, ["box"], ["run"], F.col("hours"), F.col("rate"))
    coming = sweeps.next_cost(F.col("rate"), F.lit(2.0), F.lit(1.5), 0.25)
    balance = F.when(run % 7 != 0, F.lit(9.0) - F.col("spent"))
    why = sweeps.halt_reason(run % 101 == 0, F.col("spent"), F.lit(8.0), coming, balance, F.lit(2.0), box % 5 != 0)
    return s.select("box", "run", "spent", why.alias("reason"), sweeps.starts_unfinishable(run % 24, F.lit(1.5), F.lit(20)).alias("unfinishable"), sweeps.anchor_ok(F.nullif(run % 10, F.lit(0)) / 10, F.lit(0.375)).alias("anchor_ok"))


FLEET_SQL = """
    WITH r AS (SELECT s_suppkey AS trial, s_nationkey AS host, round(s_acctbal / 16) / 64 AS m FROM supplier UNION ALL SELECT s_suppkey, s_nationkey + 1, 0.5 FROM supplier WHERE s_suppkey % 9 = 0),
    b AS (SELECT c_nationkey AS host, round(max(c_acctbal) / 16) / 64 AS base FROM customer WHERE c_nationkey < 20 GROUP BY 1), t AS (SELECT trial, count(*) AS n FROM r GROUP BY 1),
    j AS (SELECT r.trial, r.host, m - base AS delta, CASE WHEN n > 1 THEN 'duplicate' WHEN base IS NULL THEN 'no_baseline' END AS refused FROM r JOIN t USING (trial) LEFT JOIN b USING (host))
"""


@R.add(FLEET_SQL + "SELECT trial, host, delta, refused, CAST(CASE WHEN refused IS NULL THEN row_number() OVER (PARTITION BY refused ORDER BY delta DESC, trial, host) END AS INTEGER) AS place FROM j")
def merged_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of several hosts ranked by their gain over their own baseline; doubtful ones are refused."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("trial"), F.col("s_nationkey").alias("host"), (F.round(F.col("s_acctbal") / 16) / 64).alias("m"))
    r = s.unionByName(s.where("trial % 9 = 0").select("trial", (F.col("host") + 1).alias("host"), F.lit(0.5).alias("m")))
    b = table(spark, sf_dir, "customer").where("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("host")).agg((F.round(F.max("c_acctbal") / 16) / 64).alias("m"))
    return sweeps.merged_fleet(r, b, "m", 1e6)


@R.add("""
    WITH m AS (SELECT p_brand AS run, 'm' || (p_size % 7) AS metric, CAST(max(p_size) AS DOUBLE) AS value FROM part GROUP BY 1, 2), a AS (SELECT 'm' || (p_size % 7) AS metric, CAST(min(p_size) AS DOUBLE) AS value FROM part GROUP BY 1),
    w(metric, w) AS (VALUES ('m0', 0.5::DOUBLE), ('m1', 0.25), ('m2', 0.125), ('m3', 0.125))
    SELECT run, sum(w * (m.value - a.value)) AS score, count(*) AS n_metrics FROM m JOIN a USING (metric) JOIN w USING (metric) GROUP BY run
""")
def composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted gains over the anchor."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("run"), F.concat(F.lit("m"), (F.col("p_size") % 7).cast("string")).alias("metric"), F.col("p_size").cast("double").alias("value"))
    return sweeps.composite(p.groupBy("run", "metric").agg(F.max("value").alias("value")), p.groupBy("metric").agg(F.min("value").alias("value")), {"m0": 0.5, "m1": 0.25, "m2": 0.125, "m3": 0.125}, "run")
