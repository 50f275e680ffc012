"""Judging, accuracies, objectives, generation funnels and sweeps on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import markdown_row, multiset_digest
from ..operators import contamination, dedup
from ..operators import evals as ops
from ..plans.grid import expand
from .corpus import DIGEST_SQL
from .registry import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

VOTES = "(SELECT o_orderkey AS pair, o_orderpriority AS slice, unnest([0, 1, 2]) AS v, ['win', 'loss', 'tie'][1 + (o_orderkey * (1 + unnest([0, 1, 2])) + o_custkey * unnest([0, 1, 2])) % 3] AS vote FROM orders)"


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three votes for each order."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pair"), F.col("o_orderpriority").alias("slice"), "o_custkey", F.explode(F.array(*map(F.lit, range(3)))).alias("v"))
    pick = (F.col("pair") * (1 + F.col("v")) + F.col("o_custkey") * F.col("v")) % 3 + 1
    return rows.select("pair", "slice", "v", F.element_at(F.array(*map(F.lit, ("win", "loss", "tie"))), pick.cast("int")).alias("vote"))


MAJORITY = f"""
    WITH c AS (SELECT pair, slice, vote, count(*) AS n FROM {VOTES} GROUP BY ALL), m AS (SELECT pair, slice, arg_max(vote, n * 10 + CASE vote WHEN 'win' THEN 3 WHEN 'loss' THEN 2 ELSE 1 END) AS verdict, CAST(sum(n) AS BIGINT) AS n_votes FROM c GROUP BY pair, slice)
"""


@R.add(MAJORITY + "SELECT pair, slice, verdict, n_votes FROM m")
def majority_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.majority(votes(spark, sf_dir), ["pair", "slice"], "vote")


@R.add(MAJORITY + "SELECT slice, CAST(count(*) FILTER (WHERE verdict = 'win') AS BIGINT) AS win, CAST(count(*) FILTER (WHERE verdict = 'loss') AS BIGINT) AS loss, CAST(count(*) FILTER (WHERE verdict = 'tie') AS BIGINT) AS tie, count(*) AS n, (count(*) FILTER (WHERE verdict = 'win') + 0.5::DOUBLE * count(*) FILTER (WHERE verdict = 'tie')) / count(*) AS win_rate FROM m GROUP BY ROLLUP (slice)")
def win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.win_rates(majority_verdict(spark, sf_dir), "slice", "verdict")


#: Judge answers of known forms.
ANSWERS = ("<think>a</think>\n2", "<think>open 3", "the best is 1, not 3", "nothing", "candidate 9", "x 2 y 1 z")


@R.add("""
    WITH a AS (SELECT doc_id, ['<think>a</think>' || chr(10) || '2', '<think>open 3', 'the best is 1, not 3', 'nothing', 'candidate 9', 'x 2 y 1 z'][1 + doc_id % 6] AS t FROM documents),
    s AS (SELECT doc_id, contains(t, '</think>') OR NOT contains(t, '<think>') AS closed, string_split(t, '</think>')[-1] AS s FROM a),
    n AS (SELECT *, CAST(coalesce(nullif(regexp_extract(s, '(\\d+)\\s*$', 1), ''), regexp_extract_all(s, '(\\d+)', 1)[-1]) AS INTEGER) AS k FROM s)
    SELECT doc_id, CASE WHEN coalesce(closed AND k BETWEEN 1 AND 3, FALSE) THEN k - 1 ELSE 0 END AS pick, coalesce(closed AND k BETWEEN 1 AND 3, FALSE) AS judged FROM n
""")
def best_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.element_at(F.array(*map(F.lit, ANSWERS)), (F.col("doc_id") % 6 + 1).cast("int"))
    d = table(spark, sf_dir, "documents").select("doc_id", answer.alias("t"))
    pick, judged = ops.parsed_choice(F.col("t"), F.lit(3))
    return d.select("doc_id", pick.alias("pick"), judged.alias("judged"))


@R.add("""
    WITH v AS (SELECT doc_id, ['TIE', 'A is better', 'b', '<think>x</think> A', 'unclear'][1 + doc_id % 5] AS t FROM documents), s AS (SELECT doc_id, upper(trim(string_split(t, '</think>')[-1])) AS s FROM v),
    w AS (SELECT doc_id, CASE WHEN starts_with(s, 'TIE') THEN 'TIE' WHEN starts_with(s, 'A') THEN 'A' WHEN starts_with(s, 'B') THEN 'B' ELSE 'TIE' END AS said FROM s)
    SELECT doc_id, said, CASE WHEN said = 'TIE' THEN 'tie' WHEN (said = 'A') = (doc_id % 2 = 0) THEN 'win' ELSE 'loss' END AS outcome FROM w
""")
def pairwise_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = F.array(*map(F.lit, ("TIE", "A is better", "b", "<think>x</think> A", "unclear")))
    d = table(spark, sf_dir, "documents").select("doc_id", ops.verdict(F.element_at(answers, (F.col("doc_id") % 5 + 1).cast("int"))).alias("said"))
    return d.withColumn("outcome", ops.outcome(F.col("said"), F.col("doc_id") % 2 == 0))


@R.add("""
    WITH s AS (SELECT doc_id, [length(text) > 100, contains(text, 'a'), doc_id % 3 > 0] AS st, [length(text) > 50, contains(lower(text), 'a'), doc_id % 5 > 0] AS lo FROM documents)
    SELECT count(*) AS n, avg(CAST(list_bool_and(st) AS INT)) AS prompt_strict, avg(CAST(list_bool_and(lo) AS INT)) AS prompt_loose, sum(len(list_filter(st, lambda x: x)))::DOUBLE / sum(len(st)) AS inst_strict, sum(len(list_filter(lo, lambda x: x)))::DOUBLE / sum(len(lo)) AS inst_loose FROM s
""")
def strict_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, i = F.col("text"), F.col("doc_id")
    strict = F.array(F.char_length(t) > 100, F.contains(t, F.lit("a")), i % 3 > 0)
    loose = F.array(F.char_length(t) > 50, F.contains(F.lower(t), F.lit("a")), i % 5 > 0)
    return ops.accuracies(table(spark, sf_dir, "documents"), strict, loose)


@R.add("""
    WITH m AS (SELECT p_brand AS run, p_type AS metric, CAST(max(p_size) AS DOUBLE) AS value FROM part GROUP BY 1, 2), a AS (SELECT p_type AS metric, CAST(min(p_size) AS DOUBLE) AS value FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)
    SELECT run, avg(m.value - coalesce(a.value, 0)) AS score, count(m.value) AS n_metrics FROM m LEFT JOIN a USING (metric) GROUP BY run
""")
def objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    metrics = part.groupBy(F.col("p_brand").alias("run"), F.col("p_type").alias("metric")).agg(F.max("p_size").cast("double").alias("value"))
    anchor = part.where("p_partkey % 2 = 0").groupBy(F.col("p_type").alias("metric")).agg(F.min("p_size").cast("double").alias("value"))
    return ops.objective(metrics, anchor, "run", "metric", "value")


REASONS = "CASE WHEN l_quantity > 45 THEN 'truncated' WHEN l_returnflag = 'R' AND l_quantity < 3 THEN 'empty' WHEN l_returnflag = 'A' AND l_discount = 0 THEN 'error' ELSE 'kept' END"


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, f = F.col("l_quantity"), F.col("l_returnflag")
    why = F.when(q > 45, "truncated").when((f == "R") & (q < 3), "empty").when((f == "A") & (F.col("l_discount") == 0), "error").otherwise("kept")
    return table(spark, sf_dir, "lineitem").withColumn("reason", why)


@R.add(f"SELECT l_returnflag AS slice, {REASONS} AS reason, count(*) AS n FROM lineitem GROUP BY ALL")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasons(spark, sf_dir).groupBy(F.col("l_returnflag").alias("slice"), "reason").agg(F.count("*").alias("n"))


@R.add(f"WITH r AS (SELECT l_suppkey AS shard, {REASONS} AS reason FROM lineitem) SELECT shard, CAST(count(*) FILTER (WHERE reason = 'kept') AS BIGINT) AS kept, count(*) AS total FROM r GROUP BY shard HAVING count(*) FILTER (WHERE reason = 'kept') * 2 >= count(*)")
def kept_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reasons(spark, sf_dir).groupBy(F.col("l_suppkey").alias("shard")).agg(F.count_if(F.col("reason") == "kept").alias("kept"), F.count("*").alias("total"))
    return r.where(F.col("kept") * 2 >= F.col("total"))


@R.add(f"""
    WITH r AS (SELECT l_suppkey AS shard, l_orderkey AS id, sha256(CAST(l_orderkey AS VARCHAR)) AS h, {REASONS} AS reason FROM lineitem)
    SELECT shard, CAST(count(*) FILTER (WHERE reason = 'kept') AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE reason = 'error') AS BIGINT) AS n_errors, min(id) FILTER (WHERE reason = 'error') AS first_error,
        max(id) FILTER (WHERE reason = 'error') AS last_error, sha256({DIGEST_SQL.format(h='h')}) AS digest FROM r GROUP BY shard
""")
def shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and failed rows of each shard, the range of the failed ids, and a digest of all ids; no list of rows."""
    error = F.when(F.col("reason") == "error", F.col("l_orderkey"))
    return reasons(spark, sf_dir).groupBy(F.col("l_suppkey").alias("shard")).agg(
        F.count_if(F.col("reason") == "kept").alias("n_rows"), F.count(error).alias("n_errors"), F.min(error).alias("first_error"), F.max(error).alias("last_error"),
        multiset_digest(F.sha2(F.col("l_orderkey").cast("string"), 256)).alias("digest"),
    )


@R.add("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 4)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work that no sealed shard covers."""
    done = table(spark, sf_dir, "lineitem").where("l_linenumber >= 4").select(F.col("l_orderkey").alias("id")).distinct()
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(done, "id", "left_anti")


@R.add("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id").select("user_id", "event_id", "event_type")


@R.add("SELECT a AS alpha, l AS lr, r AS lora_rank FROM (SELECT unnest([0.0::DOUBLE, 0.5::DOUBLE]) AS a), (SELECT unnest([1e-5::DOUBLE, 5e-6::DOUBLE]) AS l), (SELECT unnest([8, 16, 32]) AS r)")
def grid_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand(spark, {"alpha": [0.0, 0.5], "lr": [1e-5, 5e-6], "lora_rank": [8, 16, 32]}).select("alpha", "lr", "lora_rank")


TRIALS = "(SELECT c_custkey AS trial, (c_custkey * 37 % 100) / 100.0::DOUBLE AS m1, (c_custkey * 53 % 100) / 100.0::DOUBLE AS m2 FROM customer)"


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("trial"), (k * 37 % 100 / F.lit(100.0)).alias("m1"), (k * 53 % 100 / F.lit(100.0)).alias("m2"))


@R.add(f"""
    WITH g AS (SELECT *, list_filter([CASE WHEN m1 < 0.5 THEN 'm1' END, CASE WHEN m2 < 0.25 THEN 'm2' END], lambda x: x IS NOT NULL) AS why, list_filter([CASE WHEN m1 >= 0.5 AND m1 < 0.625 THEN 'm1' END, CASE WHEN m2 >= 0.25 AND m2 < 0.375 THEN 'm2' END], lambda x: x IS NOT NULL) AS near FROM {TRIALS})
    SELECT trial, array_to_string(near, ',') AS gray_band, CAST(row_number() OVER (ORDER BY m1 DESC, trial) AS INTEGER) AS place FROM g WHERE len(why) = 0
""")
def gate_and_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = ops.gated(trials(spark, sf_dir), {"m1": F.lit(0.5), "m2": F.lit(0.25)}, 0.125)
    return ops.ranked_trials(g, "m1", "trial").select("trial", F.array_join("gray_band", ",").alias("gray_band"), "place")


@R.add(f"SELECT trial, m2 FROM {TRIALS} ORDER BY m2 DESC, trial LIMIT 7")
def promote_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finalists of a rung."""
    return trials(spark, sf_dir).orderBy(F.desc("m2"), "trial").limit(7).select("trial", "m2")


@R.add(f"SELECT '| ' || trial || ' | ' || CAST(CAST(m1 * 100 AS BIGINT) AS VARCHAR) || ' | a\\|b |' AS line FROM {TRIALS} ORDER BY m1 DESC, trial LIMIT 15")
def leaderboard_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = trials(spark, sf_dir).orderBy(F.desc("m1"), "trial").limit(15)
    return top.select(markdown_row(F.col("trial"), F.round(F.col("m1") * 100).cast("bigint"), F.lit("a|b")).alias("line"))


@R.add("""
    WITH s AS (SELECT event_id, ['success', 'running', 'failed', 'new'][1 + event_id % 4] AS state, event_id % 5 AS attempts, event_id % 7 = 0 AS valid, event_id % 3 = 0 AS alive, event_id % 11 <> 0 AS up FROM events)
    SELECT event_id, CASE WHEN state = 'success' THEN 'success' WHEN NOT up THEN 'indeterminate' WHEN valid THEN 'adopt' WHEN state = 'running' AND alive THEN 'resume' WHEN state = 'running' THEN 'pending' WHEN attempts >= 3 THEN 'exhausted' ELSE 'pending' END AS step FROM s
""")
def reconcile_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    state = F.element_at(F.array(*map(F.lit, ("success", "running", "failed", "new"))), (i % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", ops.reconcile(state, i % 5, 3, i % 7 == 0, i % 3 == 0, i % 11 != 0).alias("step"))


@R.add(f"SELECT trial, m1 BETWEEN 0 AND 1 AND trial % 4 <> 0 AND 2 * m2 BETWEEN 0 AND 1 AS valid FROM {TRIALS}")
def validate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics in range; every fourth trial lacks one."""
    m1 = F.when(F.col("trial") % 4 != 0, F.col("m1"))
    metrics = F.create_map(F.lit("a"), m1, F.lit("b"), F.col("m2") * 2)
    return trials(spark, sf_dir).select("trial", ops.valid_metrics(metrics, ["a", "b"]).alias("valid"))


@R.add("""
    WITH g AS (SELECT o_orderkey, ['CLEAN', 'CONTAMINATED', NULL][1 + o_orderkey % 3] AS v, CAST(o_orderkey % 2 AS VARCHAR) AS a, CAST(o_custkey % 2 AS VARCHAR) AS f FROM orders)
    SELECT o_orderkey, CASE WHEN v IS NULL THEN 'NOT_RUN' WHEN a IS DISTINCT FROM f THEN 'STALE' ELSE v END AS state FROM g
""")
def gate_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, "CLEAN").when(k % 3 == 1, "CONTAMINATED")
    return table(spark, sf_dir, "orders").select(k, contamination.gate_state(said, (k % 2).cast("string"), (F.col("o_custkey") % 2).cast("string")).alias("state"))


@R.add("""
    WITH r AS (SELECT o_orderkey AS task, o_orderpriority AS tier, l_linenumber AS run, l_returnflag = 'R' AS pass FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    t AS (SELECT task, tier, bool_and(NOT pass) FILTER (WHERE run = 1) AS base_fails, bool_and(pass) FILTER (WHERE run IN (2, 3)) AS gold FROM r GROUP BY task, tier)
    SELECT tier, count(*) AS completed, CAST(count(*) FILTER (WHERE coalesce(base_fails, FALSE) AND coalesce(gold, FALSE)) AS BIGINT) AS passed FROM t GROUP BY tier
""")
def smoke_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task passes if its base run fails and its gold runs pass."""
    runs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task"), "l_linenumber", (F.col("l_returnflag") == "R").alias("ok"))
    n = F.col("l_linenumber")
    t = runs.groupBy("task").agg(F.bool_and(F.when(n == 1, ~F.col("ok"))).alias("base"), F.bool_and(F.when(n.isin(2, 3), F.col("ok"))).alias("gold"))
    t = t.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), F.col("o_orderpriority").alias("tier")), "task")
    return t.groupBy("tier").agg(F.count("*").alias("completed"), F.count_if(F.coalesce("base", F.lit(False)) & F.coalesce("gold", F.lit(False))).alias("passed"))


@R.add("""
    WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 900 SECOND OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS s FROM events),
    i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, CAST(k AS BIGINT) AS lease, count(*) AS beats, min(event_id) AS first_event FROM i GROUP BY user_id, k
""")
def lease_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases: heartbeats no more than 900 seconds apart."""
    from ..streaming.ledgers import leases

    return leases(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")


@R.add()
def stream_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons counted by a file stream over events as they arrive."""
    from ..streaming.ledgers import streamed_counts

    return streamed_counts(spark, f"{sf_dir}/events.parquet", ["event_type"])


@R.add("""
    WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n, l_orderkey % 40 AS c, l_linenumber * 4 AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN n > 0 AND c > 0 AND n >= 0.95::DOUBLE * c THEN 'FULL' WHEN n > 0 AND c > 0 AND r > 0 AND abs(n - (c - r)) <= 0.05::DOUBLE * c THEN 'CONTENT-ONLY' WHEN n > 0 AND c > 0 THEN 'UNCLEAR' WHEN n = 0 THEN 'NO LOGPROBS' ELSE 'UNKNOWN' END AS coverage FROM p
""")
def logprob_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    what = ops.logprob_class(F.col("l_quantity").cast("bigint"), F.col("l_orderkey") % 40, F.col("l_linenumber") * 4)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", what.alias("coverage"))


@R.add("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'YES' WHEN event_id % 3 = 0 AND value > 0 AND 0.5::DOUBLE * value < 0.7::DOUBLE * value THEN 'COST-ONLY' ELSE 'NOT OBSERVED' END AS discount FROM events")
def cache_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, v = F.col("event_id"), F.col("value")
    return table(spark, sf_dir, "events").select("event_id", ops.cache_discount((i % 5 == 0).cast("int"), v, v * F.when(i % 3 == 0, 0.5).otherwise(0.9)).alias("discount"))


@R.add("SELECT l_suppkey AS box, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS tokens, sum(CAST(l_quantity AS BIGINT)) / (count(*) * 2.0::DOUBLE) AS per_second FROM lineitem GROUP BY l_suppkey")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("box")).agg(F.sum(q).alias("tokens"), (F.sum(q) / (F.count("*") * 2.0)).alias("per_second"))
