"""Corpus builds, gates, sequence packing and trajectories on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hash_order, words
from ..operators import builds as ops
from ..operators import mixture
from ..operators import sequences as seq
from ..operators.messages import GIT_HISTORY
from ..sources import tables
from .corpus import BENCH_W, DOC_W, GRAMS, HASH, N, NEAR_SQL, NN, WORDS, docs
from .messages import turns
from .registry import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

# ---------------------------------------------------------------- builds

SHORT = f"len({WORDS.format(N)}) < 15"
CASCADE_SQL = NEAR_SQL + f"""
    , k AS (SELECT doc_id, lang, source, md5({N}) AS h, {SHORT} AS short, md5({N}) IN (SELECT md5({N}) FROM benchmark) OR md5({NN}) IN (SELECT md5({NN}) FROM benchmark) AS bench,
        doc_id <> min(doc_id) OVER (PARTITION BY md5({N})) AS dup FROM documents),
    bg AS (SELECT item_id, len(g) AS n, unnest(g) AS x FROM (SELECT item_id, {GRAMS.format(k=3, short="[array_to_string(w, ' ')]")} AS g FROM ({BENCH_W}))),
    dg AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
    leak AS (SELECT DISTINCT doc_id FROM (SELECT item_id, doc_id FROM bg JOIN dg USING (x) GROUP BY item_id, doc_id, bg.n, dg.n HAVING count(*) * 5 >= 4 * (bg.n + dg.n - count(*)))),
    near AS (SELECT doc_id FROM h WHERE doc_id <> rep UNION SELECT doc_id FROM h WHERE rep IN (SELECT b FROM p)),
    w AS (SELECT doc_id, lang, source, CASE WHEN bench THEN 'benchmark' WHEN dup THEN 'dup' WHEN NOT short AND doc_id IN (SELECT doc_id FROM near) THEN 'dup'
        WHEN NOT short AND doc_id IN (SELECT doc_id FROM leak) THEN 'near_benchmark' ELSE 'kept' END AS why FROM k),
    f AS (SELECT *, coalesce(CAST(sum(CASE WHEN why = 'kept' THEN 1 ELSE 0 END) OVER (PARTITION BY lang, source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) >= 9 AS over FROM w),
    c AS (SELECT doc_id AS id, lang AS slice, source, CASE WHEN NOT over THEN why WHEN why = 'kept' THEN 'source_cap' ELSE 'source_cap/' || why END AS status FROM f)
"""


def cascaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cascade(docs(spark, sf_dir), table(spark, sf_dir, "benchmark"), "doc_id", "lang", "source", 9)


@R.add(CASCADE_SQL + "SELECT * FROM c")
def cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason to drop each document: cap, benchmark, exact copy, near copy, near benchmark."""
    return cascaded(spark, sf_dir)


@R.add(CASCADE_SQL + """
    , g AS (SELECT slice, count(*) AS collected, count(*) FILTER (WHERE status = 'kept') AS fit, count(*) FILTER (WHERE status = 'source_cap') AS spare, CAST(count(*) FILTER (WHERE status = 'dup') AS BIGINT) AS dropped_dup,
        CAST(count(*) FILTER (WHERE status IN ('benchmark', 'near_benchmark')) AS BIGINT) AS dropped_benchmark, CAST(count(*) FILTER (WHERE starts_with(status, 'source_cap')) AS BIGINT) AS dropped_source_cap FROM c GROUP BY slice)
    SELECT slice, collected, CAST(least(fit, 130) + least(greatest(130 - fit, 0), spare) AS BIGINT) AS kept, CAST(130 AS BIGINT) AS target, dropped_dup, dropped_benchmark, dropped_source_cap, CAST(least(greatest(130 - fit, 0), spare) AS BIGINT) AS backfilled FROM g
""")
def cascade_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.build_funnel(cascaded(spark, sf_dir), F.lit(130))


BASE = "source IN ('src0', 'src1', 'src2')"


@R.add(NEAR_SQL + f"""
    , k AS (SELECT doc_id, {BASE} AS base, md5({N}) AS h, {SHORT} AS short FROM documents),
    m AS (SELECT h.doc_id, rep, base FROM h JOIN k USING (doc_id)), held AS (SELECT DISTINCT rep FROM m WHERE base),
    near AS (SELECT doc_id FROM m WHERE rep IN (SELECT rep FROM held) OR rep IN (SELECT b FROM p WHERE a IN (SELECT rep FROM held)) OR rep IN (SELECT a FROM p WHERE b IN (SELECT rep FROM held))),
    x AS (SELECT doc_id FROM k WHERE NOT base AND h NOT IN (SELECT h FROM k WHERE base) AND (short OR doc_id NOT IN (SELECT doc_id FROM near)))
    SELECT doc_id AS id, row_number() OVER (ORDER BY {HASH.format(42, 'doc_id')}, doc_id) - 1 + 100000 AS sample_id FROM x
""")
def extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that extend a base set without repeating it, also nearly, with ids of their own range."""
    return ops.extension(docs(spark, sf_dir), F.col("source").isin("src0", "src1", "src2"), "doc_id", hash_order(F.col("doc_id")))


def own_sources(sf_dir: str) -> list[ops.Source]:
    """Three sources of one slice; the second one is not there."""
    read = lambda *names: lambda spark: docs(spark, sf_dir).where(F.col("source").isin(*names))
    return [
        ops.Source("first", "mixed", read("src3", "src4"), F.trim("text"), F.col("doc_id"), 0.25),
        ops.Source("absent", "mixed", lambda spark: table(spark, sf_dir, "no_such_table"), F.col("text"), F.col("doc_id"), 0.5),
        ops.Source("second", "mixed", read("src5", "src6", "src7"), F.col("text"), F.col("doc_id"), 0.75),
    ]


@R.add(f"""
    WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY o, doc_id) AS k FROM (SELECT doc_id, {HASH.format(42, 'doc_id')} AS o, row_number() OVER (PARTITION BY md5({N.replace('text', "trim(text)")}) ORDER BY {HASH.format(42, 'doc_id')}, doc_id) AS c
        FROM documents WHERE source IN ('src3', 'src4') AND length(trim(text)) BETWEEN 20 AND 12000) WHERE c = 1),
    fa AS (SELECT doc_id AS key, 'first' AS source FROM a WHERE k <= 25),
    b AS (SELECT doc_id, row_number() OVER (ORDER BY o, doc_id) AS k FROM (SELECT doc_id, {HASH.format(42, 'doc_id')} AS o, row_number() OVER (PARTITION BY md5({N}) ORDER BY {HASH.format(42, 'doc_id')}, doc_id) AS c
        FROM documents WHERE source IN ('src5', 'src6', 'src7') AND length(text) BETWEEN 20 AND 12000) WHERE c = 1),
    fb AS (SELECT doc_id AS key, 'second' AS source FROM b WHERE k <= least(75, 100 - (SELECT count(*) FROM fa)))
    SELECT key, 'mixed' AS slice, source FROM fa UNION ALL SELECT key, 'mixed', source FROM fb
""")
def collect_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of each source within its budget; a source that cannot be read is passed over."""
    pool, _ = ops.collect(spark, own_sources(sf_dir), {"mixed": 100}, lambda k: hash_order(k))
    return pool.select("key", "slice", "source")


@R.add("SELECT s AS source, e AS error, n > 0 AS collected FROM (VALUES ('first', '', 1), ('absent', 'AnalysisException', 0), ('second', '', 1)) AS t(s, e, n)")
def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source with its error, if it could not be read."""
    _, report = ops.collect(spark, own_sources(sf_dir), {"mixed": 100}, lambda k: hash_order(k))
    return spark.createDataFrame([(s, e, n > 0) for s, _, n, e in report], "source string, error string, collected boolean")


@R.add(f"""
    WITH t AS (SELECT doc_id AS id, source AS repo, md5({N}) AS h FROM documents), e AS (SELECT item_id * 20 AS id, 'src' || (item_id + 18) AS repo, md5({N}) AS h FROM benchmark),
    d AS (SELECT doc_id, {GRAMS.format(k=8, short="[]")} AS g FROM ({DOC_W})), b AS (SELECT item_id, {GRAMS.format(k=8, short="[]")} AS g FROM ({BENCH_W})),
    de AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM d), be AS (SELECT item_id, unnest(g) AS x FROM b),
    hit AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, item_id, n FROM de JOIN be USING (x) GROUP BY doc_id, item_id, n HAVING count(*) * 5 >= n * 3)),
    f AS (SELECT id, id IN (SELECT id FROM e) AS instance, repo IN (SELECT repo FROM e) AS repo, h IN (SELECT h FROM e) AS text_exact, id IN (SELECT doc_id FROM hit) AND h NOT IN (SELECT h FROM e) AS text_ngram FROM t)
    SELECT count(*) AS n_tasks, CAST(count(*) FILTER (WHERE instance) AS BIGINT) AS instance, CAST(count(*) FILTER (WHERE repo) AS BIGINT) AS repo, CAST(count(*) FILTER (WHERE text_exact) AS BIGINT) AS text_exact,
        CAST(count(*) FILTER (WHERE text_ngram) AS BIGINT) AS text_ngram, CASE WHEN count(*) FILTER (WHERE instance OR repo OR text_exact OR text_ngram) = 0 THEN 'CLEAN' ELSE 'CONTAMINATED' END AS verdict FROM f
""")
def task_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four checks of a task list against a held set: ids, repositories, equal texts, shared grams."""
    tasks = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("source").alias("repo"), "text")
    held = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 20).alias("id"), F.concat(F.lit("src"), (F.col("item_id") + 18).cast("string")).alias("repo"), "text")
    return ops.gate_report(ops.gate_tasks(tasks, held))


@R.add("SELECT slice, target, CAST(floor(target * 1.35::DOUBLE) AS BIGINT) AS collect FROM (SELECT lang AS slice, count(*) AS target FROM documents GROUP BY lang)")
def over_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a slice is collected so that the screens leave enough."""
    t = docs(spark, sf_dir).groupBy(F.col("lang").alias("slice")).agg(F.count("*").alias("target"))
    return t.withColumn("collect", F.floor(F.col("target") * ops.OVER_COLLECTION))


@R.add(f"SELECT doc_id, row_number() OVER (ORDER BY {HASH.format(7, 'doc_id')}, doc_id) - 1 AS place FROM documents ORDER BY place LIMIT 64")
def proxy_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a reproducible shuffle: the whole table is shuffled, not a buffer of it."""
    d = docs(spark, sf_dir).select("doc_id").withColumn("o", hash_order(F.col("doc_id"), seed=7))
    return mixture.dense_ids(d, [F.col("o"), F.col("doc_id")], "place").where("place < 64").select("doc_id", "place")


MIX_SQL = f"""
    WITH c AS (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE role = 'assistant') AS a, CAST(sum(len({WORDS.format(N)})) AS BIGINT) AS w FROM conversations GROUP BY conv_id),
    r AS (SELECT conv_id, CASE WHEN n < 2 THEN 'no_messages' WHEN w > 300 THEN 'too_long' WHEN a = 0 THEN 'no_trainable' ELSE 'usable' END AS reason FROM c)
"""


def general_mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = F.sum(F.size(words(F.col("text"))))
    c = turns(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "assistant").alias("a"), n.alias("w"))
    c = c.withColumn("o", hash_order(F.col("conv_id"), seed=3))
    return mixture.usable_mix(c, {"no_messages": F.col("n") < 2, "too_long": F.col("w") > 300, "no_trainable": F.col("a") == 0}, [F.col("o"), F.col("conv_id")], 4)


@R.add(MIX_SQL + "SELECT reason, count(*) AS n FROM r GROUP BY reason")
def mix_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why conversations cannot join a training mix."""
    return general_mix(spark, sf_dir)[1]


@R.add(MIX_SQL + f"SELECT conv_id FROM r WHERE reason = 'usable' ORDER BY {HASH.format(3, 'conv_id')}, conv_id LIMIT 4")
def mix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first usable conversations of a reproducible shuffle."""
    return general_mix(spark, sf_dir)[0].select("conv_id")


# ---------------------------------------------------------------- sequences

RESP = "[(vec_id * 7 + i * 13) % 97 FOR i IN range(0, 8 + vec_id % 5)]"
TOPK = "[[(vec_id * 7 + i * 13 + j * 5) % 97 FOR j IN range(0, 3)] FOR i IN range(0, 8 + vec_id % 5 + CASE WHEN vec_id % 11 = 0 THEN 1 ELSE 0 END)]"
LPS = "[[CAST(embedding[1 + (i * 3 + j) % 32] AS DOUBLE) FOR j IN range(0, 3)] FOR i IN range(0, 8 + vec_id % 5 + CASE WHEN vec_id % 11 = 0 THEN 1 ELSE 0 END)]"
EXACT_SQL = f"""
    WITH r AS (SELECT vec_id, 'slice' || (vec_id % 3) AS slice, {RESP} AS resp, {TOPK} AS ti, {LPS} AS tl FROM embeddings),
    n AS (SELECT *, len(resp) <> len(ti) AS uneven, CAST(len(list_filter(resp, lambda x: x % 7 = 0)) AS BIGINT) AS bad FROM r),
    m AS (SELECT *, NOT uneven AND bad > 0.2 * len(resp) AS mostly, [CASE WHEN x % 7 = 0 THEN 0 ELSE x + 1000 END FOR x IN resp] AS ids, [CASE WHEN x % 7 = 0 THEN -100 ELSE x + 1000 END FOR x IN resp] AS lab,
        [[CASE WHEN x % 7 = 0 THEN -1 ELSE x + 1000 END FOR x IN t] FOR t IN ti] AS mi, [[CASE WHEN ti[a][b] % 7 = 0 THEN -1e9::DOUBLE ELSE tl[a][b] END FOR b IN range(1, 4)] FOR a IN range(1, len(ti) + 1)] AS ml FROM n),
    e AS (SELECT *, ids[-1] = 1040 AS ends, 2 + len(ids) + CASE WHEN ids[-1] = 1040 THEN 0 ELSE 1 END > 14 AS over FROM m)
"""


def teacher_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token sequences with their top-K lists, made of vectors; every eleventh has a list too many."""
    v, n = F.col("vec_id"), (8 + F.col("vec_id") % 5).cast("int")
    more = n + F.when(v % 11 == 0, 1).otherwise(0)
    upto = lambda k: F.filter(F.sequence(F.lit(0), F.lit(13)), lambda i: i < k)
    inner = F.array(*map(F.lit, range(3)))
    return table(spark, sf_dir, "embeddings").select(
        v.alias("id"), F.concat(F.lit("slice"), (v % 3).cast("string")).alias("slice"), F.array(F.lit(1), F.lit(2)).alias("prefix"), F.transform(upto(n), lambda i: (v * 7 + i * 13) % 97).alias("resp"),
        F.transform(upto(more), lambda i: F.transform(inner, lambda j: (v * 7 + i * 13 + j * 5) % 97)).alias("topk_ids"),
        F.transform(upto(more), lambda i: F.transform(inner, lambda j: F.get("embedding", (i * 3 + j) % 32).cast("double"))).alias("topk_logprobs"),
    )


def exact_pack(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    remap = spark.range(97).where("id % 7 <> 0").select(F.col("id").alias("teacher_id"), (F.col("id") + 1000).alias("student_id"))
    return seq.pack_exact(teacher_rows(spark, sf_dir), remap, eos=1040, unk=0, max_len=14, k=3)


@R.add(EXACT_SQL + """
    SELECT vec_id AS id, list_concat([1, 2], CASE WHEN ends THEN ids ELSE list_append(ids, 1040) END) AS input_ids, list_concat([-100, -100], CASE WHEN ends THEN lab ELSE list_append(lab, 1040) END) AS labels,
        flatten(list_concat([[-1, -1, -1], [-1, -1, -1]], CASE WHEN ends THEN mi ELSE list_append(mi, [-1, -1, -1]) END)) AS topk_ids,
        CAST(len(list_filter(flatten(list_concat([[-1e9::DOUBLE, -1e9, -1e9], [-1e9, -1e9, -1e9]], CASE WHEN ends THEN ml ELSE list_append(ml, [-1e9, -1e9, -1e9]) END)), lambda x: x < -1e8)) AS BIGINT) AS n_masked
    FROM e WHERE NOT uneven AND NOT mostly AND NOT over
""")
def pack_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teacher tokens and top-K lists in the student's vocabulary, unmappable positions masked."""
    packed, _ = exact_pack(spark, sf_dir)
    masked = F.size(F.filter(F.flatten("topk_logprobs"), lambda x: x < -1e8)).cast("bigint")
    longs = lambda c: F.transform(c, lambda x: x.cast("bigint"))
    return packed.select("id", longs("input_ids").alias("input_ids"), longs("labels").alias("labels"), longs(F.flatten("topk_ids")).alias("topk_ids"), masked.alias("n_masked"))


@R.add(EXACT_SQL + """
    SELECT slice, count(*) AS samples, CAST(count(*) FILTER (WHERE uneven OR (NOT mostly AND over)) AS BIGINT) AS skipped, CAST(count(*) FILTER (WHERE mostly) AS BIGINT) AS dropped_mostly_unmappable,
        CAST(coalesce(sum(bad) FILTER (WHERE NOT uneven AND NOT mostly), 0) AS BIGINT) AS unmappable_positions, CAST(coalesce(sum(len(resp)) FILTER (WHERE NOT uneven), 0) AS BIGINT) AS response_tokens FROM e GROUP BY slice
""")
def pack_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happened to the sequences of each slice, so that the worst one shows."""
    return exact_pack(spark, sf_dir)[1]


TALK_SQL = """
    WITH c AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS answer, CASE WHEN conv_id % 2 = 0 THEN arg_min(text, turn) FILTER (WHERE role = 'assistant') ELSE '' END AS reasoning FROM conversations GROUP BY conv_id),
    d AS (SELECT conv_id, trim(coalesce(prompt, '')) AS prompt, trim(coalesce(answer, '')) AS answer, trim(coalesce(reasoning, '')) AS reasoning FROM c),
    t AS (SELECT *, CASE WHEN reasoning <> '' THEN '<think>' || chr(10) || reasoning || chr(10) || '</think>' || chr(10) || chr(10) || answer ELSE answer END AS said FROM d)
"""


def talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt, the last answer and, for every second conversation, the first answer as reasoning."""
    of = lambda role: F.when(F.col("role") == role, F.col("turn"))
    c = turns(spark, sf_dir).groupBy("conv_id").agg(F.min_by("text", of("user")).alias("prompt"), F.max_by("text", of("assistant")).alias("answer"), F.min_by("text", of("assistant")).alias("first"))
    return c.select("conv_id", F.trim(F.coalesce("prompt", F.lit(""))).alias("prompt"), "answer", F.when(F.col("conv_id") % 2 == 0, F.col("first")).otherwise("").alias("reasoning"))


def template(prompt: Column, said: Column) -> tuple[Column, Column]:
    head = F.concat(F.lit("<user> "), prompt, F.lit(" <assistant>"))
    return head, F.concat(head, F.lit(" "), said, F.lit(" <end>"))


TALK_WORDS = WORDS.format(N.replace("text", "{0}"))


@R.add(TALK_SQL + f"""
    , w AS (SELECT conv_id, reasoning, {TALK_WORDS.format("('<user> ' || prompt || ' <assistant>')")} AS p, {TALK_WORDS.format("('<user> ' || prompt || ' <assistant>' || ' ' || said || ' <end>')")} AS f FROM t)
    SELECT conv_id, CAST(len(p) AS BIGINT) AS n_prefix, CAST(len(f) AS BIGINT) AS n_full, f[1:len(p)] = p AS prefix_ok, reasoning = '' OR list_contains(f[len(p) + 1:], '</think>') AS tags_ok, len(f) > len(p) AND len(f) <= 400 AS fits FROM w
""")
def pack_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasoning inside think tags, the prefix's tokens before the whole conversation's, and whether all of it survives; words stand for tokens."""
    packed = seq.pack_text(talks(spark, sf_dir), words, template, 400)
    return packed.select("conv_id", F.size("prefix").cast("bigint").alias("n_prefix"), F.size("full").cast("bigint").alias("n_full"), "prefix_ok", "tags_ok", "fits")


@R.add(f"""
    WITH r AS (SELECT vec_id, vec_id // 8 AS batch, {RESP} AS ids FROM embeddings), m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) - len(ids) AS room FROM r)
    SELECT vec_id, batch, list_concat(ids, [5 FOR i IN range(0, room)]) AS input_ids, list_concat(ids, [-100 FOR i IN range(0, room)]) AS labels, list_concat([1 FOR i IN range(0, len(ids))], [0 FOR i IN range(0, room)]) AS attention_mask FROM m
""")
def collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences padded to the longest of their batch."""
    r = teacher_rows(spark, sf_dir)
    ints = F.transform("resp", lambda x: x.cast("int"))
    padded = seq.collated(r.select(F.col("id").alias("vec_id"), F.floor(F.col("id") / 8).alias("batch"), ints.alias("input_ids"), ints.alias("labels")), "batch", 5)
    longs = lambda c: F.transform(c, lambda x: x.cast("bigint")).alias(c)
    return padded.select("vec_id", "batch", longs("input_ids"), longs("labels"), longs("attention_mask"))


@R.add("""
    WITH e AS (SELECT vec_id, unnest(range(0, 6)) AS i, embedding AS v FROM embeddings),
    p AS (SELECT vec_id, CASE WHEN (vec_id + i) % 4 = 0 THEN -100 ELSE i END AS lab, CAST(v[1 + i] AS DOUBLE) - 5 AS lp, [CAST(v[7 + i * 3 + j] AS DOUBLE) FOR j IN range(0, 3)] AS s0, [CAST(v[25 + (i * 3 + j) % 40] AS DOUBLE) FOR j IN range(0, 3)] AS t0,
        [CASE WHEN (vec_id + i) % 5 = 0 OR j = i % 4 THEN -1 ELSE j END FOR j IN range(0, 3)] AS ids FROM e),
    q AS (SELECT *, [CASE WHEN ids[k] = -1 THEN -1e9::DOUBLE ELSE s0[k] END / 2 FOR k IN range(1, 4)] AS s, [CASE WHEN ids[k] = -1 THEN -1e9::DOUBLE ELSE t0[k] END / 2 FOR k IN range(1, 4)] AS t FROM p),
    z AS (SELECT *, list_max(t) + ln(list_sum(list_transform(t, lambda x: exp(x - list_max(t))))) AS zt, list_max(s) + ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s))))) AS zs FROM q),
    l AS (SELECT vec_id, lab, lp, ids, 4 * list_sum([exp(t[k] - zt) * ((t[k] - zt) - (s[k] - zs)) FOR k IN range(1, 4)]) AS kl FROM z)
    SELECT vec_id, CAST(count(*) FILTER (WHERE lab <> -100) AS BIGINT) AS n_tokens, CAST(round(1e5 * coalesce(sum(-lp) FILTER (WHERE lab <> -100), 0)) AS BIGINT) AS ce, CAST(count(*) FILTER (WHERE lab <> -100 AND list_max(ids) > -1) AS BIGINT) AS n_teacher,
        CAST(round(1e5 * coalesce(sum(kl) FILTER (WHERE lab <> -100 AND list_max(ids) > -1), 0)) AS BIGINT) AS kl FROM l GROUP BY vec_id
""")
def loss_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked cross entropy and divergence per sequence, in units of 1e-5 so that the order of summing does not show."""
    v, e = F.col("vec_id"), F.col("embedding")
    six, three = F.array(*map(F.lit, range(6))), F.array(*map(F.lit, range(3)))
    at = lambda k: F.get(e, k).cast("double")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(six, lambda i: F.when((v + i) % 4 == 0, -100).otherwise(i)).alias("labels"), F.transform(six, lambda i: at(i) - 5).alias("logprobs"),
        F.transform(six, lambda i: F.transform(three, lambda j: at(6 + i * 3 + j))).alias("student"), F.transform(six, lambda i: F.transform(three, lambda j: at(24 + (i * 3 + j) % 40))).alias("teacher"),
        F.transform(six, lambda i: F.transform(three, lambda j: F.when(((v + i) % 5 == 0) | (j == i % 4), -1).otherwise(j))).alias("teacher_ids"),
    )
    parts = seq.token_losses(rows, "vec_id")
    return parts.select("vec_id", "n_tokens", F.round(F.col("ce_sum") * 1e5).cast("bigint").alias("ce"), "n_teacher", F.round(F.col("kl_sum") * 1e5).cast("bigint").alias("kl"))


SEAL_SQL = """
    WITH e AS (SELECT o_orderkey AS sample_id, o_custkey % 50 AS shard FROM orders), g AS (SELECT l_orderkey AS sample_id, CASE WHEN max(l_quantity) > 49.5 THEN 'truncated' WHEN min(l_discount) > 0.05 THEN 'empty' END AS dropped FROM lineitem GROUP BY 1),
    m AS (SELECT shard, e.sample_id, g.sample_id IS NOT NULL AS got, dropped FROM e LEFT JOIN g USING (sample_id))
"""


def shard_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), (F.col("o_custkey") % 50).alias("shard"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample_id")).agg(F.max("l_quantity").alias("q"), F.min("l_discount").alias("d"))
    return expected, lines.select("sample_id", F.when(F.col("q") > 49.5, "truncated").when(F.col("d") > 0.05, "empty").alias("dropped"))


@R.add(SEAL_SQL + """
    , t AS (SELECT shard, count(*) AS total, CAST(count(*) FILTER (WHERE got AND dropped IS NULL) AS BIGINT) AS n_rows FROM m GROUP BY shard)
    SELECT shard, total, n_rows, total - n_rows AS n_dropped, n_rows >= 0.8::DOUBLE * greatest(total, 1) AS sealed FROM t
""")
def shard_seals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards with enough kept rows to be sealed; prompts without result count as dropped."""
    return tables.shard_seals(*shard_results(spark, sf_dir), floor=0.8)


@R.add(SEAL_SQL + "SELECT shard, CASE WHEN NOT got THEN 'missing' ELSE dropped END AS reason, count(*) AS n FROM m WHERE NOT got OR dropped IS NOT NULL GROUP BY 1, 2")
def shard_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.drop_reasons(*shard_results(spark, sf_dir))


# ---------------------------------------------------------------- trajectories

#: Events as a ledger of rollouts: a user's event is a rollout of a task; conversations are the trajectories.
LEDGER_SQL = """
    WITH l AS (SELECT event_id AS instance_id, 1 AS rollout, event_type IN ('purchase', 'click', 'view') AS verified, event_type AS tier, user_id % 7 AS repo FROM events),
    m AS (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE role = 'assistant') AS a, string_agg(text || CASE WHEN turn % 3 = 1 THEN 'thought' ELSE '' END || CASE WHEN turn % 4 = 3 THEN '["git log"]' ELSE '' END, chr(10) ORDER BY turn) AS t,
        bool_or(turn % 4 = 3 OR regexp_matches(text, 'git\\s+(log|show|tag|describe|reflog|cherry|branch\\s+-[ar])')) AS h FROM conversations GROUP BY conv_id),
    j AS (SELECT l.*, m.n, m.a, m.t, m.h, m.conv_id IS NULL OR a = 0 AS clean_error FROM l LEFT JOIN m ON instance_id = conv_id WHERE verified)
"""


def trajectory_pack(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    said = F.struct(
        "turn", "role", F.col("text").alias("content"), F.when(F.col("turn") % 3 == 1, "thought").alias("reasoning"), F.when(F.col("turn") % 4 == 3, '["git log"]').alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id")
    )
    trajectories = turns(spark, sf_dir).groupBy(F.col("conv_id").alias("instance_id")).agg(F.sort_array(F.collect_list(said)).alias("messages")).withColumn("rollout", F.lit(1))
    ledger = table(spark, sf_dir, "events").select(F.col("event_id").alias("instance_id"), F.lit(1).alias("rollout"), F.col("event_type").isin("purchase", "click", "view").alias("verified"), F.col("event_type").alias("tier"), (F.col("user_id") % 7).alias("repo"))
    return ledger, seq.pack_trajectories(ledger, trajectories, 1000, GIT_HISTORY)


@R.add(LEDGER_SQL + "SELECT instance_id, tier, repo, clean_error, n AS n_messages, a AS n_assistant_turns, CAST(floor(length(t) / 3.5) AS BIGINT) AS est_tokens, floor(length(t) / 3.5) > 1000 AS over_token_cap, h AS history_assisted FROM j")
def pack_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified rollouts with their messages' sizes and provenance; those without messages are errors."""
    _, packed = trajectory_pack(spark, sf_dir)
    return packed.select("instance_id", "tier", "repo", "clean_error", F.col("n_messages").cast("bigint").alias("n_messages"), F.col("n_assistant_turns").cast("bigint").alias("n_assistant_turns"), "est_tokens", "over_token_cap", "history_assisted")


@R.add(LEDGER_SQL + """
    , a AS (SELECT count(DISTINCT instance_id) AS tasks, count(*) AS rollouts, CAST(count(*) FILTER (WHERE verified) AS BIGINT) AS verified FROM l)
    SELECT (SELECT tasks FROM a) AS tasks, (SELECT rollouts FROM a) AS rollouts, (SELECT verified FROM a) AS verified, CAST(count(*) FILTER (WHERE NOT clean_error) AS BIGINT) AS packed,
        CAST(count(*) FILTER (WHERE NOT clean_error AND floor(length(t) / 3.5) > 1000) AS BIGINT) AS over_cap, CAST(count(*) FILTER (WHERE clean_error) AS BIGINT) AS clean_errors FROM j
""")
def trajectory_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.trajectory_funnel(*trajectory_pack(spark, sf_dir))


@R.add("""
    WITH m AS (SELECT conv_id, turn, CASE WHEN turn % 7 = 6 THEN 'exit' ELSE role END AS role, text FROM conversations)
    SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(count(*) FILTER (WHERE role = 'assistant' AND turn % 3 = 1) AS BIGINT) AS n_reasoning, CAST(count(*) FILTER (WHERE role = 'assistant' AND turn % 4 = 3) AS BIGINT) AS n_calls FROM m WHERE role <> 'exit' GROUP BY conv_id
""")
def teacher_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the teacher's template reads them: known roles, renamed reasoning, parsed calls."""
    role = F.when(F.col("turn") % 7 == 6, "exit").otherwise(F.col("role"))
    m = F.struct("turn", role.alias("role"), F.col("text").alias("content"), F.when(F.col("turn") % 3 == 1, "thought").alias("reasoning"), F.when(F.col("turn") % 4 == 3, '{"a": [1, 2]}').alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"))
    c = turns(spark, sf_dir).groupBy("conv_id").agg(F.sort_array(F.collect_list(m)).alias("m")).withColumn("m", seq.teacher_messages(F.col("m")))
    count = lambda k: F.size(F.filter("m", lambda x: x[k].isNotNull())).cast("bigint")
    return c.where(F.size("m") > 0).select("conv_id", F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"), F.aggregate("m", F.lit(0).cast("bigint"), lambda s, x: s + F.char_length(x["content"])).alias("n_chars"), count("reasoning_content").alias("n_reasoning"), count("tool_calls").alias("n_calls"))
