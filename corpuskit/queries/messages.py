"""Conversations, packing, preference pairs, vocabularies and top-K arrays on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tensors
from ..functions.text import words
from ..operators import messages as ops
from ..operators.mixture import dense_ids
from .corpus import HASH, N, WORDS
from .registry import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


#: Every third turn plays a tool, every seventh bookkeeping.
TOOLED = "(SELECT conv_id, turn, CASE WHEN turn % 7 = 6 THEN 'exit' WHEN turn % 3 = 2 THEN 'tool' ELSE role END AS role, text FROM conversations)"


def tooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("turn") % 7 == 6, "exit").when(F.col("turn") % 3 == 2, "tool").otherwise(F.col("role"))
    return turns(spark, sf_dir).withColumn("role", role)


@R.add("SELECT conv_id, min(turn) AS turn, arg_min(text, turn) AS text FROM conversations WHERE role IN ('human', 'user') GROUP BY conv_id")
def first_user_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).where(F.col("role").isin("human", "user")).groupBy("conv_id").agg(F.min("turn").alias("turn"), F.min_by("text", "turn").alias("text"))


@R.add("""
    WITH u AS (SELECT conv_id, arg_min(text, turn) AS t FROM conversations WHERE role = 'user' GROUP BY conv_id), l AS (SELECT conv_id, arg_max(text, turn) AS t, arg_min(text, turn) AS f FROM conversations GROUP BY conv_id)
    SELECT l.conv_id, coalesce(u.t, l.t) AS prompt, l.f AS first_text FROM l LEFT JOIN u USING (conv_id)
""")
def prompt_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's first turn, else the last turn; and the first turn whatever its role."""
    m = turns(spark, sf_dir).groupBy("conv_id").agg(
        F.min_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("u"), F.max_by("text", "turn").alias("l"), F.min_by("text", "turn").alias("first_text"), F.count_if(F.col("role") == "user").alias("n")
    )
    return m.select("conv_id", F.when(F.col("n") > 0, F.col("u")).otherwise(F.col("l")).alias("prompt"), "first_text")


@R.add(f"""
    WITH k AS (SELECT * FROM {TOOLED} WHERE role <> 'exit'), l AS (SELECT conv_id, max(turn) AS m FROM k WHERE role = 'assistant' GROUP BY conv_id)
    SELECT conv_id, turn, role, role NOT IN ('system', 'user', 'assistant', 'tool') AS bad_role FROM k JOIN l USING (conv_id) WHERE turn <= m
""")
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean(tooled(spark, sf_dir)).select("conv_id", "turn", "role", "bad_role")


@R.add(f"""
    WITH t AS (SELECT *, CASE WHEN role = 'assistant' THEN turn % 2 END AS opened FROM {TOOLED}),
    o AS (SELECT *, last_value(opened IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS c FROM t)
    SELECT conv_id, turn, role, CASE WHEN role = 'tool' THEN coalesce(c = (turn + 1) % 2, FALSE) END AS linked FROM o
""")
def tool_link_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = lambda n: F.concat(F.lit("call-"), (n % 2).cast("string"))
    return ops.linked(tooled(spark, sf_dir), "conv_id", "turn", "role", F.array(call(F.col("turn"))), call(F.col("turn") + 1)).select("conv_id", "turn", "role", "linked")


@R.add("""
    WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 4 IN (1, 2) THEN 'tool' ELSE role END AS role, text FROM conversations),
    s AS (SELECT *, CASE WHEN role <> 'tool' OR coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') <> 'tool' THEN 1 ELSE 0 END AS st FROM t),
    i AS (SELECT *, CAST(sum(st) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM s)
    SELECT conv_id, island, CASE WHEN min(role) = 'tool' THEN 'user' ELSE min(role) END AS role, min(turn) AS first_turn, count(*) AS n_merged,
        string_agg(CASE WHEN role = 'tool' THEN '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>' ELSE text END, chr(10) ORDER BY turn) AS text
    FROM i GROUP BY conv_id, island
""")
def merge_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when((F.col("turn") % 4).isin(1, 2), "tool").otherwise(F.col("role"))
    return ops.merge_tool_turns(turns(spark, sf_dir).withColumn("role", role))


@R.add("""
    WITH b AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN ['<|im_start|>assistant' || chr(10), '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || text || '<|im_end|>', chr(10)]
        ELSE ['<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)] END AS s FROM conversations),
    u AS (SELECT conv_id, turn, role, unnest(s) AS segment, unnest(range(len(s))) AS pos FROM b)
    SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, segment, role = 'assistant' AND pos = 1 AS trainable FROM u
""")
def render_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.render(turns(spark, sf_dir))


MASK_SQL = f"""
    WITH w AS (SELECT conv_id, turn, role, len({WORDS.format(N)}) AS n FROM conversations),
    c AS (SELECT conv_id, CAST(sum(n) AS BIGINT) AS n_tokens, CAST(coalesce(sum(n) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS n_trainable FROM w GROUP BY conv_id)
"""


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and trainable tokens of each conversation, words standing for tokens."""
    n = F.size(words(F.col("text"))).cast("bigint")
    return turns(spark, sf_dir).groupBy("conv_id").agg(F.sum(n).alias("n_tokens"), F.coalesce(F.sum(F.when(F.col("role") == "assistant", n)), F.lit(0)).alias("n_trainable"))


@R.add(MASK_SQL + "SELECT * FROM c")
def loss_mask_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir)


@R.add(MASK_SQL + "SELECT sum(n_trainable)::DOUBLE / sum(n_tokens) AS fraction, CAST(min(n_tokens) AS BIGINT) AS least, CAST(floor(avg(n_tokens)) AS BIGINT) AS mean, CAST(max(n_tokens) AS BIGINT) AS most FROM c")
def trainable_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir).agg((F.sum("n_trainable") / F.sum("n_tokens")).alias("fraction"), F.min("n_tokens").alias("least"), F.avg("n_tokens").cast("bigint").alias("mean"), F.max("n_tokens").alias("most"))


@R.add(MASK_SQL + "SELECT n_tokens <= 200 AS fits, count(*) AS n FROM c GROUP BY ALL")
def over_cap_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir).groupBy((F.col("n_tokens") <= 200).alias("fits")).agg(F.count("*").alias("n"))


@R.add(f"""
    WITH w AS (SELECT conv_id, turn, role, len({WORDS.format(N)}) AS n FROM conversations),
    r AS (SELECT conv_id, turn, role, n, CAST(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM w)
    SELECT conv_id, turn, e - n AS b, e, role = 'assistant' AS trainable FROM r
""")
def prefix_mask_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = ops.running_ranges(turns(spark, sf_dir), F.size(words(F.col("text"))).cast("bigint"))
    return ranges.select("conv_id", "turn", F.col("begin").alias("b"), F.col("end").alias("e"), (F.col("role") == "assistant").alias("trainable"))


@R.add("SELECT conv_id, CAST(floor(sum(length(text)) / 3.5) AS BIGINT) AS est_tokens, sum(length(text)) / 3.5 > 1000 AS over_cap, count(*) AS n_messages FROM conversations GROUP BY conv_id")
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = F.sum(F.char_length("text"))
    return turns(spark, sf_dir).groupBy("conv_id").agg(F.floor(chars / 3.5).alias("est_tokens"), (chars / 3.5 > 1000).alias("over_cap"), F.count("*").alias("n_messages"))


@R.add(r"""
    WITH t AS (SELECT conv_id, CASE WHEN turn % 5 = 3 THEN 'git log --oneline' WHEN turn % 5 = 4 THEN 'ls git' ELSE 'cat x' END AS cmd FROM conversations)
    SELECT conv_id, bool_or(regexp_matches(cmd, 'git\s+(log|show|tag|describe|reflog|cherry|branch\s+-[ar])')) AS history_assisted FROM t GROUP BY conv_id
""")
def history_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cmd = F.when(F.col("turn") % 5 == 3, "git log --oneline").when(F.col("turn") % 5 == 4, "ls git").otherwise("cat x")
    return turns(spark, sf_dir).groupBy("conv_id").agg(F.bool_or(cmd.rlike(ops.GIT_HISTORY)).alias("history_assisted"))


#: Events as rollouts: a user is a task, purchases are verified.
ROLLS = "(SELECT user_id AS task, event_id AS rollout, event_type = 'purchase' AS good, event_type, value FROM events)"


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("task"), F.col("event_id").alias("rollout"), (F.col("event_type") == "purchase").alias("good"), "event_type", "value")


@R.add(f"""
    WITH r AS (SELECT * FROM {ROLLS}), p AS (SELECT a.task, a.rollout AS chosen, b.rollout AS rejected, row_number() OVER (PARTITION BY a.task ORDER BY a.rollout, b.rollout) AS place
        FROM r a JOIN r b ON a.task = b.task AND a.good AND NOT b.good)
    SELECT task, chosen, rejected, CAST(place AS INTEGER) AS place FROM p WHERE place <= 4
""")
def pref_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preference_pairs(rollouts(spark, sf_dir), "task", "rollout", "good")


@R.add(f"SELECT rollout, task, 1.0::DOUBLE / count(*) OVER (PARTITION BY task) AS weight FROM {ROLLS} WHERE good")
def rollout_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollouts(spark, sf_dir).where("good").select("rollout", "task", (F.lit(1.0) / F.count("*").over(Window.partitionBy("task"))).alias("weight"))


@R.add(f"SELECT count(DISTINCT task) AS tasks, count(*) AS rollouts, CAST(count(*) FILTER (WHERE good) AS BIGINT) AS verified, CAST(count(*) FILTER (WHERE good AND value > 50) AS BIGINT) AS over_cap, count(DISTINCT task) FILTER (WHERE good) AS tasks_verified FROM {ROLLS}")
def pack_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollouts(spark, sf_dir).agg(F.countDistinct("task").alias("tasks"), F.count("*").alias("rollouts"), F.count_if("good").alias("verified"), F.count_if(F.col("good") & (F.col("value") > 50)).alias("over_cap"), F.countDistinct(F.when(F.col("good"), F.col("task"))).alias("tasks_verified"))


@R.add("""
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
    s AS (SELECT vec_id, v, CAST(vec_id % 26 AS INTEGER) AS k FROM e)
    SELECT vec_id, list_concat(v[1:least(k, 20)], list_transform(range(20 - least(k, 20)), lambda x: CAST(-1e9 AS DOUBLE))) AS lp FROM s
""")
def topk_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first entries of each vector, as many as its id says, padded to 20."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", tensors.pad_right(F.slice(v, F.lit(1), (F.col("vec_id") % 26).cast("int")), tensors.TOP_K, F.lit(tensors.PAD_LOGPROB)).alias("lp"))


@R.add("SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n_positive, list_max(embedding)::DOUBLE AS top, list_sort(embedding, 'DESC')[20]::DOUBLE AS twentieth FROM embeddings")
def topk_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = F.sort_array("embedding", asc=False)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("bigint").alias("n_positive"), top[0].cast("double").alias("top"), top[19].cast("double").alias("twentieth"))


@R.add("SELECT vec_id, CAST(floor(1e6 * least(1.0, list_sum(list_transform(embedding[1:20], lambda x: exp(CAST(x AS DOUBLE) - 4))))) AS BIGINT) AS coverage_ppm FROM embeddings")
def topk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mass of the top 20 in parts per million, so that the order of summing does not show."""
    lp = F.transform(F.slice("embedding", 1, 20), lambda x: x.cast("double") - 4)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.floor(tensors.coverage(lp) * 1e6).alias("coverage_ppm"))


@R.add("""
    WITH v AS (SELECT vec_id, list_transform(embedding[1:20], lambda x: CAST(x AS DOUBLE) / 2) AS t, list_transform(embedding[21:40], lambda x: CAST(x AS DOUBLE) / 2) AS s FROM embeddings),
    z AS (SELECT vec_id, t, s, list_max(t) + ln(list_sum(list_transform(t, lambda x: exp(x - list_max(t))))) AS zt, list_max(s) + ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s))))) AS zs FROM v)
    SELECT vec_id, CAST(round(1e6 * 4 * list_sum([exp(t[i] - zt) * ((t[i] - zt) - (s[i] - zs)) FOR i IN range(1, 21)])) AS BIGINT) AS kl_ppm FROM z
""")
def kl_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KL divergence of two halves of a vector in millionths."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(tensors.topk_kl(F.slice("embedding", 21, 20), F.slice("embedding", 1, 20)) * 1e6).cast("bigint").alias("kl_ppm"))


#: Vocabularies: the distinct words of a language, numbered by name.
VOCAB = f"(SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (SELECT DISTINCT unnest({WORDS.format(N)}) AS token FROM documents WHERE lang = '{{lang}}'))"


def vocabulary(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """Distinct words of all texts of a language, numbered by name."""
    found = table(spark, sf_dir, "documents").where(F.col("lang") == lang).select(F.explode(words(F.col("text"))).alias("token")).distinct()
    return dense_ids(found, [F.col("token")], "id")


@R.add(f"""
    WITH j AS (SELECT t.id AS t, s.id AS s FROM {VOCAB.format(lang='en')} t FULL JOIN {VOCAB.format(lang='fr')} s USING (token)),
    c AS (SELECT count(t) AS teacher_vocab, count(s) AS student_vocab, CAST(count(*) FILTER (WHERE s IS NULL) AS BIGINT) AS only_teacher, CAST(count(*) FILTER (WHERE t IS NULL) AS BIGINT) AS only_student, CAST(count(*) FILTER (WHERE t <> s) AS BIGINT) AS moved FROM j)
    SELECT *, only_teacher::DOUBLE / greatest(teacher_vocab, 1) AS missing_frac, CASE WHEN only_teacher = 0 AND moved = 0 THEN 'exact' WHEN only_teacher::DOUBLE / greatest(teacher_vocab, 1) <= 0.1 THEN 'remap' ELSE 'none' END AS kd_mode FROM c
""")
def vocab_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.vocabulary_counts(vocabulary(spark, sf_dir, "en"), vocabulary(spark, sf_dir, "fr"))


@R.add(f"SELECT CAST(t.id AS BIGINT) AS teacher_id, CAST(s.id AS BIGINT) AS student_id FROM {VOCAB.format(lang='en')} t JOIN {VOCAB.format(lang='fr')} s USING (token)")
def vocab_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.remap_table(vocabulary(spark, sf_dir, "en"), vocabulary(spark, sf_dir, "fr")).select(F.col("teacher_id").cast("bigint").alias("teacher_id"), F.col("student_id").cast("bigint").alias("student_id"))


IDS = "[(vec_id * 7 + i * 13) % 97 FOR i IN range(0, 12)]"


@R.add(f"""
    WITH l AS (SELECT vec_id, unnest({IDS}) AS id, unnest(range(12)) AS pos FROM embeddings),
    m AS (SELECT vec_id, pos, CASE WHEN id % 5 = 0 THEN NULL ELSE id + 1000 END AS s FROM l)
    SELECT vec_id, list(coalesce(s, -100) ORDER BY pos) AS labels, count(*) AS n_tokens, CAST(count(*) FILTER (WHERE s IS NULL) AS BIGINT) AS n_unmapped FROM m GROUP BY vec_id HAVING count(*) FILTER (WHERE s IS NULL) <= 0.2 * count(*)
""")
def remap_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids through a remap table without multiples of five; rows above 20 percent unmapped go."""
    ids = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (F.col("vec_id") * 7 + i * 13) % 97)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", ids.alias("ids"))
    pairs = spark.range(97).where("id % 5 <> 0").select(F.col("id").alias("teacher_id"), (F.col("id") + 1000).alias("student_id"))
    return ops.remapped(rows, "vec_id", "ids", pairs).where(F.col("n_unmapped") <= 0.2 * F.col("n_tokens"))


@R.add(f"""
    WITH r AS (SELECT vec_id, {IDS} AS ids FROM embeddings), e AS (SELECT vec_id, CASE WHEN ids[-1] = 2 THEN ids ELSE list_append(ids, 2) END AS body FROM r)
    SELECT vec_id, list_concat([1, 1, 1], body) AS input_ids, list_concat([-100, -100, -100], body) AS labels, len(body) AS n_trainable FROM e WHERE len(body) + 3 <= 20
""")
def kd_pack_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix and response with an end token, the prefix ignored by the loss."""
    ids = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: (F.col("vec_id") * 7 + i * 13) % 97)
    body = F.when(F.element_at("ids", -1) == 2, F.col("ids")).otherwise(F.concat("ids", F.array(F.lit(2).cast("bigint"))))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", ids.alias("ids")).withColumn("body", body)
    prefix = lambda v: F.array_repeat(F.lit(v).cast("bigint"), 3)
    packed = rows.select("vec_id", F.concat(prefix(1), "body").alias("input_ids"), F.concat(prefix(tensors.IGNORE), "body").alias("labels"))
    return packed.where(F.size("input_ids") <= 20).withColumn("n_trainable", tensors.trainable(F.col("labels")).cast("bigint"))


@R.add(f"WITH d AS (SELECT conv_id, list(turn ORDER BY {HASH.format(42, 'turn')}) AS o FROM conversations GROUP BY conv_id) SELECT conv_id, o AS shown FROM d")
def shown_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates in a reproducible random order for a judge."""
    key = F.sha2(F.concat(F.lit("42:"), F.col("turn").cast("string")), 256)
    return turns(spark, sf_dir).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(key.alias("k"), "turn"))), lambda x: x["turn"]).alias("shown"))
