"""Corpus building on ``documents`` and ``benchmark``: the language is the slice, the source the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import first_filled, hash_order, multiset_digest, norm, norm_nonum, strip_think, title, word_count
from ..operators import contamination, dedup, mixture
from ..session import durable
from .registry import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

NORM = r"trim(regexp_replace(lower({0}), '\s+', ' ', 'g'))"
NONUM = r"regexp_replace(" + NORM + r", '[0-9]+', 'N', 'g')"
N, NN = NORM.format("text"), NONUM.format("text")
HASH = "sha256('{0}:' || CAST({1} AS VARCHAR))"
WORDS = "CASE WHEN {0} = '' THEN [] ELSE string_split({0}, ' ') END"
GRAMS = "CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN {short} ELSE list_distinct([array_to_string(w[i:i + {k} - 1], ' ') FOR i IN range(1, len(w) - {k} + 2)]) END"
DOC_W = f"SELECT doc_id, {WORDS.format(N)} AS w FROM documents"
BENCH_W = f"SELECT item_id, {WORDS.format(N)} AS w FROM benchmark"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


STATUS_SQL = f"""
    WITH d AS (SELECT *, md5({N}) AS h, md5({NN}) AS hn FROM documents),
    b AS (SELECT md5({N}) AS h, md5({NN}) AS hn FROM benchmark),
    s AS (SELECT doc_id, source, lang, h, CASE WHEN length(text) NOT BETWEEN 20 AND 12000 THEN 'length'
        WHEN h IN (SELECT h FROM b) OR hn IN (SELECT hn FROM b) THEN 'benchmark'
        WHEN doc_id <> min(doc_id) OVER (PARTITION BY h) THEN 'dup' ELSE 'kept' END AS status FROM d)
"""


def keyed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their texts: names, whether the length fits, and the hashes of the normal forms."""
    d = docs(spark, sf_dir).select("doc_id", "source", "lang", "text", F.char_length("text").between(20, 12_000).alias("fits"))
    return contamination.keyed(d, F.col("text")).drop("text")


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.screen(keyed_docs(spark, sf_dir), contamination.keyed(table(spark, sf_dir, "benchmark"), F.col("text")).select("h", "hn"))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the first reason to drop them: length, benchmark, dup; else kept."""
    d = dedup.first_occurrence(durable(screened(spark, sf_dir)), F.col("h"), "doc_id")
    return d.withColumn("status", F.when(~F.col("fits"), "length").when(F.col("exact") | F.col("nonum"), "benchmark").when(~F.col("is_first"), "dup").otherwise("kept"))


@R.add(STATUS_SQL + "SELECT source, status, count(*) AS n FROM s GROUP BY ALL")
def decontam_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).groupBy("source", "status").agg(F.count("*").alias("n"))


@R.add(f"SELECT min(doc_id) AS doc_id, md5({N}) AS h, count(*) AS n FROM documents GROUP BY 2")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).groupBy(F.md5(norm(F.col("text"))).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@R.add(f"SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY md5({NN})) AS is_first FROM documents")
def nonum_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_occurrence(docs(spark, sf_dir), F.md5(norm_nonum(F.col("text"))), "doc_id").select("doc_id", "is_first")


@R.add(f"SELECT doc_id, md5({N}) IN (SELECT md5({N}) FROM benchmark) AS exact FROM documents")
def bench_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screened(spark, sf_dir).select("doc_id", "exact")


@R.add(f"SELECT doc_id, md5({NN}) IN (SELECT md5({NN}) FROM benchmark) AS nonum FROM documents")
def bench_nonum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screened(spark, sf_dir).select("doc_id", "nonum")


@R.add(f"""
    WITH d AS (SELECT doc_id, {GRAMS.format(k=3, short="[array_to_string(w, ' ')]")} AS g FROM ({DOC_W})),
    b AS (SELECT item_id, {GRAMS.format(k=3, short="[array_to_string(w, ' ')]")} AS g FROM ({BENCH_W})),
    de AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM d), be AS (SELECT item_id, len(g) AS n, unnest(g) AS x FROM b)
    SELECT item_id, doc_id, count(*) AS shared, be.n + de.n - count(*) AS total FROM be JOIN de USING (x) GROUP BY item_id, doc_id, be.n, de.n
    HAVING count(*) * 10 >= be.n + de.n - count(*)
""")
def bench_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and documents with Jaccard similarity of 0.1 or more, so that embedded passages show up."""
    items, own = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    return contamination.similar(items, own, 3, 1, 10).select(F.col("l").alias("item_id"), F.col("r").alias("doc_id"), "shared", "total")


CONTAINED_SQL = f"""
    WITH d AS (SELECT doc_id, {GRAMS.format(k=8, short="[]")} AS g FROM ({DOC_W})),
    b AS (SELECT item_id, {GRAMS.format(k=8, short="[]")} AS g FROM ({BENCH_W})),
    de AS (SELECT doc_id, unnest(g) AS x FROM d), be AS (SELECT item_id, len(g) AS n, unnest(g) AS x FROM b),
    hit AS (SELECT item_id, doc_id, count(*) AS shared, n FROM be JOIN de USING (x) GROUP BY item_id, doc_id, n HAVING count(*) * 5 >= n * 3)
"""


@R.add(CONTAINED_SQL + "SELECT item_id, doc_id, shared, n AS n_grams FROM hit")
def bench_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, own = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    return contamination.contained(items, own).select(F.col("l").alias("item_id"), F.col("r").alias("doc_id"), "shared", F.col("nl").alias("n_grams"))


@R.add(CONTAINED_SQL + "SELECT item_id, min(doc_id) AS first_doc, count(*) AS n_docs FROM hit GROUP BY item_id")
def first_containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench_containment(spark, sf_dir).groupBy("item_id").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_docs"))


@R.add(CONTAINED_SQL + f"""
    , k AS (SELECT doc_id, md5({N}) IN (SELECT md5({N}) FROM benchmark) AS e, md5({NN}) IN (SELECT md5({NN}) FROM benchmark) AS m, doc_id IN (SELECT doc_id FROM hit) AS c FROM documents)
    SELECT count(*) AS scanned, CAST(count(*) FILTER (WHERE e OR m OR c) AS BIGINT) AS contaminated, CAST(count(*) FILTER (WHERE e) AS BIGINT) AS by_exact,
        CAST(count(*) FILTER (WHERE m AND NOT e) AS BIGINT) AS by_nonum, CAST(count(*) FILTER (WHERE c AND NOT e AND NOT m) AS BIGINT) AS by_gram FROM k
""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of detector counts; a later detector is asked only where the earlier ones found nothing."""
    d = screened(spark, sf_dir).select("doc_id", "exact", "nonum")
    held = bench_containment(spark, sf_dir).select("doc_id").distinct().withColumn("gram", F.lit(True))
    d = d.join(held, "doc_id", "left").withColumn("gram", F.coalesce("gram", F.lit(False)))
    return d.agg(
        F.count("*").alias("scanned"), F.count_if(F.col("exact") | F.col("nonum") | F.col("gram")).alias("contaminated"), F.count_if("exact").alias("by_exact"),
        F.count_if(F.col("nonum") & ~F.col("exact")).alias("by_nonum"), F.count_if(F.col("gram") & ~F.col("exact") & ~F.col("nonum")).alias("by_gram"),
    )


NEAR_SQL = f"""
    WITH s AS (SELECT doc_id, {GRAMS.format(k=3, short="[array_to_string(w, ' ')]")} AS g FROM ({DOC_W})),
    h AS (SELECT doc_id, g, min(doc_id) OVER (PARTITION BY list_sort(g)) AS rep FROM s),
    e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM h WHERE doc_id = rep),
    p AS (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS shared, l.n + r.n - count(*) AS total FROM e l JOIN e r ON l.x = r.x AND l.doc_id < r.doc_id
        GROUP BY l.doc_id, r.doc_id, l.n, r.n HAVING count(*) * 5 >= 4 * (l.n + r.n - count(*)))
"""


@R.add(NEAR_SQL + "SELECT a, b, shared, total FROM p")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicate_pairs(docs(spark, sf_dir), "doc_id", F.col("text"))[0]


@R.add(NEAR_SQL + "SELECT doc_id, rep FROM h")
def near_dup_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.classes(docs(spark, sf_dir), "doc_id", F.col("text")).select(F.col("id").alias("doc_id"), "rep")


@R.add(NEAR_SQL + "SELECT doc_id FROM h WHERE doc_id = rep AND doc_id NOT IN (SELECT b FROM p)")
def near_dup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, members = dedup.near_duplicate_pairs(docs(spark, sf_dir), "doc_id", F.col("text"))
    return dedup.survivors(members, pairs).select(F.col("id").alias("doc_id"))


@R.add()
def greedy_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors of the sequential scan, by rounds; SQL has no such fixpoint."""
    pairs, members = dedup.near_duplicate_pairs(docs(spark, sf_dir), "doc_id", F.col("text"))
    return dedup.independent_set(members.where("id = rep").select("id"), pairs).select(F.col("id").alias("doc_id"))


@R.add("SELECT lang AS slice, length(text) BETWEEN 20 AND CASE WHEN lang = 'de' THEN 120000 ELSE 12000 END AS fits, count(*) AS n FROM documents GROUP BY ALL")
def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length window with a longer cap for one slice."""
    fits = F.char_length("text").between(F.lit(20), F.when(F.col("lang") == "de", 120_000).otherwise(12_000))
    return docs(spark, sf_dir).groupBy(F.col("lang").alias("slice"), fits.alias("fits")).agg(F.count("*").alias("n"))


@R.add(f"SELECT doc_id, len({WORDS.format(N)}) AS n_words, CASE WHEN len({WORDS.format(N)}) < 15 THEN 'exact_only' ELSE 'near' END AS route FROM documents")
def short_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = word_count(F.col("text")).cast("bigint")
    return docs(spark, sf_dir).select("doc_id", n.alias("n_words"), F.when(n < 15, "exact_only").otherwise("near").alias("route"))


TARGETS = "(VALUES (0, 'coding', 0.4::DOUBLE, 0.0::DOUBLE), (1, 'math', 0.2, 0.0), (2, 'general', 0.2, 0.02), (3, 'tool_calling', 0.05, 0.01), (4, 'long_context', 0.05, 0.01), (5, 'structured_science', 0.05, 0.01)) AS t(pos, slice, own, more)"


@R.add(f"""
    WITH s AS (SELECT pos, slice, own + more AS share FROM {TARGETS}), f AS (SELECT *, CAST(floor(10007 * share / sum(share) OVER ()) AS BIGINT) AS fl FROM s),
    r AS (SELECT *, row_number() OVER (ORDER BY fl DESC, pos) AS k, CAST(10007 - sum(fl) OVER () AS BIGINT) AS rest FROM f)
    SELECT slice, fl + CASE WHEN k = 1 THEN rest ELSE 0 END AS target FROM r
""")
def slice_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.slice_targets(spark, 10_007).select("slice", F.col("target").cast("bigint").alias("target"))


@R.add(f"""
    WITH d AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY {HASH.format(42, 'doc_id')}, doc_id) AS place FROM documents)
    SELECT doc_id, lang AS slice, source, CAST(place AS INTEGER) AS place FROM d WHERE place <= 5
""")
def source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [hash_order(F.col("doc_id")), F.col("doc_id")]
    d = docs(spark, sf_dir).select("doc_id", F.col("lang").alias("slice"), "source")
    return mixture.ranked(d, ["slice", "source"], order).where("place <= 5")


@R.add(f"""
    WITH d AS (SELECT doc_id, lang, source, {HASH.format(42, 'doc_id')} AS o FROM documents),
    c AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY o) > 4 AS filled FROM d),
    p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY filled, o) AS place FROM c)
    SELECT doc_id, lang AS slice, filled FROM p WHERE place <= 90
""")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).select("doc_id", F.col("lang").alias("slice"), "source")
    return mixture.backfilled(d, "slice", "source", hash_order(F.col("doc_id")), F.lit(90), F.lit(4)).select("doc_id", "slice", "filled")


@R.add(STATUS_SQL + "SELECT lang AS slice, source, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY lang) AS share FROM s WHERE status = 'kept' GROUP BY lang, source")
def realized_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = statuses(spark, sf_dir).where("status = 'kept'").groupBy(F.col("lang").alias("slice"), "source").agg(F.count("*").alias("n"))
    return mix.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("slice")))


@R.add(STATUS_SQL + "SELECT lang AS slice, CAST(count(*) FILTER (WHERE status = 'kept') AS BIGINT) AS kept, count(*) AS target FROM s GROUP BY lang HAVING count(*) FILTER (WHERE status = 'kept') < 0.98 * count(*)")
def shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = statuses(spark, sf_dir).groupBy(F.col("lang").alias("slice")).agg(F.count_if(F.col("status") == "kept").alias("kept"), F.count("*").alias("target"))
    return s.where(F.col("kept") < 0.98 * F.col("target"))


@R.add(STATUS_SQL + """SELECT lang AS slice, count(*) AS collected, CAST(count(*) FILTER (WHERE status = 'kept') AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE status = 'dup') AS BIGINT) AS dropped_dup,
    CAST(count(*) FILTER (WHERE status = 'benchmark') AS BIGINT) AS dropped_benchmark, CAST(count(*) FILTER (WHERE status = 'length') AS BIGINT) AS dropped_length FROM s GROUP BY lang""")
def build_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda v: F.count_if(F.col("status") == v)
    return statuses(spark, sf_dir).groupBy(F.col("lang").alias("slice")).agg(
        F.count("*").alias("collected"), count("kept").alias("kept"), count("dup").alias("dropped_dup"), count("benchmark").alias("dropped_benchmark"), count("length").alias("dropped_length")
    )


QUOTA_SQL = f"""
    WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
    q AS (SELECT lang, n, CAST(floor(100 * n / sum(n) OVER ()) AS BIGINT) AS q FROM c),
    z AS (SELECT lang, q + CASE WHEN row_number() OVER (ORDER BY n DESC, lang) = 1 THEN 100 - sum(q) OVER () ELSE 0 END AS quota FROM q),
    p AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {HASH.format(42, 'doc_id')}) AS place FROM documents),
    held AS (SELECT doc_id, lang FROM p JOIN z USING (lang) WHERE place <= quota)
"""


def heldout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stratified held-out set of 100 documents."""
    d = docs(spark, sf_dir).select("doc_id", "lang")
    quotas = mixture.heldout_quotas(d.groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", 100).withColumnRenamed("lang", "__g")
    # No quota is above the whole size, so groups are cut to it before their shuffle.
    placed = mixture.ranked(d, ["lang"], [hash_order(F.col("doc_id"))]).where("place <= 100")
    return placed.join(quotas, F.col("lang") == F.col("__g")).where(F.col("place") <= F.col("quota")).drop("__g")


@R.add(QUOTA_SQL + "SELECT doc_id, lang FROM held")
def heldout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heldout(spark, sf_dir).select("doc_id", "lang")


@R.add(QUOTA_SQL + f"""
    , t AS (SELECT md5({N}) AS h FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM held)), x AS (SELECT md5({N}) AS h FROM documents WHERE doc_id IN (SELECT doc_id FROM held))
    SELECT 'heldout_overlap' AS gate, count(*) AS n_violations, CASE WHEN count(*) = 0 THEN 'CLEAN' ELSE 'CONTAMINATED' END AS verdict FROM x WHERE h IN (SELECT h FROM t)
""")
def heldout_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = docs(spark, sf_dir).select("doc_id", F.md5(norm(F.col("text"))).alias("h")).join(heldout(spark, sf_dir).select("doc_id", F.lit(True).alias("held")), "doc_id", "left")
    marked = durable(marked.select("h", F.col("held").isNotNull().alias("held")))
    return contamination.gate("heldout_overlap", marked.where("held").join(marked.where("not held").select("h"), "h", "left_semi"))


@R.add(f"""
    WITH b AS (SELECT md5({N}) AS h FROM documents WHERE source IN ('src0', 'src1')), x AS (SELECT doc_id, md5({N}) AS h FROM documents WHERE source NOT IN ('src0', 'src1'))
    SELECT doc_id FROM x WHERE h NOT IN (SELECT h FROM b)
""")
def base_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension documents that the base set does not hold."""
    d = docs(spark, sf_dir).withColumn("h", F.md5(norm(F.col("text"))))
    base = F.col("source").isin("src0", "src1")
    return d.where(~base).join(d.where(base).select("h").distinct(), "h", "left_anti").select("doc_id")


@R.add(f"SELECT doc_id, row_number() OVER (ORDER BY {HASH.format(42, 'doc_id')}, doc_id) - 1 + 100000 AS sample_id FROM documents")
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).select("doc_id").withColumn("o", hash_order(F.col("doc_id")))
    return mixture.dense_ids(d, [F.col("o"), F.col("doc_id")], start=100_000).select("doc_id", "sample_id")


@R.add(f"""
    WITH g AS (SELECT DISTINCT source FROM documents), c AS (SELECT source FROM g ORDER BY {HASH.format(42, 'source')}, source LIMIT (SELECT greatest(1, count(*) // 5) FROM g))
    SELECT doc_id, source, CASE WHEN source IN (SELECT source FROM c) THEN 'validation' ELSE 'train' END AS split FROM documents
""")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.group_split(docs(spark, sf_dir), "source", hash_order(F.col("source"))).select("doc_id", "source", "split")


@R.add(f"SELECT doc_id FROM documents ORDER BY {HASH.format(42, 'doc_id')}, doc_id LIMIT (SELECT CAST(ceil(0.02 * count(*)) AS BIGINT) FROM documents)")
def row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation rows of a two-percent split, in hash order."""
    d = docs(spark, sf_dir).select("doc_id")
    placed = mixture.dense_ids(d.withColumn("o", hash_order(F.col("doc_id"))), [F.col("o"), F.col("doc_id")], "place")
    return placed.where(F.col("place") < -(-2 * d.count() // 100)).select("doc_id")


@R.add(f"""
    WITH b AS (SELECT doc_id, lang, 'base' AS origin FROM documents WHERE lang = 'en'),
    x AS (SELECT doc_id, lang, 'mix' AS origin FROM documents WHERE lang = 'fr' AND length(text) BETWEEN 20 AND 12000 ORDER BY {HASH.format(7, 'doc_id')} LIMIT (SELECT CAST(round(count(*) * 0.2 / 0.8) AS BIGINT) FROM b))
    SELECT * FROM b UNION ALL SELECT * FROM x
""")
def mix_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    base = d.where("lang = 'en'").select("doc_id", "lang", F.lit("base").alias("origin"))
    extra = d.where((F.col("lang") == "fr") & F.char_length("text").between(20, 12_000)).select("doc_id", "lang", F.lit("mix").alias("origin"))
    return mixture.mix_in(base, extra, 0.2, hash_order(F.col("doc_id"), seed=7))


@R.add("SELECT CAST(doc_id AS VARCHAR) AS id, text, 'documents' AS origin, lang FROM documents UNION ALL SELECT CAST(item_id AS VARCHAR), text, 'benchmark', NULL FROM benchmark")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "text", F.lit("documents").alias("origin"), "lang")
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text", F.lit("benchmark").alias("origin"))
    return a.unionByName(b, allowMissingColumns=True)


@R.add("""
    SELECT 'only_labels' AS kind, count(*) AS n FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)
    UNION ALL SELECT 'only_documents', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
""")
def set_diff_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = docs(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(b.subtract(a), "only_labels").unionByName(count(a.subtract(b), "only_documents")).unionByName(count(a.intersect(b), "both"))


@R.add("SELECT doc_id, trim(regexp_replace(string_split(text || CASE WHEN doc_id % 2 = 0 THEN '</think> an answer ' ELSE '' END, '</think>')[-1], '^\\s+|\\s+$', '', 'g')) AS answer FROM documents")
def strip_thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("text", F.when(F.col("doc_id") % 2 == 0, "</think> an answer ").otherwise(""))
    return docs(spark, sf_dir).select("doc_id", F.trim(strip_think(text)).alias("answer"))


@R.add(r"""
    SELECT doc_id, left(coalesce(list_filter(list_transform(regexp_split_to_array(text, '\r\n|\n|\r'), lambda x: trim(regexp_replace(trim(x), '^#+', ''))), lambda x: x <> '')[1], ''), 180) AS title FROM documents
""")
def problem_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", title(F.col("text")).alias("title"))


@R.add("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, ''), nullif(source, ''), '') AS field FROM documents")
def first_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", first_filled(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")), F.col("source")).alias("field"))


@R.add("SELECT doc_id, lang AS slice, coalesce(source, 'extra') AS source, 42 + doc_id AS gen_seed, CASE lang WHEN 'en' THEN 0.7::DOUBLE WHEN 'fr' THEN 0.6::DOUBLE ELSE 0.7::DOUBLE END AS temperature FROM documents")
def sampling_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed and temperature of each prompt; slices without their own temperature use the usual one."""
    own = F.create_map(F.lit("en"), F.lit(0.7), F.lit("fr"), F.lit(0.6))
    return docs(spark, sf_dir).select("doc_id", F.col("lang").alias("slice"), F.coalesce("source", F.lit("extra")).alias("source"), (F.col("doc_id") + 42).alias("gen_seed"), F.coalesce(F.try_element_at(own, F.col("lang")), F.lit(0.7)).alias("temperature"))


@R.add("SELECT doc_id FROM documents WHERE NOT (source LIKE '%src1%' OR source LIKE '%src7%')")
def subset_ban(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).where(~(F.contains("source", F.lit("src1")) | F.contains("source", F.lit("src7")))).select("doc_id")


DIGEST_SQL = " || ':' || ".join(f"CAST(CAST(sum(CAST('0x' || {{h}}[{1 + 14 * i}:{14 * i + 14}] AS BIGINT)) % 72057594037927936 AS BIGINT) AS VARCHAR)" for i in range(4))


@R.add(f"WITH d AS (SELECT lang, source, sha256(text) AS h FROM documents) SELECT lang, source, sha256({DIGEST_SQL.format(h='h')}) AS digest, count(*) AS n FROM d GROUP BY lang, source")
def dataset_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each shard's contents that their order does not change."""
    hashed = docs(spark, sf_dir).select("lang", "source", F.sha2("text", 256).alias("h"))
    return hashed.groupBy("lang", "source").agg(multiset_digest(F.col("h")).alias("digest"), F.count("*").alias("n"))
