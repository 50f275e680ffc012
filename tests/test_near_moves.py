"""What near-duplicate search and greedy choices move and read, and whether they find all."""

import random

from pyspark.sql import functions as F

from corpuskit.functions.text import any_of
from corpuskit.operators import dedup

SF = "/root/testdata/sf0.001"


def stage_totals(spark):
    """Bytes shuffled and rows read by all stages so far."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    stages = [stages.apply(i) for i in range(stages.size())]
    return sum(x.shuffleWriteBytes() for x in stages), sum(x.inputRecords() for x in stages)


def test_jaccard_pairs_equal_brute_force(spark):
    """Sets of all sizes around the boundary, with grams that many share and grams that one holds."""
    draw, sets = random.Random(7), []
    for base in range(40):
        n = draw.choice([1, 2, 3, 4, 5, 7, 10, 16, 25, 40, 80, 150])
        grams = [draw.randrange(40 if draw.random() < 0.3 else 1 << 40) for _ in range(n)]
        for _ in range(5):
            kept = [g if draw.random() > 0.12 else draw.randrange(1 << 40) for g in grams]
            sets.append((len(sets), sorted(set(kept[: draw.randint(max(1, n - n // 5), n)]))))
    want = {(a, b, len(set(x) & set(y)), len(set(x) | set(y))) for a, x in sets for b, y in sets if a < b and len(set(x) & set(y)) * 5 >= len(set(x) | set(y)) * 4}
    got = dedup.jaccard_pairs(spark.createDataFrame(sets, "id bigint, grams array<bigint>")).collect()
    assert len(got) == len(want) > 60 and {tuple(r) for r in got} == want


def test_near_pairs_move_each_gram_about_once(spark):
    draw = random.Random(3)
    texts = [(i, " ".join(f"w{draw.randrange(1 << 20)}" for _ in range(300))) for i in range(600)]
    texts += [(1000 + i, t + " end") for i, t in texts[:20]] + [(2000, texts[0][1])]
    df = spark.createDataFrame(texts, "id bigint, text string")
    before = stage_totals(spark)[0]
    pairs, members = dedup.near_duplicate_pairs(df, "id", F.col("text"))
    assert sorted((r.a, r.b, r.shared, r.total) for r in pairs.collect()) == [(i, 1000 + i, 298, 299) for i in range(20)]
    assert {r.id: r.rep for r in members.collect()} == {i: 0 if i == 2000 else i for i, _ in texts}
    assert stage_totals(spark)[0] - before < 1.5 * 8 * 298 * len(texts)


def test_classes_move_no_sets(spark):
    df = spark.range(400).select("id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(200)), lambda k: F.sha2((k * 1000 + F.col("id") % 390).cast("string"), 256)), " ").alias("text"))
    before = stage_totals(spark)[0]
    from corpuskit.queries import corpus

    df = df.withColumnRenamed("id", "doc_id")
    docs, corpus.docs = corpus.docs, lambda *_: df
    try:
        got = corpus.near_dup_membership(spark, "").collect()
    finally:
        corpus.docs = docs
    assert sorted((r.doc_id, r.rep) for r in got) == [(i, i % 390) for i in range(400)]
    assert stage_totals(spark)[0] - before < 100 * 400


def test_keywords_make_their_text_once(spark):
    plan = spark.range(1).select(any_of(F.lower(F.col("id").cast("string")), ("a", "b")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(lower(" not in plan and "lower(" in plan
    texts = spark.createDataFrame([("abd",), ("ad",), (None,)], "t string")
    assert [r[0] for r in texts.select(any_of(F.col("t"), ("b", "c"))).collect()] == [True, False, None]


def test_seeded_greedy_scores_texts_once(spark):
    from corpuskit.queries import reviews

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    before = stage_totals(spark)[1]
    reviews.seeded_greedy(spark, SF).collect()
    assert stage_totals(spark)[1] - before < 2 * n + spark.read.parquet(f"{SF}/labels.parquet").count() * 3
