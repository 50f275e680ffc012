"""Near copies of benchmark items are found through leads, and texts without a candidate are not compared in full."""

import random

from pyspark.sql import functions as F

from corpuskit.operators import builds, contamination, dedup


def test_similar_by_leads_equals_all_pairs(spark):
    """Items and texts of all sizes around the boundary, blank and null ones, and an id that two texts share."""
    draw, items, texts = random.Random(11), [(900, ""), (901, None)], [(5000, ""), (5001, None), (5002, "one"), (5003, "one two")]
    for i in range(30):
        base = [f"w{draw.randrange(30 if draw.random() < 0.3 else 1 << 20)}" for _ in range(draw.choice([1, 2, 3, 5, 9, 20, 60, 150]))]
        items.append((i, " ".join(base)))
        for _ in range(8):
            own = [w if draw.random() > 0.06 else f"x{draw.randrange(1 << 20)}" for w in base]
            texts.append((len(texts), " ".join(own[: draw.randint(max(1, len(own) - len(own) // 5), len(own))])))
    texts.append((10, items[3][1]))
    i, t = (spark.createDataFrame(x, "id bigint, text string") for x in (items, texts))
    leads = dedup.shingle_sets(t, "id", F.col("text")).select("id", *dedup.lead_columns(F.col("grams")))
    want = sorted(map(tuple, contamination.similar(i, t).collect()))
    assert sorted(map(tuple, contamination.similar_by_leads(i, t, leads).collect())) == want and len(want) > 60


def test_cascade_compares_only_candidates_with_items(spark, monkeypatch):
    draw, compared, similar = random.Random(4), [], contamination.similar
    texts = [(i, " ".join(f"w{draw.randrange(1 << 20)}" for _ in range(100)), "a", "s") for i in range(200)]
    d = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")
    items = d.where("doc_id < 2").select(F.col("doc_id").alias("item_id"), F.concat("text", F.lit(" end")).alias("text"))
    monkeypatch.setattr(contamination, "similar", lambda left, right, *more: (compared.append(right.count()), similar(left, right, *more))[1])
    got = builds.cascade(d, items, "doc_id", "lang", "source", 500).collect()
    assert sorted(r.id for r in got if r.status == "near_benchmark") == [0, 1] and compared == [2]
