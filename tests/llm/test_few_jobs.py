"""Steps over small tables take few jobs, whatever the number of partitions; results do not depend on the way taken."""

import random

import numpy as np
import pytest

from corpuskit.llm import components, similar
from corpuskit.llm.common import text_bytes


def jobs_so_far(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()


@pytest.mark.parametrize("few", [0, components.FEW])
def test_components_of_few_edges(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    draw = random.Random(5)
    edges = [(draw.randrange(-200, 200), draw.randrange(-200, 200)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(30)] + [(None, 1), (2, None), (5000, 5000), (1000, 1001)]
    near = {}
    for u, v in edges:
        if u is not None and v is not None and u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    want = {}
    for x in sorted(near):
        todo = [x]
        while todo:
            y = todo.pop()
            if y not in want:
                want[y] = x
                todo += near[y]
    before = jobs_so_far(spark)
    got = components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert few == 0 or jobs_so_far(spark) - before <= 8
    assert components.connected_components(spark.createDataFrame([(None, 1), (3, 3)], "u bigint, v bigint")).collect() == []


def test_cell_counts_in_few_jobs(spark):
    texts = [(i, f"a{i} b{i} c d e f {i % 3}") for i in range(50)] + [(50, ""), (51, None)]
    rows = spark.createDataFrame(texts, "id bigint, text string").selectExpr("id", "xxhash64(coalesce(text, '')) AS text_hash", "text").withColumn("text", text_bytes())
    want = np.zeros(1 << similar.CELL_BITS, np.int64)
    for part in similar.distinct_sets([(t or "").encode() for _, t in texts], 3)[2]:
        np.add.at(want, (part >> np.uint64(64 - similar.CELL_BITS)).astype(np.int64), 1)
    found, before = similar.described(rows, 3), jobs_so_far(spark)
    assert (similar.cell_counts(found) == want).all()
    assert jobs_so_far(spark) - before <= 8
