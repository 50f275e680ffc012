"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable

#: Edges of a file at least, on average, as long as there are so many.
ROWS = 10_000
#: Up to so many edges, at any input size, one task joins them all; more go by rounds.
FEW = 100_000


def joined(pairs: DataFrame) -> DataFrame:
    """``(node, component)`` of the edges ``(u, v)`` by union-find in one task, which holds all of them."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(x: object) -> object:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(root.setdefault(u, u)), find(root.setdefault(v, v))
                root[max(a, b)] = min(a, b)
        nodes = list(root)
        for i in range(0, len(nodes), 50_000):
            cut = nodes[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(cut, kind), pa.array([find(x) for x in cut], kind)], ["node", "component"])

    kind = pa.int64()
    return pairs.coalesce(1).mapInArrow(block, "node bigint, component bigint")


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge, the component named by its smallest node.

    Each step hangs nodes below the smallest neighbour. Minima are taken behind partial aggregations, and the
    edges of a hub meet its minimum in an equi-join that adaptive execution can split, so no neighbourhood has to
    fit a task. The edges of each round go to the shared checkpoint folder; only two numbers reach the driver.
    A few edges (``FEW``) of 64-bit nodes need no rounds, whose many small jobs would cost the driver more than the work.
    Edges with a null end and loops are left out; without edges the result is empty.
    """
    pairs = (
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    pairs, seen = durable(pairs), None
    rows = pairs.count()
    if rows <= FEW and pairs.schema["u"].dataType == T.LongType():
        return durable(joined(pairs))
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node moves to the smallest of the neighbourhood.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of a node, and the node, move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges never grow in number; few of them go to few files.
        pairs = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(max(1, rows // ROWS)))
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
