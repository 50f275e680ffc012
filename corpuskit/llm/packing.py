"""Packing into optimal length buckets.

The exact histogram of sequence lengths over all documents goes to the driver (at most ``max_len`` numbers). A
dynamic program picks the bucket lengths that waste the least padding. Inside a bucket, sequences form batches of
a fixed token budget. A bucket is split by hash into groups of about ``GROUP_BATCHES`` batches, whose number
follows from the histogram, so that no window partition grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks_by_bytes, durable, short_batches
from .tokens import DEFAULT_RANKS, encoding

#: Full batches that a group holds on average; a group ends with one batch that is not full.
GROUP_BATCHES = 16
BLOCK = 4_000_000


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """``(id, n_tokens)`` per row: byte-level BPE tokens of the whole text plus one end token. Null is empty."""
    short_batches(docs.sparkSession)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        for part in chunks_by_bytes(batches, "__text", BLOCK):
            counts = [len(enc.encode_ordinary(t)) + 1 for t in part.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("__id"), pa.array(counts, pa.int64())], ["__id", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(block, f"__id {kind}, n_tokens bigint").select(F.col("__id").alias(id_col), "n_tokens")


def best_buckets(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` bucket lengths, the largest length included, with the least total padding.

    ``lengths`` are distinct and ascending. Exact: the program looks at every last length of every bucket.
    """
    n = len(lengths)
    if not n:
        return []
    l, c = lengths.astype(np.float64), counts.astype(np.float64)
    rows, tokens = np.concatenate(([0], np.cumsum(c))), np.concatenate(([0], np.cumsum(c * l)))
    best = l * rows[1:] - tokens[1:]  # one bucket for the first i + 1 lengths
    cuts = []
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.full(n, -1)
        for i in range(1, n):
            # Lengths j + 1 .. i share the last bucket.
            cost = best[:i] + l[i] * (rows[i + 1] - rows[1 : i + 1]) - (tokens[i + 1] - tokens[1 : i + 1])
            j = int(cost.argmin())
            if cost[j] < now[i]:
                now[i], cut[i] = cost[j], j
        best = now
        cuts.append(cut)
    ends, at = [n - 1], n - 1
    for cut in reversed(cuts):
        if cut[at] >= 0:
            at = int(cut[at])
            ends.append(at)
    return [int(lengths[i]) for i in reversed(ends)]


def pack(counted: DataFrame, id_col: str = "doc_id", max_len: int = 2048, buckets: int = 8, token_budget: int = 65_536, salt: int = 0) -> DataFrame:
    """Batches of length buckets: ``(id, piece, n_tokens, bucket_len, batch_id, slot)``, one row per sequence.

    ``counted`` has the id and ``n_tokens`` (1 or more; less and null count as 1). A document longer than
    ``max_len`` becomes pieces of ``max_len`` and a rest. ``batch_id`` names bucket, group and number; a batch has
    at most ``token_budget // bucket_len`` sequences (one at least). Order inside a group follows a hash of id,
    piece and ``salt``; repeated rows are packed as often as they occur. An empty table gives none.
    """
    counted = durable(counted.select(F.col(id_col).alias("__id"), F.greatest(F.coalesce("n_tokens", F.lit(1)), F.lit(1)).cast("bigint").alias("__n")))
    pieces = counted.select("__id", "__n", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / max_len).cast("int"))).alias("piece"))
    pieces = pieces.select("__id", "piece", F.least(F.lit(max_len), F.col("__n") - F.col("piece") * F.lit(max_len).cast("bigint")).alias("n_tokens"))
    histogram = sorted((int(r["n_tokens"]), int(r["n"])) for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    lengths, counts = np.array([h[0] for h in histogram], np.int64), np.array([h[1] for h in histogram], np.int64)
    ends = best_buckets(lengths, counts, buckets)
    bucket, room, groups, low = F.lit(None).cast("int"), F.lit(1), F.lit(1), 0
    for end in reversed(ends):
        low = max([0, *(e for e in ends if e < end)])
        held = int(counts[(lengths > low) & (lengths <= end)].sum())
        fits = max(1, token_budget // end)
        inside = F.col("n_tokens") <= end
        bucket = F.when(inside & (F.col("n_tokens") > low), end).otherwise(bucket)
        room = F.when(inside & (F.col("n_tokens") > low), fits).otherwise(room)
        groups = F.when(inside & (F.col("n_tokens") > low), max(1, held // (fits * GROUP_BATCHES))).otherwise(groups)
    order = F.xxhash64(F.lit(salt), F.col("__id"), F.col("piece"))
    dealt = pieces.withColumns({"bucket_len": bucket, "__room": room, "__order": order, "__group": F.pmod(F.xxhash64(F.lit(salt + 1), F.col("__id"), F.col("piece")), groups.cast("bigint"))})
    place = F.row_number().over(Window.partitionBy("bucket_len", "__group").orderBy("__order", "__id", "piece")) - 1
    return dealt.withColumn("__place", place).select(
        F.col("__id").alias(id_col), "piece", "n_tokens", "bucket_len",
        F.concat_ws("-", "bucket_len", "__group", F.floor(F.col("__place") / F.col("__room"))).alias("batch_id"),
        (F.col("__place") % F.col("__room")).cast("int").alias("slot"),
    )
