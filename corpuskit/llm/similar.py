"""Near duplicates at an exact Jaccard similarity of word shingles: SimHash links first, prefix filtering for the rest.

A SimHash of 64 bits finds close copies; texts at a similarity of 0.8 lie up to 14 bits apart, out of reach of its
probes. So its links are only the first candidates, and the search is made whole by prefix filtering: in any one
order of all shingles, two sets of similarity ``num/den`` or more share one of their first
``n - ceil(n * num / den) + 1``. The order is from rare to common by a table of counts over all rows (a fixed number
of cells, so a cell's count is that of several shingles; this bears on cost only), which keeps what very many texts
hold out of the prefixes.

Candidates pass an exact bound first: the parity bitmaps of two sets differ in no more bits than the sets do in
members. What is left is verified on whole sets. Bounds: equal sets are one row from the start. Members of a bucket
meet its first or last member; pairs are then tried only between components that are still apart, in blocks, and
leave their block only if the bitmaps allow it. Hot buckets are found by a partial aggregation and joined by plain
exchanges that adaptive execution can split.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, durable, partitions_of, short_batches, text_bytes
from .components import connected_components
from .decontam import BITMAP_BITS, window_bitmap
from .simhash import BLOCK, fingerprints_of, links, shingle_hashes

#: Cells of the table of counts and its blocks; the table (4 MB) does not depend on the input.
CELL_BITS, CELL_BLOCKS = 20, 64
#: Most members of a bucket that meet in one block.
CAP = 1024
#: A pair is clear if its bitmaps use about so much of the room at most: in the first round, and in the few buckets
#: where such a pair was wrong.
CLEAR, SURE = 0.8, 0.5
#: Rounds of pairs between components; the second is nearly always the last.
MOST_ROUNDS = 40
#: Keys that a task keeps to leave out copies.
SEEN = 400_000


def distinct_sets(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Rows of the texts that have words, their SimHashes, and each one's shingle hashes in order and once."""
    some, number, h = shingle_hashes(texts, shingle)
    if not len(some):
        return some, np.empty(0, np.uint64), []
    sets = []
    for part in np.split(h, np.cumsum(number)[:-1]):
        part = np.sort(part)
        new = np.ones(len(part), bool)
        np.not_equal(part[1:], part[:-1], out=new[1:])
        sets.append(part if new.all() else part[new])
    return some, fingerprints_of(number, h), sets


def set_key(h: np.ndarray) -> int:
    """A 64-bit key of a set, from its ordered hashes."""
    return xxhash.xxh3_64_intdigest(h.tobytes())


def parity(h: np.ndarray) -> bytes:
    """A bitmap of 1024 cells or two to four per member: whether an odd number of members falls into a cell."""
    width = max(1024, 1 << (2 * len(h) - 1).bit_length())
    return np.packbits(np.bincount((h & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def closeness(n: int, bits: bytes, other_n: int, other_bits: bytes, num: int, den: int) -> float:
    """About how much of the room that a similarity of ``num/den`` leaves two sets use; infinite if they surely use more.

    The bitmaps differ in no more cells than the sets do in members, which is the sure bound; members that fall into one
    cell are made up for in the number that is returned.
    """
    if n * den < other_n * num or other_n * den < n * num:
        return math.inf
    if len(bits) < len(other_bits):
        bits, other_bits = other_bits, bits
    wide, narrow = int.from_bytes(bits, "little"), int.from_bytes(other_bits, "little")
    size = len(bits) * 8
    while size > len(other_bits) * 8:  # a bitmap folds to half its width without loss of parity
        size //= 2
        wide = (wide >> size) ^ (wide & ((1 << size) - 1))
    differ, room = (wide ^ narrow).bit_count(), (den - num) * (n + other_n)
    if differ * (den + num) > room:
        return math.inf
    return -size / 2 * math.log1p(-2 * min(differ / size, 0.499)) * (den + num) / max(room, 1)


def described(rows: DataFrame, shingle: int) -> DataFrame:
    """One row per row of ``rows`` with its set's key, size, SimHash and bitmap, and rows of cell counts per task.

    Rows of counts have ``cell`` (a block's number) and ``counts``; the others have null there. A blank text has size 0.
    """

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for part in chunks_by_bytes(batches, "text", BLOCK):
            some, fp, sets = distinct_sets(part.column("text").to_pylist(), shingle)
            n, key, mark, bits = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.uint64), np.zeros(part.num_rows, np.uint64), [None] * part.num_rows
            mark[some] = fp
            for i, h in zip(some.tolist(), sets, strict=True):
                n[i], key[i], bits[i] = len(h), set_key(h), parity(h)
            if sets:
                np.add(total, np.bincount((np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS), out=total)
            empty = pa.nulls(part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("text_hash"), pa.array(key.view(np.int64)), pa.array(n), pa.array(mark.view(np.int64)), pa.array(bits, pa.binary()), empty.cast(pa.int64()), empty.cast(pa.binary())], names
            )
            kind = part.column("id").type
        if total.any():
            width = (1 << CELL_BITS) // CELL_BLOCKS
            blocks = [zlib.compress(total[i * width : (i + 1) * width].tobytes(), 1) for i in range(CELL_BLOCKS)]
            none = pa.nulls(CELL_BLOCKS)
            yield pa.RecordBatch.from_arrays([none.cast(kind), *(none.cast(pa.int64()) for _ in range(4)), none.cast(pa.binary()), pa.array(np.arange(CELL_BLOCKS)), pa.array(blocks, pa.binary())], names)

    names = ["id", "text_hash", "key", "n", "fp", "bits", "cell", "counts"]
    kind_ = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text_hash", "text").mapInArrow(block, f"id {kind_}, text_hash bigint, key bigint, n bigint, fp bigint, bits binary, cell bigint, counts binary")


def cell_counts(found: DataFrame) -> np.ndarray:
    """How many texts hold a shingle of each cell, over all rows; blocks are added up on the executors.

    The sums, at most 8 MB in all, reach the driver in one job and not in one for each partition.
    """

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now = np.frombuffer(zlib.decompress(data), np.int64)
                sums[cell] = sums[cell] + now if cell in sums else now
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary()), pa.array([TaskContext.get().partitionId()] * len(sums), pa.int64())], ["cell", "counts", "task"])

    shape = "cell bigint, counts binary, task bigint"
    blocks = found.where("cell is not null").select("cell", "counts").mapInArrow(add, shape)
    for salts in (64, 1):  # at most a 64th of the tasks' blocks meet in one task
        blocks = blocks.withColumn("salt", F.col("task") % salts).repartition(CELL_BLOCKS, "cell", "salt").select("cell", "counts").mapInArrow(add, shape)
    out = np.zeros((CELL_BLOCKS, (1 << CELL_BITS) // CELL_BLOCKS), np.int64)
    for batch in blocks.select("cell", "counts").toArrow().to_batches():
        for cell, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            out[cell] = np.frombuffer(zlib.decompress(data), np.int64)
    return out.ravel()


def unseen(key: int, seen: set[int]) -> bool:
    """Whether a task meets a key for the first time; copies in other tasks are left to the caller."""
    if len(seen) > SEEN:
        seen.clear()
    return not (key in seen or seen.add(key))


def prefixes(rows: DataFrame, counts: np.ndarray, shingle: int, num: int, den: int) -> DataFrame:
    """``(g, key)`` for each shingle in the prefix of a text's set, once for most copies.

    ``g`` is a shingle's place in the order: its cell's count, then 40 bits of its hash. Two shingles of one place
    count as one, which only adds candidates.
    """
    known = rows.sparkSession.sparkContext.broadcast((np.minimum(counts, (1 << 23) - 1).astype(np.uint64) << np.uint64(40)))

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in chunks_by_bytes(batches, "text", BLOCK):
            first, keys = [], []
            for h in distinct_sets(part.column("text").to_pylist(), shingle)[2]:
                key = set_key(h)
                if unseen(key, seen):
                    place = known.value[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)] | (h & np.uint64((1 << 40) - 1))
                    length = len(h) + (-len(h) * num) // den + 1
                    first.append(np.partition(place, length - 1)[:length] if length < len(place) else place)
                    keys.append(key)
            if not keys:
                continue
            g, key = np.concatenate(first).view(np.int64), np.repeat(np.array(keys, np.uint64).view(np.int64), [len(x) for x in first])
            for i in range(0, len(g), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(g[i : i + 50_000]), pa.array(key[i : i + 50_000])], ["g", "key"])

    return rows.select("text").mapInArrow(block, "g bigint, key bigint")


def whole_sets(rows: DataFrame, wanted: np.ndarray, shingle: int) -> DataFrame:
    """``(key, grams)`` of the texts whose ``text_hash`` the bitmap ``wanted`` holds, once for most copies."""
    known = rows.sparkSession.sparkContext.broadcast(wanted)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in chunks_by_bytes(batches, "text", BLOCK):
            cell = (part.column("text_hash").to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            take = np.flatnonzero((known.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
            sets = distinct_sets(part.column("text").take(pa.array(take)).to_pylist(), shingle)[2] if len(take) else []
            fresh = [(k, h) for h in sets if unseen(k := set_key(h), seen)]
            if fresh:
                ends = np.cumsum([0, *(len(h) for _, h in fresh)]).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([h for _, h in fresh]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.array([k for k, _ in fresh], np.uint64).view(np.int64)), grams], ["key", "grams"])

    return rows.select("text_hash", "text").mapInArrow(block, "key bigint, grams array<bigint>")


def held_by(tokens: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The rows ``(g, key)`` whose shingle the bitmap may hold."""
    known = tokens.sparkSession.sparkContext.broadcast(bitmap)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = ((batch.column(0).to_numpy().view(np.uint64) << np.uint64(24)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            yield batch.filter(pa.array(((known.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)))

    return tokens.mapInArrow(block, "g bigint, key bigint")


def possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(u, v)`` that sizes and bitmaps of ``sets`` (``key``, ``n``, ``bits``) allow."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits, m, other = (batch.column(i).to_pylist() for i in range(2, 6))
            take = [closeness(*x, num, den) < math.inf for x in zip(n, bits, m, other, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(take, pa.bool_()))

    both = pairs.join(sets.select(F.col("key").alias("u"), F.col("n").alias("nu"), F.col("bits").alias("bu")), "u")
    both = both.join(sets.select(F.col("key").alias("v"), F.col("n").alias("nv"), F.col("bits").alias("bv")), "v")
    return both.select("u", "v", "nu", "bu", "nv", "bv").mapInArrow(block, "u bigint, v bigint")


def joined_pairs(held: list[tuple], num: int, den: int, clear_from: float) -> list[tuple[int, int, bool]]:
    """Pairs of a block that may join its components, and whether each is clear.

    Clear pairs leave so much room that they nearly always hold; of them a forest is enough. Of the others all pairs are
    told whose components no clear pair joins. ``held`` has ``(chunk, key, component, n, bits, failed)``; ``failed`` lists
    partners that were tried already. Members of one chunk meet each other, those of two chunks only across.
    """
    cross = held[0][0] != held[-1][0]
    root = {m[2]: m[2] for m in held}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    clear, doubtful = [], []
    for i, (chunk, key, component, n, bits, failed) in enumerate(held):
        for other in held[:i]:
            if (cross and chunk == other[0]) or find(component) == find(other[2]) or other[1] in failed or key in other[5]:
                continue
            used = closeness(n, bits, other[3], other[4], num, den)
            if used <= clear_from:
                root[find(component)] = find(other[2])
                clear.append((key, other[1], True))
            elif used < math.inf:
                doubtful.append((component, other[2], key, other[1]))
    return clear + [(u, v, False) for a, b, u, v in doubtful if find(a) != find(b)]


def apart_pairs(members: DataFrame, num: int, den: int, clear_from: float) -> DataFrame:
    """Pairs ``(u, v)`` of different components inside a bucket ``g`` that sizes and bitmaps allow (see ``joined_pairs``).

    ``members`` has ``g``, ``key``, ``component``, ``n``, ``bits``, ``failed`` and ``size``, the bucket's. A bucket above ``CAP``
    is cut into chunks, and each pair of chunks meets in a block of its own.
    """
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / CAP)).cast("bigint")
    dealt = members.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    dealt = dealt.select("g", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "key", "component", "n", "bits", "failed")
    dealt = dealt.repartition(partitions_of(members.sparkSession), "g", "low", "high").sortWithinPartitions("g", "low", "high", "chunk")

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, pairs = None, [], []

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64() if i < 3 else pa.bool_()) for i in range(4)], ["u", "v", "g", "clear"])
            pairs.clear()
            return out

        def meet() -> None:
            pairs.extend((min(a, b), max(a, b), name[0], clear) for a, b, clear in joined_pairs(held, num, den, clear_from))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != name:
                    if held:
                        meet()
                    if len(pairs) > 50_000:
                        yield told()
                    name, held = row[:3], []
                held.append((*row[3:8], frozenset(row[8] or ())))
        if held:
            meet()
        yield told()

    return dealt.mapInArrow(block, "u bigint, v bigint, g bigint, clear boolean")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 4, den: int = 5, distance: int = 3) -> DataFrame:
    """One row ``(id, text_hash, component)`` per row of ``docs``; null and blank texts are one component.

    Texts link where the Jaccard similarity of their sets of word shingles is ``num/den`` or more (``text_hash`` is
    Spark's ``xxhash64`` of the text, null as empty). Words are as in ``simhash.fingerprints``, whose links within
    ``distance`` bits are tried first. Repeated rows are in one component; other columns are not read.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), text_bytes(text_col).alias("text"))
    all_ = durable(described(rows, shingle))
    found = all_.where("cell is null").drop("cell", "counts")
    sets = durable(found.where("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("fp").alias("fp"), F.min("text_hash").alias("text_hash")))

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = durable(pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct().join(sets.select("key", "text_hash"), "key"))
        grams = whole_sets(rows, window_bitmap(wanted.select(F.col("text_hash").alias("hash"))), shingle)
        grams = grams.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])
        both = pairs.join(grams.select(F.col("key").alias("u"), F.col("grams").alias("gu")), "u").join(grams.select(F.col("key").alias("v"), F.col("grams").alias("gv")), "v")
        both = both.withColumn("shared", F.size(F.array_intersect("gu", "gv")))
        return durable(both.where(F.col("shared") * den >= (F.size("gu") + F.size("gv") - F.col("shared")) * num).select("u", "v"))

    # Candidates of the SimHash: sets of one fingerprint, and of fingerprints that link.
    heads = durable(sets.groupBy("fp").agg(F.min("key").alias("head")))
    close = links(heads.select("fp"), distance)
    close = close.join(heads.select(F.col("fp").alias("u"), F.col("head").alias("hu")), "u").join(heads.select(F.col("fp").alias("v"), F.col("head").alias("hv")), "v").select(F.col("hu").alias("u"), F.col("hv").alias("v"))
    close = close.unionByName(sets.join(heads, "fp").select(F.col("head").alias("u"), F.col("key").alias("v")))
    # Candidates of the prefixes: every member of a bucket with its first or last one. Buckets are counted first, so
    # that shingles that one text alone has stay where they are.
    tokens = durable(prefixes(rows, cell_counts(all_), shingle, num, den))
    again = window_bitmap(tokens.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select(F.shiftleft("g", 24).alias("hash")))
    tokens = held_by(tokens, again).groupBy("g", "key").agg(F.lit(1).alias("one"))
    tokens = durable(tokens.select("g", "key"))
    ends = durable(tokens.groupBy("g").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high"))
    met = durable(tokens.join(ends.select("g", F.when(F.col("g") % 2 == 0, F.col("low")).otherwise(F.col("high")).alias("pivot")), "g"))
    pairs = close.unionByName(met.select(F.col("key").alias("u"), F.col("pivot").alias("v"))).where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    pairs = durable(possible(pairs, sets, num, den))
    edges = verified(pairs)
    parts = connected_components(edges)
    # What else shares a shingle and is still apart is tried. Pairs of a bucket of two are done. A bucket is done after
    # one round unless a clear pair turns out wrong, since others may have been left out on its account.
    none = F.array().cast("array<bigint>")
    failed = pairs.join(edges, ["u", "v"], "left_anti")
    left = met.select("g", "key")
    for k in range(MOST_ROUNDS):
        named = durable(left.join(parts.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")))
        apart = named.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("size > 2 and low <> high").select("g", "size")
        tried = failed.groupBy(F.col("u").alias("key")).agg(F.collect_set("v").alias("failed"))
        members = named.join(apart, "g").join(sets.select("key", "n", "bits"), "key").join(tried, "key", "left").withColumn("failed", F.coalesce("failed", none))
        offered = durable(apart_pairs(members, num, den, CLEAR if k == 0 else SURE))
        once = durable(offered.select("u", "v").distinct())
        if once.isEmpty():
            break
        more = verified(once)
        if not more.isEmpty():
            # The components stand for the edges that made them.
            parts = connected_components(parts.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))
        wrong = durable(offered.where("clear").join(more, ["u", "v"], "left_anti"))
        if wrong.isEmpty():
            break
        left = durable(left.join(wrong.select("g").distinct(), "g", "left_semi"))
        failed = durable(failed.unionByName(once.join(more, ["u", "v"], "left_anti")))
    else:
        raise RuntimeError(f"pairs of unlike sets did not run out in {MOST_ROUNDS} rounds")
    return found.select("id", "text_hash", "key").join(parts.withColumnRenamed("node", "key"), "key", "left").select("id", "text_hash", F.coalesce("component", "key").alias("component"))
