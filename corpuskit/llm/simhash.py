"""SimHash near-duplicate detection by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes over word shingles. Bits that vary together are grouped into the same of four
partitions. A fingerprint finds all others within ``distance`` bits if its partition thresholds sum up to
``distance - partitions + 1``; a dynamic program allots them, unequally, so that the expected number of candidates
is least. Candidates that meet in a bucket (partition, value) are verified on the whole fingerprint, and links
become components.

Bounds: equal fingerprints are one row from the start, whatever the number of copies. Tables that go to the driver
or are broadcast hold 64 x 64 bit counts and 4 x 65,536 bucket sizes, at any input size. A bucket above ``CAP``
rows is cut into chunks that meet pairwise in separate groups, and a far larger one is first refined by a second
partition level, so no group is unbounded. A group emits the edges of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, durable, partitions_of, short_batches, text_bytes
from .components import connected_components
from .xxh import xxh64_slices

BITS, PARTS, WIDTH = 64, 4, 16
#: Most index or probe rows of a bucket that meet in one group.
CAP = 1024
#: Expected bucket size from which a bucket is refined by a second level of partitions first.
REFINE = 32 * CAP
#: Bytes of text that are fingerprinted at once.
BLOCK = 2_000_000


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(texts: list[bytes], shingle: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the texts that have words, how many shingles each of these has, and the shingles' XXH64 one after the other."""
    words = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    some = np.flatnonzero(counts)
    if not len(some):
        return some, np.empty(0, np.int64), np.empty(0, np.uint64)
    counts = counts[some]
    data = b" ".join([b" ".join(words[i]) for i in some])
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    begin = np.concatenate(([0], spaces + 1))
    end = np.concatenate((spaces, [len(data)]))
    number = np.maximum(counts - shingle + 1, 1)
    first = np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), number)
    first += np.arange(len(first)) - np.repeat(np.cumsum(number) - number, number)
    last = first + np.repeat(np.minimum(counts, shingle), number) - 1
    return some, number, xxh64_slices(data, begin[first], end[last] - begin[first], seed)


def fingerprints_of(number: np.ndarray, h: np.ndarray) -> np.ndarray:
    """SimHash as uint64 of each text with words, from the hashes of its ``number`` shingles one after the other."""
    offset = np.cumsum(number) - number
    # Bits are counted in byte lanes over runs of at most 255 shingles, which cannot overflow.
    runs = (number + 254) // 255
    run_offset = np.concatenate(([0], np.cumsum(runs)[:-1]))
    run_start = np.repeat(offset, runs) + 255 * (np.arange(runs.sum()) - np.repeat(run_offset, runs))
    votes = np.empty((len(number), BITS), np.int64)
    ones = np.uint64(0x0101010101010101)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & ones, run_start)
        votes[:, k::8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), run_offset, axis=0)
    return np.packbits(votes * 2 > number[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint_block(texts: list[bytes], shingle: int, seed: int = 42) -> np.ndarray:
    """SimHash of each text as uint64; a text without words has fingerprint 0."""
    out = np.zeros(len(texts), np.uint64)
    some, number, h = shingle_hashes(texts, shingle, seed)
    if len(some):
        out[some] = fingerprints_of(number, h)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, seed: int = 42) -> DataFrame:
    """``(id, fp)`` for each row: ``fp`` is the SimHash of the whole text as a signed long.

    A-Z are lower-cased, words are runs without ASCII white space, shingles of ``shingle`` words count as often as
    they occur, and a shorter text is one shingle. Null, empty and blank texts have fingerprint zero.
    """
    short_batches(docs.sparkSession)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_by_bytes(batches, "__text", BLOCK):
            fp = fingerprint_block(part.column("__text").to_pylist(), shingle, seed)
            yield pa.RecordBatch.from_arrays([part.column("__id"), pa.array(fp.view(np.int64))], ["__id", "__fp"])

    rows = docs.select(F.col(id_col).alias("__id"), text_bytes(text_col).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(block, f"__id {kind}, __fp bigint").select(F.col("__id").alias(id_col), F.col("__fp").alias("fp"))


# ---------------------------------------------------------------- partitions and thresholds


def bit_matrix(fp: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, lowest first."""
    return np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how often each pair of bits is set together (64 x 64), over all rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = bit_matrix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(total.ravel(), n))], ["cell", "n"])

    summed = distinct.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = {r[0]: r[1] for r in summed.collect()}
    return cells.get(BITS * BITS, 0), np.array([cells.get(i, 0) for i in range(BITS * BITS)]).reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray) -> list[list[int]]:
    """Four groups of 16 bits; each grows from a bit by the strongest mean correlation with the group."""
    n = max(n, 1)
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs(together / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    left, groups = set(range(BITS)), []
    while left:
        free = sorted(left)
        group = [free[int(strength[np.ix_(free, free)].sum(axis=1).argmax())]]
        left.remove(group[0])
        while len(group) < WIDTH:
            free = sorted(left)
            group.append(free[int(strength[np.ix_(free, group)].mean(axis=1).argmax())])
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def project(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each fingerprint as one small number."""
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def ball_counts(histogram: np.ndarray, most: int) -> np.ndarray:
    """``[t, v]``: rows whose value is within ``t`` bits of ``v``, from the histogram over all values."""
    exact = [histogram.astype(np.float64)] + [np.zeros(len(histogram)) for _ in range(most)]
    values = np.arange(len(histogram))
    for bit in range(len(histogram).bit_length() - 1):
        for t in range(most, 0, -1):
            exact[t] = exact[t] + exact[t - 1][values ^ (1 << bit)]
    return np.cumsum(exact, axis=0)


def allot(costs: list[np.ndarray], total: int) -> np.ndarray:
    """Thresholds ``[row, partition]`` of least cost that sum up to ``total``, by dynamic programming.

    ``costs[i][t + 1]`` is the cost per row of threshold ``t`` (from -1, which skips the partition).
    """
    rows = costs[0].shape[1]
    best: dict[int, np.ndarray] = {0: np.zeros(rows)}
    choices: list[dict[int, np.ndarray]] = []
    for cost in costs:
        now: dict[int, np.ndarray] = {}
        pick: dict[int, np.ndarray] = {}
        for s, value in best.items():
            for t in range(-1, cost.shape[0] - 1):
                offer = value + cost[t + 1]
                if s + t not in now:
                    now[s + t], pick[s + t] = offer, np.full(rows, t)
                else:
                    better = offer < now[s + t]
                    now[s + t] = np.where(better, offer, now[s + t])
                    pick[s + t] = np.where(better, t, pick[s + t])
        best = now
        choices.append(pick)
    out = np.empty((rows, len(costs)), np.int64)
    state = np.full(rows, total)
    for i in range(len(costs) - 1, -1, -1):
        for s, pick in choices[i].items():
            at = state == s
            out[at, i] = pick[at]
        state = state - out[:, i]
    return out


def masks_within(most: int) -> list[np.ndarray]:
    """``[t]``: all 16-bit masks with at most ``t`` bits."""
    every = np.arange(1 << WIDTH)
    size = np.bitwise_count(every)
    return [every[size <= t] for t in range(most + 1)]


# ---------------------------------------------------------------- probing and verification

INDEX, PROBE = 1, 2


def forest(matrix: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a symmetric adjacency matrix."""
    edges, todo = [], np.ones(len(matrix), bool)
    for root in range(len(matrix)):
        if not todo[root]:
            continue
        todo[root] = False
        front = np.array([root])
        while len(front):
            found = np.flatnonzero(matrix[front].any(axis=0) & todo)
            todo[found] = False
            edges += [(root, int(x)) for x in found]
            front = found
    return edges


def verify(keys: np.ndarray, fp: np.ndarray, role: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys, between a probing and an indexed row of at most ``distance`` bits."""
    left, right = [], []
    start = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    size = np.diff(np.append(start, len(keys)))
    place = np.arange(len(keys)) - np.repeat(start, size)
    room = np.repeat(size, size) - place
    small = np.repeat(size <= 48, size)
    for step in range(1, int(size[size <= 48].max(initial=1))):
        a = np.flatnonzero(small & (room > step))
        b = a + step
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= distance) & (((role[a] & INDEX) & (role[b] >> 1)) | ((role[b] & INDEX) & (role[a] >> 1))).astype(bool)
        left.append(fp[a[near]])
        right.append(fp[b[near]])
    for g in np.flatnonzero(size > 48):
        f, r = fp[start[g] : start[g] + size[g]], role[start[g] : start[g] + size[g]]
        f, back = np.unique(f, return_inverse=True)
        index, probe = np.zeros(len(f), bool), np.zeros(len(f), bool)
        index[back[(r & INDEX) > 0]] = True
        probe[back[(r & PROBE) > 0]] = True
        meets = np.outer(index, probe)
        near = (np.bitwise_count(f[:, None] ^ f[None, :]) <= distance) & (meets | meets.T)
        np.fill_diagonal(near, False)
        for a, b in forest(near):
            left.append(f[a : a + 1])
            right.append(f[b : b + 1])
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints whose components are those of all pairs within ``distance`` bits.

    ``distinct`` has one row per fingerprint in column ``fp`` and should be durable, since it is read several
    times. An empty table gives no edges.
    """
    spark = distinct.sparkSession
    n, together = bit_counts(distinct)
    groups = group_bits(n, together)
    total = distance - PARTS + 1
    if total < -PARTS:
        raise ValueError("distance must not be negative")
    most = max(distance, 0)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            cell = np.concatenate([(i << WIDTH) + project(fp, bits) for i, bits in enumerate(groups)])
            value, count = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], ["cell", "n"])

    sizes = np.zeros(PARTS << WIDTH)
    for row in distinct.select("fp").mapInArrow(parts, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        sizes[row.column(0).to_numpy()] = row.column(1).to_numpy()
    sizes = sizes.reshape(PARTS, 1 << WIDTH)
    known = spark.sparkContext.broadcast((sizes.astype(np.float32), [ball_counts(s, most).astype(np.float32) for s in sizes]))
    refined = bool((sizes > REFINE).any())

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, near = known.value
        masks = masks_within(most)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            value = [project(fp, bits) for bits in groups]
            costs = [np.concatenate([np.zeros((1, len(fp))), near[i][:, v] + np.array([len(m) for m in masks])[:, None]]) for i, v in enumerate(value)]
            threshold = allot(costs, total)
            rows: list[tuple[np.ndarray, ...]] = []
            for i, v in enumerate(value):
                probing = threshold[:, i] >= 0
                rows.append((np.full(len(fp), i), v, fp, np.where(probing, INDEX | PROBE, INDEX)))
                for t in range(1, most + 1):
                    who = np.flatnonzero(threshold[:, i] == t)
                    if len(who):
                        other = masks[t][masks[t] > 0]
                        rows.append((np.full(len(who) * len(other), i), (v[who][:, None] ^ other[None, :]).ravel(), np.repeat(fp[who], len(other)), np.full(len(who) * len(other), PROBE)))
            part, v, f, role = (np.concatenate(x) for x in zip(*rows, strict=True))
            size = held[part, v]
            # A lone index row still meets probes from buckets nearby, unless its whole ball holds nothing else.
            ball = np.stack([near[i][most] for i in range(PARTS)])[part, v]
            alive = (size > 0) & ((role == PROBE) | (ball > 1))
            yield from keyed(part[alive], v[alive], f[alive], role[alive], size[alive])

    def keyed(part: np.ndarray, v: np.ndarray, f: np.ndarray, role: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = (part << WIDTH) + v
        fine = np.zeros(len(key), np.int64)
        if refined:
            # Three differing bits at most leave one of four runs of the other 48 bits equal.
            many = np.flatnonzero(size > REFINE)
            if len(many):
                kept = np.flatnonzero(size <= REFINE)
                pieces = []
                for i in range(PARTS):
                    own = many[part[many] == i]
                    rest = [b for j in range(PARTS) if j != i for b in groups[j]]
                    for j in range(distance + 1):
                        cut = rest[j * len(rest) // (distance + 1) : (j + 1) * len(rest) // (distance + 1)]
                        pieces.append((own, 1 + (j << 48) + project(f[own], cut)))
                at = np.concatenate([kept, *(p[0] for p in pieces)])
                fine = np.concatenate([np.zeros(len(kept), np.int64), *(p[1] for p in pieces)])
                key, f, role, size = key[at], f[at], role[at], np.where(fine > 0, 0, size[at])
        number = np.maximum(1, np.ceil(size / CAP)).astype(np.int64)
        yield from chunked(key, fine, f, role, number)

    def chunked(key: np.ndarray, fine: np.ndarray, f: np.ndarray, role: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of a bucket of several chunks go to each pair of an index chunk and a probe chunk that they belong to."""
        with np.errstate(over="ignore"):
            chunk = ((f * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % number
        one = np.flatnonzero(number == 1)
        pieces = [(one, np.zeros(len(one), np.int64), role[one])]
        for flag in (INDEX, PROBE):
            who = np.flatnonzero((number > 1) & ((role & flag) > 0))
            n = number[who]
            other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = np.repeat(chunk[who], n)
            cell = own * (1 << 24) + other if flag == INDEX else other * (1 << 24) + own
            pieces.append((np.repeat(who, n), cell, np.full(len(cell), flag)))
        at, cell, flag = (np.concatenate(x) for x in zip(*pieces, strict=True))
        for i in range(0, len(at), 50_000):
            cut = at[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(key[cut]), pa.array(fine[cut]), pa.array(cell[i : i + 50_000]), pa.array(f[cut].view(np.int64)), pa.array(flag[i : i + 50_000].astype(np.int64))], ["key", "fine", "cell", "fp", "role"])

    shape = "key bigint, fine bigint, cell bigint, fp bigint, role bigint"
    short_batches(spark)
    rows = distinct.select("fp").mapInArrow(spread, shape)
    if refined:
        # Sizes of refined buckets are counted; those above CAP are cut into chunks like the others.
        crowded = rows.where("fine > 0").groupBy("key", "fine").agg(F.count("*").alias("n")).where(F.col("n") > CAP)
        spare = rows.where("fine > 0").join(crowded, ["key", "fine"], "left").select(*rows.columns, F.coalesce(F.ceil(F.col("n") / CAP), F.lit(1)).cast("bigint").alias("n"))

        def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                key, fine, _, f, role, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
                yield from chunked(key, fine, f.view(np.uint64), role, n)

        rows = rows.where("fine = 0").unionByName(spare.mapInArrow(again, shape))

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None

        def told(keys: np.ndarray, fp: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
            a, b = verify(keys, fp.view(np.uint64), role, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            now = (keys, batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False))
            if rest is not None:
                now = tuple(np.concatenate(x) for x in zip(rest, now, strict=True))
            # The last group may go on in the next batch; groups are at most two chunks long.
            same = (now[0] == now[0][-1]).all(axis=1)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = tuple(x[cut:] for x in now)
            if cut:
                yield told(*(x[:cut] for x in now))
        if rest is not None and len(rest[0]):
            yield told(*rest)

    dealt = rows.repartition(partitions_of(spark), "key", "fine", "cell").sortWithinPartitions("key", "fine", "cell")
    return dealt.mapInArrow(meet, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, distance: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long) and ``component_id``, the smallest id reachable.

    Fingerprints link at ``distance`` or fewer differing bits; equal ones (copies, repeated rows) always do. Null
    and empty texts share fingerprint zero and link like any other. A null id is kept but never names a component;
    a component of null ids only has a null name. Other columns of ``docs`` are not read.
    """
    found = durable(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = durable(found.groupBy("fp").agg(F.min(id_col).alias("least")))
    parts = connected_components(links(distinct, distance))
    named = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(heads, "component").select("fp", "component_id")
    return found.join(classes, "fp").select(id_col, "fp", "component_id")


def fingerprint_hex() -> Column:
    """A signed ``fp`` as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex("fp")), 16, "0")

