"""Removal of repeated substrings with suffix arrays by induced sorting.

A byte goes if a string of ``min_len`` bytes that covers it also starts anywhere else. Each window of ``min_len``
bytes is dealt by its minimizer, the least hash among its grams: equal windows have equal minimizers, so they meet.
A run of windows with one minimizer is a segment. Minimizers are counted first, and segments of those that occur once
are done (a bitmap of fixed size keeps most of them out of the shuffles). Equal segments go on as one with a weight,
whatever the number of copies; one that is alone with its minimizer is repeated as a whole or not at all. The rest,
sorted by minimizer, form shards of bounded size. A shard's suffix array is built by induced sorting (classify
suffixes, name leftmost-smaller substrings, recurse, induce), common prefixes are found in text order (permuted,
irreducible ones by comparison), and windows that share ``min_len`` bytes add up their weights.

A minimizer with more than ``CROWD`` different segments (a short passage that very many texts share in different
surroundings) is not worked on in one shard: its segments are dealt again by longer grams, which reach into the
surroundings, as texts of their own; at the last level each window is dealt by itself, so that nothing is crowded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks_by_bytes, durable, partitions_of, short_batches, text_bytes
from .decontam import window_bitmap

#: Bytes of the grams whose least hash deals a window, at the first level; at the last they are whole windows.
GRAM = 64
#: Bytes of segments in a shard, and different segments of a minimizer that one shard takes.
SHARD, CROWD = 500_000, 250
#: Bits of the bitmap of repeated minimizers (16 MB at any input size). It bears on cost only.
MINIMIZER_BITS = 27
#: Levels of dealing; the last cannot be crowded.
LEVELS = 3
#: Bytes of text that are cut at once; longer texts are cut in overlapping pieces.
BLOCK = 1_000_000
PLACE = 24


# ---------------------------------------------------------------- suffix arrays


def refine(count: int, key_bits: int, key_of: Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Ranks (the number of smaller items) of items that are compared key by key.

    ``key_of(items, k)`` gives the k-th keys, below ``2 ** key_bits``, and whether they are the items' last; items with equal keys
    throughout share a rank. Only items that are still tied are looked at again. Rank and key fit one 63-bit number.
    """
    rank = np.zeros(count, np.int64)
    key, last = key_of(np.arange(count), 0)
    items = np.argsort(key)
    key, last, k = key[items], last[items], 0
    while len(items):
        # Here ``key`` holds the old rank in its high bits and is in order.
        new = np.empty(len(items), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        first = np.flatnonzero(new)
        size = np.diff(first, append=len(items))
        if k == 0:
            rank[items] = np.repeat(first, size)
        else:
            old = key >> key_bits
            group = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            start = np.repeat(group, np.diff(group, append=len(items)))
            rank[items] = old + np.repeat(first, size) - start
        tied = np.repeat(size > 1, size)
        tied &= ~last
        items = items[tied]
        if not len(items):
            break
        k += 1
        key, last = key_of(items, k)
        key |= rank[items] << key_bits
        order = np.argsort(key)
        items, key, last = items[order], key[order], last[order]
    return rank


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of a sequence of positive integers, by induced sorting.

    The bucket scans of the classic algorithm are replaced by sorts that numpy runs over all suffixes of a type: a
    suffix is placed by the symbols of its monotone run and the rank of the suffix at the run's end, which is what
    scanning induces one by one.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    x = np.append(text, 0).astype(np.int64)
    # Types: S before a greater symbol (or an equal one of type S), L before a smaller one.
    differs = x[:-1] != x[1:]
    following = np.flatnonzero(differs)[np.cumsum(differs) - differs]
    small = np.append(x[following] < x[following + 1], True)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    symbol = 2 * x + small + 1
    bits = int(symbol.max()).bit_length()
    per = max(1, (63 - n.bit_length()) // bits)
    key_bits = max(bits * per, n.bit_length())
    ahead = np.zeros(n + 1, np.int64)  # the next ``per`` symbols of every suffix, in one number
    for j in range(min(per, n + 1)):
        ahead[: n + 1 - j] |= symbol[j:] << (bits * (per - 1 - j))

    def packed(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``per`` symbols from ``begin``, nothing after ``end``."""
        drop = bits * np.clip(begin + (per - 1) - end, 0, per)
        return ahead[np.minimum(begin, n)] >> drop << drop

    def by_substring(items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        begin, end = lms[items] + k * per, ends[items]
        return packed(begin, end), begin + per > end

    # Leftmost-smaller substrings, both ends included, get names in their order; equal ones share a name.
    ends = np.append(lms[1:], n)
    name = refine(len(lms), key_bits, by_substring)
    used = np.unique(name)
    if len(used) == len(lms):
        order = name
    else:
        reduced = np.searchsorted(used, name)  # the sentinel alone is 0
        order = np.zeros(len(lms), np.int64)
        order[suffix_array(reduced[:-1])] = np.arange(1, len(lms))
    ranks = np.zeros(n + 1, np.int64)
    ranks[lms] = order

    def by_run(of: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Ranks of suffixes ``of``, whose runs end at the already ranked suffixes ``to``."""

        def key_of(items: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
            begin, end = of[items] + k * per, to[items]
            done = begin > end
            return np.where(done, ranks[end], packed(begin, end)), done

        return refine(len(of), key_bits, key_of)

    large = np.flatnonzero(~small)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    large_rank = by_run(large, lms[np.cumsum(is_lms)[large]])
    ranks[large] = large_rank
    rising = np.flatnonzero(small[:-1])
    rising_rank = by_run(rising, large[np.cumsum(~small)[rising]])
    sorted_ = np.empty(n, np.int64)
    first, second = np.empty(len(large), np.int64), np.empty(len(rising), np.int64)
    first[large_rank], second[rising_rank] = large, rising
    both = np.concatenate((first, second))
    sorted_[:] = both[np.argsort(symbol[both], kind="stable")]
    return sorted_


def common_prefixes(data: bytes, array: np.ndarray) -> np.ndarray:
    """For each place of the suffix array, the bytes that its suffix shares with the one before.

    Computed in text order: where the suffix and its predecessor have the same byte before them, the value is one
    less than that of the suffix before (reducible); the others are compared, eight bytes at a time.
    """
    n = len(array)
    if not n:
        return np.empty(0, np.int64)
    raw = np.frombuffer(data + bytes(16), np.uint8)
    words = np.ndarray((n + 9,), "<u8", raw, strides=(1,))
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    i = np.arange(n)
    reducible = (i > 0) & (before > 0)
    reducible[reducible] = raw[i[reducible] - 1] == raw[before[reducible] - 1]
    # A suffix can hang on the one before only if that one has a predecessor of its own.
    reducible[1:] &= before[:-1] >= 0
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(~reducible & (before >= 0))
    at = np.zeros(len(live), np.int64)
    while len(live):
        a, b = live + at, before[live] + at
        room = n - np.maximum(a, b)
        x = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8).astype(np.int64)
        got = np.minimum(same, np.maximum(room, 0))
        at += got
        shared[live] = at
        on = (got == 8) & (room > 8)
        live, at = live[on], at[on]
    last = np.maximum.accumulate(np.where(~reducible, i, 0))
    shared = np.maximum(shared[last] - (i - last), 0)
    return shared[array]


def repeated_windows(segments: list[bytes], windows: np.ndarray, weight: np.ndarray, min_len: int) -> list[list[int]]:
    """For each segment, the runs ``[begin, end, ...]`` of its first ``windows`` starts whose ``min_len`` bytes weigh 2 or more."""
    data = b"".join(segments)
    array = suffix_array(np.frombuffer(data, np.uint8).astype(np.int64) + 1)
    group = np.empty(len(data), np.int64)
    group[array] = np.cumsum(common_prefixes(data, array) < min_len)
    size = np.array([len(s) for s in segments], np.int64)
    first = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(segments)), windows)
    inside = np.arange(len(owner)) - first[owner]
    of = group[(np.cumsum(size) - size)[owner] + inside]
    again = np.bincount(of, weight[owner])[of] >= 2
    new = inside == 0
    begin = np.flatnonzero(again & (np.concatenate(([True], ~again[:-1])) | new)) if len(again) else np.empty(0, np.int64)
    end = np.flatnonzero(again & (np.concatenate((~again[1:], [True])) | np.concatenate((new[1:], [True])))) + 1 if len(again) else np.empty(0, np.int64)
    out: list[list[int]] = [[] for _ in segments]
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        k = int(owner[b])
        out[k] += [b - int(first[k]), e - int(first[k])]
    return out


# ---------------------------------------------------------------- dealing windows


def gram_of(level: int, min_len: int) -> int:
    """Bytes of the grams of a level."""
    first = min(GRAM, min_len)
    return first + (min_len - first) * level // (LEVELS - 1)


def gram_hashes(data: bytes, gram: int, seed: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (8 or more) from every place on; those of twice the length come from two halves."""
    raw = np.frombuffer(data + bytes(8), np.uint8)
    h = np.ndarray((len(data) - 7,), "<u8", raw, strides=(1,)) ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    width = 8

    def joined(step: int) -> np.ndarray:
        out = h[: len(h) - step] * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        out += h[step:]
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(32)
        return out

    with np.errstate(over="ignore"):
        while width * 2 <= gram:
            h, width = joined(width), width * 2
        h = joined(gram - width) if gram > width or gram == 8 else h
    return h


def cut(texts: list[bytes], min_len: int, gram: int, seed: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and the segments of short texts: their places, windows and minimizer hashes, the texts' numbers, and the offsets in them."""
    span = min_len - gram + 1
    data = b"".join(texts)
    if len(data) < min_len:
        return (data, *(np.empty(0, np.int64) for _ in range(5)))
    h = gram_hashes(data, gram, seed)
    # The place in the low bits breaks ties alike in all equal windows: the last of equal grams wins.
    low = np.uint64((1 << PLACE) - 1)
    least = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    size = np.array([len(t) for t in texts], np.int64)
    offset = np.cumsum(size) - size
    long = size >= min_len
    step = np.zeros(len(data) + 2, np.int64)
    step[offset[long]] += 1
    np.add.at(step, offset[long] + size[long] - min_len + 1, -1)
    valid = np.cumsum(step)[: len(least)] > 0
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[offset[long]] = True
    begin = np.flatnonzero(new & valid)
    stops = np.append(np.flatnonzero(new | ~valid), len(least))
    windows = stops[np.searchsorted(stops, begin) + 1] - begin
    hv = h[(low - (least[begin] & low)).astype(np.int64)].view(np.int64)
    # Empty texts share an offset with the next; the last of them is the one that holds bytes.
    owner = np.searchsorted(offset, begin, side="right") - 1
    return data, begin, windows, hv, owner, begin - offset[owner]


def pieces_of(batches: Iterable[pa.RecordBatch], min_len: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """Keys, weights, pieces of texts and their offsets, in bounded amounts; very long texts are cut so that no window is in two pieces."""

    def told(rows: list[tuple]) -> tuple:
        k, t, weight, parts, shift = zip(*rows, strict=True)
        return np.array(k, np.int64), np.array(t, np.int64), np.array(weight, np.int64), list(parts), np.array(shift, np.int64)

    step = 4 * BLOCK
    for part in chunks_by_bytes(batches, "text", BLOCK):
        rows: list[tuple] = []
        for k, t, w, text in zip(*(part.column(c).to_pylist() for c in ("k", "t", "weight", "text")), strict=True):
            if len(text) <= step:
                rows.append((k, t, w, text, 0))
                continue
            for s in range(0, len(text) - min_len + 1, step):
                yield told([(k, t, w, text[s : s + step + min_len - 1], s)])
        if rows:
            yield told(rows)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed) a bitmap of ``window_bitmap`` holds."""
    cell = (hashes.view(np.uint64) >> np.uint64(64 - (len(bitmap).bit_length() + 2))).astype(np.int64)
    return ((bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)


def repeated_minimizers(texts: DataFrame, min_len: int, level: int) -> np.ndarray:
    """A bitmap that holds every minimizer of weight 2 or more."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, weight, parts, _ in pieces_of(batches, min_len):
            _, _, _, hv, owner, _ = cut(parts, min_len, gram_of(level, min_len), level)
            yield pa.RecordBatch.from_arrays([pa.array(hv), pa.array(weight[owner])], ["hash", "weight"])

    counted = texts.mapInArrow(block, "hash bigint, weight bigint").groupBy("hash").agg(F.sum("weight").alias("weight"))
    return window_bitmap(counted.where("weight > 1"), MINIMIZER_BITS)


def segments_of(texts: DataFrame, min_len: int, level: int, bitmap: np.ndarray) -> DataFrame:
    """``(hv, ch, k, t, at, weight)`` for each segment whose minimizer the bitmap holds; ``at`` is its offset and windows in one number."""
    known = texts.sparkSession.sparkContext.broadcast(bitmap)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for k, t, weight, parts, shift in pieces_of(batches, min_len):
            data, begin, windows, hv, owner, off = cut(parts, min_len, gram_of(level, min_len), level)
            some = np.flatnonzero(in_bitmap(known.value, hv))
            begin, windows, hv, owner, off = (x[some] for x in (begin, windows, hv, owner, off))
            view = memoryview(data)
            ch = np.array([digest(view[a:b], level) for a, b in zip(begin.tolist(), (begin + windows + min_len - 1).tolist(), strict=True)], np.uint64).view(np.int64)
            columns = (hv, ch, k[owner], t[owner], (off + shift[owner]) << 16 | windows, weight[owner])
            for i in range(0, len(hv), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in columns], names)

    names = ["hv", "ch", "k", "t", "at", "weight"]
    return texts.select("k", "t", "weight", "text").mapInArrow(block, ", ".join(f"{c} bigint" for c in names))


#: Offset and windows of a segment; ``min_len`` is below 65,536.
OFF, WINDOWS = "shiftright(at, 16)", "at & 65535L"


def contents_of(texts: DataFrame, wanted: DataFrame, min_len: int) -> DataFrame:
    """``(hv, ch, windows, weight, text)`` of the wanted segments, read from the texts that represent them."""
    lists = wanted.groupBy("k", "t").agg(F.collect_list(F.struct("hv", "ch", F.expr(OFF).alias("off"), F.expr(WINDOWS).alias("windows"), "weight")).alias("list"))
    known = texts.sparkSession.sparkContext.broadcast(window_bitmap(wanted.select(F.xxhash64("k", "t").alias("hash"))))

    def held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(known.value, batch.column(3).to_numpy())))

    some = texts.select("k", "t", "text", F.xxhash64("k", "t").alias("hash")).mapInArrow(held, "k bigint, t bigint, text binary, hash bigint")
    met = some.groupBy("k", "t").agg(F.first("text").alias("text")).join(lists, ["k", "t"]).select("text", "list")

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_by_bytes(batches, "text", BLOCK):
            rows = [(s["hv"], s["ch"], s["windows"], s["weight"], t[s["off"] : s["off"] + s["windows"] + min_len - 1]) for t, ss in zip(part.column("text").to_pylist(), part.column("list").to_pylist(), strict=True) for s in ss]
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())], ["hv", "ch", "windows", "weight", "text"])

    return met.mapInArrow(block, "hv bigint, ch bigint, windows bigint, weight bigint, text binary")


def shard_runs(contents: DataFrame, min_len: int) -> DataFrame:
    """``(hv, ch, runs)``: repeated windows of each segment, from the suffix arrays of the shards."""

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def told() -> pa.RecordBatch:
            hv, ch, windows, weight, text = zip(*held, strict=True)
            runs = repeated_windows(list(text), np.array(windows), np.array(weight), min_len)
            some = [i for i, r in enumerate(runs) if r]
            return pa.RecordBatch.from_arrays([pa.array([hv[i] for i in some], pa.int64()), pa.array([ch[i] for i in some], pa.int64()), pa.array([runs[i] for i in some], pa.list_(pa.int32()))], ["hv", "ch", "runs"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if size >= SHARD and row[0] != held[-1][0]:
                    yield told()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield told()

    dealt = contents.repartition(partitions_of(contents.sparkSession), "hv").sortWithinPartitions("hv", "ch")
    return dealt.mapInArrow(block, "hv bigint, ch bigint, runs array<int>")


def repeated_runs(texts: DataFrame, min_len: int, level: int = 0) -> DataFrame:
    """``(k, t, off, runs)``: runs of repeated window starts in the segment at ``off`` of the text ``(k, t)``.

    ``texts`` has two longs ``k`` and ``t`` that name the text, ``text`` (binary) and ``weight``, the copies that a row stands for.
    """
    rows = durable(segments_of(texts, min_len, level, repeated_minimizers(texts, min_len, level)))
    distinct = rows.groupBy("hv", "ch").agg(F.sum("weight").alias("weight"), *(F.first(c).alias(c) for c in ("k", "t", "at")))
    totals = distinct.groupBy("hv").agg(F.sum("weight").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    wanted = durable(distinct.join(totals, "hv").drop("total"))
    # A segment that is alone with its minimizer, two copies at least, is repeated as a whole.
    runs = wanted.where("kinds = 1").select("hv", "ch", F.array(F.lit(0), F.expr(WINDOWS).cast("int")).alias("runs"))
    crowded = (F.col("kinds") > CROWD) if level + 1 < LEVELS else F.lit(False)
    runs = runs.unionByName(shard_runs(contents_of(texts, wanted.where((F.col("kinds") > 1) & ~crowded), min_len), min_len))
    if not wanted.where(crowded).isEmpty():
        # A segment's two hashes name it as a text of its own.
        again = durable(contents_of(texts, wanted.where(crowded), min_len).select(F.col("ch").alias("k"), F.col("hv").alias("t"), "text", "weight"))
        finer = repeated_runs(again, min_len, level + 1).select(F.col("t").alias("hv"), F.col("k").alias("ch"), F.transform("runs", lambda r: (r + F.col("off")).cast("int")).alias("runs"))
        runs = runs.unionByName(finer.groupBy("hv", "ch").agg(F.flatten(F.collect_set("runs")).alias("runs")))
    return rows.select("hv", "ch", "k", "t", F.expr(OFF).alias("off")).join(durable(runs), ["hv", "ch"]).select("k", "t", "off", "runs")


# ---------------------------------------------------------------- operator


def merged(lists: list[dict], min_len: int, size: int) -> list[tuple[int, int]]:
    """Maximal byte spans that the repeated windows of all segments cover."""
    spans = sorted((s["off"] + b, min(size, s["off"] + e - 1 + min_len)) for s in lists for b, e in zip(s["runs"][::2], s["runs"][1::2], strict=True))
    out: list[tuple[int, int]] = []
    for b, e in spans:
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def id_key(id_col: str, whole: bool) -> Column:
    """A long for a row's id: an integer id itself, else a hash (null among them); a hash of the text stands beside it."""
    hashed = F.xxhash64(F.lit(id_col), F.col(id_col))
    return F.coalesce(F.col(id_col).cast("bigint"), hashed) if whole else hashed


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 200) -> DataFrame:
    """``(id, kept, n_bytes, n_removed, n_spans, spans)`` for each row: the UTF-8 bytes that stay, as binary.

    Matches never cross rows, overlapping occurrences count, and strings are judged on the input. Null is empty;
    texts shorter than ``min_len`` stay. Repeated rows are occurrences of each other; rows of one id may have
    different texts, and ids may be null. ``spans`` lists removed byte ranges ``[begin, end)``. An empty table gives
    none; other columns are not read.
    """
    if not 8 <= min_len < 1 << 16:
        raise ValueError("min_len must be from 8 to 65,535")
    short_batches(docs.sparkSession)
    text = text_bytes(text_col)
    whole = isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    rows = docs.select(F.col(id_col).alias("__id"), id_key(id_col, whole).alias("k"), F.xxhash64(text).alias("t"), text.alias("text"), F.lit(1).cast("bigint").alias("weight"))
    runs = repeated_runs(rows.drop("__id"), min_len)
    spans = runs.groupBy("k", "t").agg(F.collect_set(F.struct("off", "runs")).alias("list"))
    met = rows.join(spans, ["k", "t"], "left").select("__id", "text", "list")
    kind = rows.schema["__id"].dataType.simpleString()

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_by_bytes(batches, "text", 4 * BLOCK):
            texts = part.column("text").to_pylist()
            gone = [merged(s, min_len, len(t)) if s else [] for t, s in zip(texts, part.column("list").to_pylist(), strict=True)]
            kept = []
            for t, g in zip(texts, gone, strict=True):
                at, pieces = 0, []
                for b, e in g:
                    pieces.append(t[at:b])
                    at = e
                kept.append(b"".join([*pieces, t[at:]]) if g else t)
            numbers = ([len(t) for t in texts], [sum(e - b for b, e in g) for g in gone], [len(g) for g in gone])
            yield pa.RecordBatch.from_arrays([part.column("__id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in numbers), pa.array([[list(x) for x in g] for g in gone], pa.list_(pa.list_(pa.int64())))], names)

    names = ["__id", "kept", "n_bytes", "n_removed", "n_spans", "spans"]
    return met.mapInArrow(block, f"__id {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<array<bigint>>").withColumnRenamed("__id", id_col)
