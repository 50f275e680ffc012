"""Training-order token output.

Every token sequence gets a number, a keyed Feistel permutation with cycle-walking scatters the numbers, and the
sequences stand in the order of the result: their ranks are the global slots. The permuted numbers are cut into
ranges, and each range is one shard: a file of records of fixed stride, written in slot order. A reader finds any slot
by the first slots of the shards and arithmetic, so it can resume at any step and read sequentially.

Numbers follow the documents' keys (id, then text), not files or partitions, so the order is the same on every
cluster. A document has as many numbers as sequences that its bytes allow at most, which is known without its tokens;
numbers that stay unused leave no gap in the slots. So texts are tokenized once and tokens are shuffled once, to
their shards. First numbers travel as one small file per input partition, with a hash of each text that is checked
when it is read: a changed partitioning is an error and never a wrong slot. Shards are written under a temporary name
and renamed: a repeated or lost task leaves no half-written file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, durable, partitions_of, shared_dir, short_batches
from .tokens import DEFAULT_RANKS, encoding, end_of_text

BLOCK = 2_000_000
ROUNDS = 4
#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
ROW_BITS = 33


# ---------------------------------------------------------------- permutation


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def feistel(number: np.ndarray, total: int, key: int) -> np.ndarray:
    """A keyed permutation of ``0 .. total - 1``.

    A balanced Feistel network permutes the smallest even number of bits that holds ``total``; values beyond it
    walk on along their cycle until they fall inside, which keeps the whole a permutation.
    """
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = number.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * ROUNDS + r + 1) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


# ---------------------------------------------------------------- files


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder's URI; ``file:/x`` and plain paths are local or mounted folders."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.bin"


def read_manifest(uri: str) -> dict:
    """The manifest of a written folder: sequences, stride, tokens per sequence, shards, key."""
    fs, folder = filesystem(uri)
    with fs.open_input_stream(f"{folder}/manifest.json") as f:
        return json.loads(f.read())


def first_slots(uri: str) -> np.ndarray:
    """The first slot of each shard of a written folder, and the number of slots at the end."""
    fs, folder = filesystem(uri)
    with fs.open_input_stream(f"{folder}/first_slots.bin") as f:
        return np.frombuffer(f.read(), "<i8")


def read_slots(uri: str, start: int = 0, stop: int | None = None) -> Iterator[np.ndarray]:
    """Token records of the slots ``start .. stop - 1`` in order, from the shards of a written folder."""
    about, first = read_manifest(uri), first_slots(uri)
    fs, folder = filesystem(uri)
    stop = about["sequences"] if stop is None else min(stop, about["sequences"])
    stride = about["stride"]
    while start < stop:
        shard = int(np.searchsorted(first, start, side="right")) - 1
        end = min(stop, int(first[shard + 1]))
        with fs.open_input_file(shard_path(folder, shard)) as f:
            f.seek((start - int(first[shard])) * stride)
            data = np.frombuffer(f.read((end - start) * stride), "<u2").reshape(-1, about["length"])
        yield from data
        start = end


# ---------------------------------------------------------------- operator


def number_rows(rows: DataFrame, length: int, folder_uri: str) -> int:
    """Write the first number of each row's sequences to one file per partition of ``rows``; returns how many numbers there are.

    ``rows`` has ``__id``, ``__text`` and ``__hash``. Rows go by id and text; equal rows have sequences that nothing tells apart.
    """
    spark = rows.sparkSession
    most = F.floor(F.octet_length("__text") / length).cast("bigint") + 1  # a token has a byte at least, and the end token is one
    keyed = rows.select("__id", "__hash", F.xxhash64(F.lit(7), "__text").alias("h2"), most.alias("most"), F.monotonically_increasing_id().alias("row"))
    order = ["__id", "__hash", "h2", "row"]
    keyed = durable(keyed.repartitionByRange(partitions_of(spark), *order).sortWithinPartitions(*order).select("__hash", "most", "row"))
    sums = dict(sorted(tuple(r) for r in keyed.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("most")).collect()))
    begin = dict(zip(sums, np.cumsum([0, *sums.values()])[:-1].tolist(), strict=True))

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = begin.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            if batch.num_rows:
                most_ = batch.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(at + np.cumsum(most_) - most_), batch.column(0)], ["row", "first", "hash"])
                at += int(most_.sum())

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(folder_uri)
        out, part = None, -1
        for batch in batches:
            parts = batch.column(0).to_numpy() >> ROW_BITS
            for cut in np.split(np.arange(len(parts)), np.flatnonzero(parts[1:] != parts[:-1]) + 1):
                if not len(cut):
                    continue
                if parts[cut[0]] != part:
                    if out is not None:
                        out.close()
                        fs.move(name, f"{folder}/numbers-{part}.bin")
                    part = int(parts[cut[0]])
                    name = f"{folder}/.numbers-{part}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(name)
                out.write(np.stack([batch.column(i).to_numpy()[cut] for i in (1, 2)], axis=1).astype("<i8").tobytes())
        if out is not None:
            out.close()
            fs.move(name, f"{folder}/numbers-{part}.bin")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["done"])

    numbered = keyed.mapInArrow(first, "row bigint, first bigint, hash bigint")
    numbered = numbered.withColumn("part", F.shiftright("row", ROW_BITS)).repartition(partitions_of(spark), "part").sortWithinPartitions("row").select("row", "first", "hash")
    numbered.mapInArrow(write, "done bigint").count()
    return sum(sums.values())


def write_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 256, key: int = 2024, shard_bytes: int = 16 << 20, ranks: str = DEFAULT_RANKS, out_dir: str | None = None) -> DataFrame:
    """Write every token sequence of ``docs`` to its slot; one result row per sequence.

    Columns: the id, ``seq`` (within the document), ``n_tokens``, ``slot``, ``shard``, ``byte_offset`` and
    ``record_crc32``, the checksum of the stored record as read back from its file. A document's tokens and an end
    token are cut into sequences of ``length``; the last is padded with end tokens. Null and empty texts are one
    sequence with the end token alone; repeated rows are stored as often as they occur; an empty table gives no
    row and a manifest of no sequences. Token ids take 16 bits, so the vocabulary must have fewer than 65,536. A
    shard has at most ``shard_bytes``; slots depend on ids, texts, ``length`` and ``key`` alone. Other columns are not read.

    ``docs`` must keep its partitioning between two passes, as file scans and checkpointed tables do. Files are
    written at once, to ``out_dir`` (a new folder in the shared checkpoint folder by default).
    """
    if end_of_text(ranks) > 0xFFFF:
        raise ValueError("token ids must fit 16 bits")
    spark = docs.sparkSession
    short_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("__hash"))
    kind = rows.schema["__id"].dataType.simpleString()
    out_uri = out_dir or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    fs, folder = filesystem(out_uri)
    fs.create_dir(folder, recursive=True)
    numbers = number_rows(rows, length, out_uri)
    stride = 2 * length
    per_shard = max(1, shard_bytes // stride)
    shards = -(-numbers // per_shard)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(out_uri)
        known, at = None, 0
        enc, end = encoding(ranks), end_of_text(ranks)
        for part in chunks_by_bytes(batches, "__text", BLOCK):
            if known is None:
                with fs.open_input_stream(f"{folder}/numbers-{TaskContext.get().partitionId()}.bin") as f:
                    known = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
            if not np.array_equal(known[at : at + part.num_rows, 1], part.column("__hash").to_numpy()):
                raise RuntimeError("the input's partitioning changed between the two passes; checkpoint it first")
            tokens = [np.array(enc.encode_ordinary(t) + [end], "<u2") for t in part.column("__text").to_pylist()]
            size = np.array([len(t) for t in tokens])
            pieces = -(-size // length)
            row = np.repeat(np.arange(len(pieces)), pieces)
            seq = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            permuted = feistel(known[at + row, 0] + seq, numbers, key)
            at += part.num_rows
            # All sequences but the last of a document are full, so their ends follow from the sizes.
            ends = np.minimum((seq + 1) * length, size[row]) + np.repeat(np.cumsum(size) - size, pieces)
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(np.append(0, 2 * ends).astype("<i4").tobytes()), pa.py_buffer(np.concatenate(tokens).tobytes())])
            yield pa.RecordBatch.from_arrays([part.column("__id").take(pa.array(row)), pa.array(seq), pa.array(permuted), pa.array((permuted // per_shard).astype(np.int32)), ids], ["__id", "seq", "permuted", "shard", "ids"])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(out_uri)
        end = end_of_text(ranks)
        told: list[pa.RecordBatch] = []
        out = name = shard = None

        def closed() -> Iterator[pa.RecordBatch]:
            out.close()
            fs.move(name, shard_path(folder, shard))
            place_ = 0
            with fs.open_input_stream(shard_path(folder, shard)) as f:
                for b in told:
                    data = memoryview(f.read(b.num_rows * stride))
                    crc = [zlib.crc32(data[k : k + stride]) for k in range(0, len(data), stride)]
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, shard, np.int64)), pa.array(np.arange(place_, place_ + b.num_rows)), pa.array(crc, pa.int64())], names)
                    place_ += b.num_rows

        for batch in batches:
            of = batch.column(3).to_numpy()
            for cut in np.split(np.arange(len(of)), np.flatnonzero(of[1:] != of[:-1]) + 1):
                if not len(cut):
                    continue
                if of[cut[0]] != shard:
                    if out is not None:
                        yield from closed()
                    told, shard = [], int(of[cut[0]])
                    name = f"{folder}/.{shard:06d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(name)
                piece = batch.slice(int(cut[0]), len(cut))
                ids = piece.column(4)
                ends = np.frombuffer(ids.buffers()[1], "<i4")[ids.offset : ids.offset + len(ids) + 1].astype(np.int64) // 2
                size = np.diff(ends)
                records = np.full((len(ids), length), end, "<u2")
                data = np.frombuffer(ids.buffers()[2], "<u2")[ends[0] : ends[-1]]
                records[np.arange(length) < size[:, None]] = data
                out.write(records.tobytes())
                told.append(pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(size)], ["__id", "seq", "n_tokens"]))
        if out is not None:
            yield from closed()

    names = ["__id", "seq", "n_tokens", "shard", "place", "record_crc32"]
    placed = rows.mapInArrow(place, f"__id {kind}, seq bigint, permuted bigint, shard int, ids binary")
    dealt = placed.repartitionById(max(1, shards), "shard").sortWithinPartitions("permuted")
    made = durable(dealt.mapInArrow(write, f"__id {kind}, seq bigint, n_tokens bigint, shard bigint, place bigint, record_crc32 bigint"))
    counts = np.zeros(shards + 1, np.int64)
    for r in made.groupBy("shard").agg(F.count("*").alias("n")).collect():
        counts[r["shard"] + 1] = r["n"]
    first = np.cumsum(counts)
    with fs.open_output_stream(f"{folder}/first_slots.bin") as f:
        f.write(first.astype("<i8").tobytes())
    with fs.open_output_stream(f"{folder}/manifest.json") as f:
        f.write(json.dumps({"sequences": int(first[-1]), "length": length, "stride": stride, "shards": shards, "shard_bytes": per_shard * stride, "key": key, "dtype": "<u2"}).encode())
    begin = spark.createDataFrame(pa.table({"__shard": pa.array(np.arange(shards)), "__first": pa.array(first[:-1])})).select("*") if shards else None
    if begin is None:
        return made.select(F.col("__id").alias(id_col), "seq", "n_tokens", F.lit(0).cast("bigint").alias("slot"), "shard", F.col("place").alias("byte_offset"), "record_crc32")
    return made.join(begin, F.col("shard") == F.col("__shard")).select(
        F.col("__id").alias(id_col), "seq", "n_tokens", (F.col("__first") + F.col("place")).alias("slot"), "shard", (F.col("place") * stride).alias("byte_offset"), "record_crc32"
    )
