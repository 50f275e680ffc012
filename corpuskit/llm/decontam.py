"""Benchmark decontamination by template canonicalisation.

Words become literals or typed placeholders (number, unit, name). Windows of five words of every document, as they
are and as templates, pass a bitmap of all benchmark windows, built over the whole benchmark at a fixed size, and the
survivors are hash-joined with the benchmark's windows. A shorter item is one window. Windows of the words themselves
match whatever the words are; template windows need some literals. Template windows of a document and an item that
lie on one diagonal must fill the item's slots consistently: a document value that does not have the majority of the
places of an item value spoils the template windows that hold it. A document leaks an item if matching windows cover
enough of it, with the item's own values (``exact``) or with others (``reparameterised``).

The bitmap passes windows that match and a small share of others, so the shuffle holds matches, not texts. A
passage that a third of all documents hold meets few benchmark rows in an equi-join that adaptive execution can
split; further grouping is by document.
"""

from __future__ import annotations

import itertools
from collections.abc import Collection, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, durable, shielded, short_batches, text_bytes, unshielded

# Units of measure that count as one kind of slot.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce
ounces ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h hr hrs
hour hours day days week weeks month months year years % percent $ € £ dollar dollars euro euros cent cents mph kph km/h hz khz mhz ghz w kw
v kv a j kj cal kcal k c f degree degrees acre acres hectare hectares
""".split()
LITERAL, NUMBER, UNIT, NAME = range(4)
#: Windows of words and of template words have hashes of their own.
OWN, TEMPLATE = 0x5851F42D4C957F2D, 0
STRIP = ".,;:!?\"'()[]{}<>*&#%$|“”‘’«»„…"
#: Bits of the bitmap; its size (2 MB) does not depend on the benchmark.
BITMAP_BITS = 24
#: Words kept in a worker's cache of word codes before it starts afresh.
CACHE = 400_000
BLOCK = 1_000_000


def code_of(form: str) -> int:
    """62 bits of a word form."""
    return xxhash.xxh3_64_intdigest(form.encode("utf-8", "surrogatepass")) >> 2


KIND_CODE = {NUMBER: code_of("\0number"), UNIT: code_of("\0unit"), NAME: code_of("\0name")}
#: Flags of a word without its context, above the two bits of its kind.
TITLE, ENDS = 4, 8


def normal_form(word: str) -> str:
    """A word without marks at its ends, in lower case; a word of marks alone stays."""
    return (word.strip(STRIP) or word).lower()


def word_flags(word: str) -> int:
    """Kind (a unit is one only behind a number) and whether the word is capitalised or ends a sentence."""
    if word.isalpha() and word.islower():
        return UNIT if word in UNITS_SET else LITERAL
    bare = word.strip(STRIP)
    ends = ENDS if word.rstrip("\"'”’»)]")[-1:] in (".", "!", "?") else 0
    digits = bare.lstrip("+-$€£").rstrip("%")
    if digits[:1].isdigit() and all(ch.isdigit() or ch in ".,/:-" for ch in digits):
        return NUMBER | ends
    if (bare or word).lower() in UNITS_SET:
        return UNIT | ends
    return LITERAL | ends | (TITLE if len(bare) > 1 and bare[0].isupper() and bare[1:].islower() else 0)


UNITS_SET = frozenset(UNITS)


class Coder(dict):
    """Words as row numbers of two arrays: 62-bit codes of their normal forms, and flags. Bounded in size."""

    def __init__(self) -> None:
        super().__init__()
        self.codes, self.flags = np.zeros(1024, np.uint64), np.zeros(1024, np.int8)

    def __missing__(self, word: str) -> int:
        k = len(self)
        if k == len(self.codes):
            self.codes, self.flags = np.concatenate((self.codes, self.codes)), np.concatenate((self.flags, self.flags))
        self.codes[k], self.flags[k] = code_of(normal_form(word)), word_flags(word)
        self[word] = k
        return k

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes and flags of words."""
        if len(self) > CACHE:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.codes[at], self.flags[at]


def template(words: list[str], counts: np.ndarray, coder: Coder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own codes, template codes and kinds of the words of several texts, one after the other.

    A capitalised word inside a sentence is a name, and a unit is one only right behind a number.
    """
    said, flags = coder.look_up(words)
    code = said.copy()
    kind = (flags & 3).astype(np.int64)
    first = np.zeros(len(words), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    before_ends, before_number = np.ones(len(words), bool), np.zeros(len(words), bool)
    before_ends[1:], before_number[1:] = (flags[:-1] & ENDS) > 0, kind[:-1] == NUMBER
    kind[(kind == UNIT) & (first | ~before_number)] = LITERAL
    kind[((flags & TITLE) > 0) & ~first & ~before_ends] = NAME
    for k, value in KIND_CODE.items():
        code[kind == k] = value
    return said, code, kind


def windows(code: np.ndarray, kind: np.ndarray, counts: np.ndarray, width: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows inside one text with at least ``literals`` literal words."""
    n = len(code) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = reduce(lambda a, j: a * np.uint64(0x9E3779B97F4A7C15) + code[j : j + n], range(width), np.zeros(n, np.uint64))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    said = np.concatenate(([0], np.cumsum(kind == LITERAL)))
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero((said[width:] - said[:-width] >= literals) & (owner[:n] == owner[width - 1 :]))
    return at, h[at]


def text_windows(rows: DataFrame, width: int, literals: int, short: Collection[int] = (), bitmap: np.ndarray | None = None, whole: bool = False) -> DataFrame:
    """``(key, hash, pos, size, n_words, places, slots)`` per window of each row (``key``, ``text``).

    A window of the words themselves has no slots. One of template words has ``literals`` literal words at least, its
    other words as ``kind:value`` in ``slots`` and their positions in ``places``. Besides ``width`` words, windows have
    the sizes in ``short``, or with ``whole`` just one window holds all words of a text of fewer than ``width``. With a
    bitmap, only windows whose hash it holds are returned.
    """
    short_batches(rows.sparkSession)
    known = None if bitmap is None else rows.sparkSession.sparkContext.broadcast(bitmap)
    kind_of_key = rows.schema["key"].dataType
    sizes = [width, *(range(1, width) if whole else sorted(short))]

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for part in chunks_by_bytes(batches, "text", BLOCK):
            lists = [data.decode("utf-8", "replace").split() for data in part.column("text").to_pylist()]
            counts = np.array([len(x) for x in lists], np.int64)
            words = list(itertools.chain.from_iterable(lists))
            said, code, kind = template(words, counts, coder)
            first, owners = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
            for size in sizes:
                for form in (OWN, TEMPLATE):
                    at, h = windows(said if form == OWN else code, kind, counts, size, 0 if form == OWN else literals)
                    h ^= np.uint64(form)
                    if whole and size < width:
                        all_ = counts[owners[at]] == size
                        at, h = at[all_], h[all_]
                    if known is not None:
                        cell = (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                        hit = (known.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
                        at, h = at[hit > 0], h[hit > 0]
                    if not len(at):
                        continue
                    owner = owners[at]
                    places = [[k for k in range(p, p + size) if form == TEMPLATE and kind[k] != LITERAL] for p in at.tolist()]
                    slots = [[f"{kind[k]}:{normal_form(words[k])}" for k in x] for x in places]
                    places = [[k - f for k in x] for x, f in zip(places, first[owner].tolist(), strict=True)]
                    columns = [
                        part.column("key").take(pa.array(owner)), pa.array(h.view(np.int64)), pa.array(at - first[owner]), pa.array(np.full(len(at), size, np.int64)),
                        pa.array(counts[owner]), pa.array(places, pa.list_(pa.int64())), pa.array(slots, pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "hash", "pos", "size", "n_words", "places", "slots"])

    shape = f"key {kind_of_key.simpleString()}, hash bigint, pos bigint, size bigint, n_words bigint, places array<bigint>, slots array<string>"
    return rows.select("key", "text").mapInArrow(block, shape)


def window_bitmap(hashes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of the top ``bits`` bits of the column ``hash``; cells are merged on the executors, 64 of them to a number that reaches the driver."""
    cells = hashes.select(F.shiftrightunsigned("hash", 64 - bits).alias("cell"))
    words = cells.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 AS int))")).alias("bits"))
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    for batch in words.toArrow().to_batches():
        bitmap[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return bitmap.view(np.uint8)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, literals: int = 3, coverage: float = 0.8) -> DataFrame:
    """One row per document and benchmark item that it leaks.

    Columns: the id, ``item_id``, ``n_words`` (of the item), ``n_covered``, ``coverage`` and ``kind`` (``exact`` or
    ``reparameterised``). ``coverage`` is the share of the item's words inside matching windows; an item of fewer than
    ``width`` words is one window. Null texts are empty; rows with the same id
    are one document; a null id is one document too. Repeated benchmark rows count once. Empty tables give none.
    """
    items = benchmark.select(F.col("item_id").alias("key"), text_bytes("text").alias("text")).dropDuplicates()
    held = text_windows(items, width, literals, whole=True)
    held = durable(held.select("hash", "size", F.col("key").alias("item_id"), F.col("pos").alias("item_pos"), F.col("n_words").alias("item_words"), "places", F.col("slots").alias("item_slots")))
    bitmap = window_bitmap(held)
    short = [r["size"] for r in held.where(F.col("size") < width).select("size").distinct().collect()]
    own = text_windows(docs.select(F.col(id_col).alias("key"), text_bytes(text_col).alias("text")), width, literals, short, bitmap).drop("places")
    met = own.join(held, ["hash", "size"]).where(F.size("slots") == F.size("item_slots"))
    # The matches are read twice below; written out, the documents are not scanned twice for them.
    met = durable(met.select(
        "key", "item_id", "item_words", "item_pos", "size", (F.col("pos") - F.col("item_pos")).alias("diagonal"),
        F.arrays_zip("places", F.col("item_slots").alias("said"), F.col("slots").alias("heard")).alias("pairs"),
    ))
    # What an item value meets in most of its places on a diagonal stands; other values spoil the windows that hold them.
    line = ["key", "item_id", "diagonal"]
    places = met.select(*line, F.explode("pairs").alias("pair")).select(*line, "pair.places", "pair.said", "pair.heard").distinct()
    heard = places.groupBy(*line, "said", "heard").agg(F.count("*").alias("n"))
    split = heard.groupBy(*line, "said").agg(F.sum("n").alias("all"), F.max_by("heard", "n").alias("most"), F.max("n").alias("top"), F.count("*").alias("values")).where("values > 1")
    split = split.groupBy(*line).agg(F.map_from_entries(F.collect_list(F.struct("said", F.when(F.col("top") * 2 > F.col("all"), F.col("most")).otherwise("").alias("most")))).alias("bound"))
    split = split.select(F.col("key").alias("__k"), F.col("item_id").alias("__i"), F.col("diagonal").alias("__d"), "bound")
    same = F.col("key").eqNullSafe(F.col("__k")) & F.col("item_id").eqNullSafe(F.col("__i")) & (F.col("diagonal") == F.col("__d"))
    sound = F.forall("pairs", lambda p: F.coalesce(F.element_at("bound", p["said"]), p["heard"]) == p["heard"])
    lines = met.join(split, same, "left").where(F.col("bound").isNull() | sound)
    other = F.exists("pairs", lambda p: p["said"] != p["heard"])
    covered = lines.select("key", "item_id", "item_words", other.alias("other"), F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + F.col("size") - 1)).alias("word"))
    covered = covered.groupBy("key", "item_id", "item_words", "word").agg(F.min("other").alias("other"))
    found = covered.groupBy("key", "item_id", "item_words").agg(F.count("*").alias("n_covered"), F.max("other").alias("other"))
    share = F.col("n_covered") / F.col("item_words")
    return found.where(share >= coverage).select(
        F.col("key").alias(id_col), "item_id", F.col("item_words").alias("n_words"), "n_covered", share.alias("coverage"),
        F.when(F.col("other"), "reparameterised").otherwise("exact").alias("kind"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options: float) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item (see ``find_leaks``); a null id is kept."""
    leaks = find_leaks(docs, benchmark, id_col, **options).select(F.col(id_col).alias("leak")).where("leak is not null").distinct()
    rows, names = shielded(docs)
    return rows.join(leaks, F.col(names[id_col]) == F.col("leak"), "left_anti").select(*unshielded(names))
