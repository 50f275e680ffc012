"""Text functions as column expressions: normal forms, hashes, shingles, think tags, diffs, titles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space in normal forms, and as a digit.
WHITE = r"(?U)[\s\x1c-\x1f]+"
DIGITS = r"\p{Nd}+"
DIFF_FILE = r"(?m)^diff --git a/(\S+) b/\S+"


def norm(text: Column) -> Column:
    """Lower case, white space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), WHITE, " "))


def masked(normal: Column) -> Column:
    """A normal form with every run of digits masked."""
    return F.regexp_replace(normal, DIGITS, "N")


def norm_nonum(text: Column) -> Column:
    """The normal form with every run of digits masked."""
    return masked(norm(text))


def norm_words(normal: Column) -> Column:
    """Words of a normal form; none for a blank one."""
    return F.filter(F.split(normal, " ", -1), lambda w: w != "")


def words(text: Column) -> Column:
    """Words of the normal form; none for a blank text."""
    return norm_words(norm(text))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def shingles(words_: Column, k: int, whole_if_short: bool = True) -> Column:
    """Distinct word ``k``-grams; a shorter text is one shingle, or none if ``whole_if_short`` is off."""
    none = F.array().cast("array<string>")

    def grams(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, k), " "))
        short = F.when(F.size(w) == 0, none).otherwise(F.array(F.array_join(w, " "))) if whole_if_short else none
        return F.array_distinct(F.when(F.size(w) < k, short).otherwise(every))

    return bound(words_, grams)


def gram_hashes(words_: Column, k: int, whole_if_short: bool = True) -> Column:
    """As ``shingles``, each gram as a 64-bit hash of its words' hashes: eight bytes in place of a string.

    Words are read by place, since a slice for each gram would be copied, and grams are made distinct outside the
    lambdas, where Spark compiles it.
    """
    none = F.array().cast("array<bigint>")

    def grams(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))
        short = F.when(F.size(w) == 0, none).otherwise(F.array(F.xxhash64(w))) if whole_if_short else none
        return F.when(F.size(w) < k, short).otherwise(every)

    return F.array_distinct(bound(F.transform(words_, lambda x: F.xxhash64(x)), grams))


def strip_white(text: Column) -> Column:
    """The text without white space at either end."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def strip_think(text: Column) -> Column:
    """What follows the last closing think tag, without white space at the ends."""
    return strip_white(F.substring_index(text, "</think>", -1))


def first_filled(*fields: Column) -> Column:
    """The first field that is neither null nor empty, else an empty string."""
    return F.coalesce(*(F.nullif(f, F.lit("")) for f in fields), F.lit(""))


def title(text: Column, most: int = 180) -> Column:
    """The first line that is not blank, without leading ``#`` marks, cut to ``most`` characters."""
    lines = F.transform(F.split(text, r"\r\n|\n|\r", -1), lambda x: F.trim(F.regexp_replace(F.trim(x), r"^#+", "")))
    return F.left(F.coalesce(F.try_element_at(F.filter(lines, lambda x: x != ""), F.lit(1)), F.lit("")), F.lit(most))


def changed_files(patch: Column) -> Column:
    """Paths that a unified diff names, in order."""
    return F.regexp_extract_all(patch, F.lit(DIFF_FILE), F.lit(1))


def changed_lines(patch: Column) -> Column:
    """Lines that a unified diff adds or removes, file headers left out."""
    counts = lambda x: (x.startswith("+") & ~x.startswith("+++")) | (x.startswith("-") & ~x.startswith("---"))
    return F.size(F.filter(F.split(patch, "\n", -1), counts))


def hash_order(*parts: Column, seed: int = 42) -> Column:
    """A reproducible shuffle key: SHA-256 over a salt and the row's names."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts)), 256)


def multiset_digest(hashes: Column) -> Column:
    """An aggregate over SHA-256 digests that no order changes: four sums of 56 bits each, hashed once more.

    Sums need no list of all rows in one task, however many there are.
    """
    part = lambda i: F.sum(F.conv(F.substring(hashes, 1 + 14 * i, 14), 16, 10).cast("decimal(20,0)")) % F.lit(1 << 56).cast("decimal(20,0)")
    return F.sha2(F.concat_ws(":", *(part(i).cast("bigint").cast("string") for i in range(4))), 256)


def any_of(text: Column, needles: tuple[str, ...]) -> Column:
    """Whether the text holds one of the strings; the text, which may be long to make, is made once and not for each of them."""
    return bound(text, lambda t: F.exists(F.array(*map(F.lit, needles)), lambda n: F.contains(t, n)))


def hits(text: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns match."""
    return sum((text.rlike(p).cast("int") for p in patterns), F.lit(0))


def as_list(value: Column) -> Column:
    """A JSON list as an array; other text is a list of itself, null an empty list."""
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(value, "array<string>"), F.array(value)))


def markdown_cell(text: Column) -> Column:
    """Text that is safe inside a table cell."""
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def markdown_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(c.cast("string")) for c in cells)), F.lit(" |"))
