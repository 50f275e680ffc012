"""Functions on token ids, labels and top-K arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the packed format: ignored label, pads of top-K ids and log probabilities, and K.
IGNORE, PAD_ID, PAD_LOGPROB, TOP_K = -100, -1, -1e9, 20


def pad_right(values: Column, size: int, fill: Column) -> Column:
    """The first ``size`` values, filled up to that many."""
    head = F.slice(values, 1, size)
    return F.concat(head, F.array_repeat(fill, F.lit(size) - F.size(head)))


def coverage(logprobs: Column) -> Column:
    """Probability mass of log probabilities, at most 1."""
    return F.least(F.lit(1.0), F.aggregate(logprobs, F.lit(0.0), lambda s, x: s + F.exp(x.cast("double"))))


def masked(values: Column, flags: Column, other: Column) -> Column:
    """``values`` where the flag holds, ``other`` elsewhere."""
    return F.zip_with(values, flags, lambda v, ok: F.when(ok, v).otherwise(other))


def parse_token_id(text: Column) -> Column:
    """The number of ``token_id:<n>``; any other form is an error."""
    ok = text.rlike(r"^token_id:\d+$")
    return F.when(ok, F.substring_index(text, ":", -1).cast("int")).otherwise(F.raise_error(F.concat(F.lit("not a token id: "), text)).cast("int"))


def trainable(labels: Column) -> Column:
    """Number of labels that count for the loss."""
    return F.size(F.filter(labels, lambda x: x != IGNORE))


def topk_kl(student: Column, teacher: Column, temperature: float = 2.0) -> Column:
    """KL(teacher || student) over the same K entries, both renormalised at the temperature."""

    def soft(x: Column) -> Column:
        scaled = F.transform(x, lambda v: v.cast("double") / temperature)
        top = F.array_max(scaled)
        total = F.aggregate(scaled, F.lit(0.0), lambda s, v: s + F.exp(v - top))
        return F.transform(scaled, lambda v: v - top - F.log(total))

    parts = F.zip_with(soft(teacher), soft(student), lambda t, s: F.exp(t) * (t - s))
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v) * temperature**2
