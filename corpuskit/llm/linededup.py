"""Line deduplication with DataFrame functions only.

Normalised lines are exploded and hashed, documents are counted per hash, lines over the threshold are dropped
everywhere but in the largest document that holds them, and each document is put together again by position.

Only hashes and positions are shuffled by key. A line that a third of all documents share is counted behind a
partial aggregation, and its join is an ordinary equi-join that adaptive execution can split. Document texts are
shuffled once, by document, to meet the positions that they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, shielded

#: ASCII white space that is stripped from both ends of a line.
WHITE = " \t\n\x0b\f\r"


def stripped(line: Column) -> Column:
    """The line without ASCII white space at either end."""
    return F.btrim(line, F.lit(WHITE))


def key_hashes(key: Column) -> list[Column]:
    """Two 64-bit hashes of a line key with A-Z lower-cased.

    Spark's ``lower`` would change other letters too. Read as ISO-8859-1, the bytes of UTF-8 keep A-Z apart from
    the rest: lower-casing then maps lead bytes C2-DE to E2-FE, which stays reversible because a lead byte's
    class also follows from the number of continuation bytes behind it. Equal hashes thus mean equal keys.
    """
    folded = F.lower(F.decode(key.cast("binary"), "ISO-8859-1"))
    return [F.xxhash64(folded).alias("__h1"), F.xxhash64(F.lit(7), folded).alias("__h2")]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with repeated lines removed from ``text_col``, plus ``n_lines`` (before) and ``n_dropped``.

    A key of ``min_chars`` code points or more that ``min_docs`` different documents hold loses all its lines but
    those in the document with the largest id. Null and empty texts are one empty line. A null id is no document
    of its own: it counts for no line and its lines follow the decision made on the others. Repeated rows (same
    id, same text) each lose the same lines. Further columns pass through, whatever their names; ``n_lines`` and
    ``n_dropped`` replace columns of these names.
    """
    docs, names = shielded(docs)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    row_key = [F.col(names[id_col]).alias("__id"), F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(7), text).alias("__t2")]
    lines = (
        docs.select(*row_key, F.posexplode(F.split(text, "\n", -1)).alias("__pos", "__line"))
        .withColumn("__key", stripped(F.col("__line")))
        .where(F.char_length("__key") >= min_chars)
        .select("__id", "__t1", "__t2", "__pos", *key_hashes(F.col("__key")))
    )
    held = lines.where(F.col("__id").isNotNull()).select("__h1", "__h2", "__id").distinct()
    # Written out, the common lines are dealt anew for the join, where a hot one's rows can be split among tasks.
    common = durable(held.groupBy("__h1", "__h2").agg(F.count("*").alias("__n"), F.max("__id").alias("__last")).where(F.col("__n") >= min_docs).select("__h1", "__h2", "__last"))
    lost = (
        lines.join(common, ["__h1", "__h2"])
        .where(~F.col("__id").eqNullSafe(F.col("__last")))
        .groupBy("__id", "__t1", "__t2")
        .agg(F.collect_list("__pos").alias("__lost"))
        .select(F.col("__id").alias("__lost_id"), F.col("__t1").alias("__lost_t1"), F.col("__t2").alias("__lost_t2"), "__lost")
    )
    own = docs.withColumns({"__id": row_key[0], "__t1": row_key[1], "__t2": row_key[2]})
    same = F.col("__id").eqNullSafe(F.col("__lost_id")) & (F.col("__t1") == F.col("__lost_t1")) & (F.col("__t2") == F.col("__lost_t2"))
    split = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__lost"))
    # The one-element array binds the split lines to a variable, so they are not split again for every position.
    whole = F.transform(F.array(F.struct(split.alias("l"), kept.alias("k"))), lambda s: F.array_join(F.transform(s["k"], lambda i: F.get(s["l"], i)), "\n"))[0]
    made = {
        "n_lines": F.size(split).cast("long"), "n_dropped": F.coalesce(F.size(F.array_distinct("__lost")), F.lit(0)).cast("long"),
        text_col: F.when(F.col("__lost").isNull(), F.col(names[text_col])).otherwise(whole),
    }
    columns = {c: made.get(c, F.col(new)) for c, new in names.items()} | made
    return own.join(lost, same, "left").select(*(v.alias(c) for c, v in columns.items()))
