"""The corpus pipeline: quality, repeated lines, near duplicates, benchmark leaks, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import durable, shared_dir, shielded, table, unshielded
from corpuskit.llm.decontam import drop_leaks
from corpuskit.llm.linededup import dedup_lines
from corpuskit.llm.packing import pack, token_counts
from corpuskit.llm.quality import fit_classifier, labelled_sample, score
from corpuskit.llm.similar import similar_components

#: The classifier is fitted on at most so many labelled documents.
MAX_TRAIN = 12_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null and empty texts are judged as empty, a null source or language is a group of its own, repeated rows are judged
    alike. Without labels, or with one class of them, all documents have the same evidence.
    """
    model = fit_classifier(labelled_sample(docs, table(spark, sf_dir, "labels"), max_train=MAX_TRAIN))
    rows, names = shielded(docs)
    kept = score(rows, model, host_col=names["source"], path_col=names["lang"], text_col=names["text"])
    return kept.where("keep").select(*unshielded(names))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; ``n_chars`` follows the text.

    A null text stays null, a null id counts for no line, and repeated rows lose the same lines.
    """
    rows, names = shielded(docs)
    kept = dedup_lines(rows, id_col=names["doc_id"], text_col=names["text"])
    length = F.char_length(F.coalesce(names["text"], F.lit(""))).cast("bigint")
    return kept.withColumn(names["n_chars"], length).select(*unshielded(names))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows with a null id are kept as they are.

    Texts are near from a Jaccard similarity of 0.8 of their five-word shingles; null and blank texts are one group. Rows
    go by id and text: repeated rows become one, and rows that share an id but are not near each other stay.
    """
    found = durable(similar_components(docs).where(F.col("id").isNotNull()))
    # Written out, the heads are dealt anew for the join, where a large component's rows can be split.
    heads = durable(found.groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("head")))
    goes = (F.col("id") != F.col("head.id")) | (F.col("text_hash") != F.col("head.text_hash"))
    marks = found.join(heads, "component").groupBy("id", "text_hash").agg(F.max(goes).alias("lost"), F.count("*").alias("n_rows"))
    marks = durable(marks.where("lost or n_rows > 1"))
    rows, names = shielded(docs)
    own = rows.withColumn("text_key", F.xxhash64(F.coalesce(names["text"], F.lit(""))))
    kept = own.join(marks, (F.col(names["doc_id"]) == F.col("id")) & (F.col("text_key") == F.col("text_hash")), "left").where("not coalesce(lost, false)")
    if marks.where("not lost").isEmpty():
        return kept.select(*unshielded(names))
    repeated = F.coalesce(F.col("n_rows"), F.lit(1)) > 1
    return kept.where(~repeated).unionByName(kept.where(repeated).dropDuplicates([names["doc_id"], "text_key"])).select(*unshielded(names))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; null and empty texts and null ids stay, rows of one id are judged together."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token sequence of the remaining documents with its bucket, batch and slot."""
    return pack(token_counts(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", leak_stage),
    ("packing", packing_stage),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    shared = shared_dir(spark)
    run_id = spark.sparkContext.applicationId + "-" + str(spark.sparkContext._jvm.System.nanoTime())
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared}/pipeline-{run_id}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
