"""Readers and writers: JSON lines, documents, shards with manifests, ledgers, vocabularies, reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import multiset_digest
from ..operators.dedup import latest
from ..session import durable

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
PROMPTS = T.StructType([T.StructField("sample_id", T.LongType()), T.StructField("prompt", T.StringType()), T.StructField("slice", T.StringType()), T.StructField("source", T.StringType())])
SHARD = T.StructType([
    T.StructField("sample_id", T.LongType()), T.StructField("slice", T.StringType()), T.StructField("prompt", T.StringType()), T.StructField("response_text", T.StringType()),
    T.StructField("reasoning_text", T.StringType()), T.StructField("response_token_ids", T.ArrayType(T.IntegerType())), T.StructField("topk_ids", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("topk_logprobs", T.ArrayType(T.ArrayType(T.FloatType()))), T.StructField("finish_reason", T.StringType()), T.StructField("gen_seed", T.LongType()),
    T.StructField("bon_n", T.IntegerType()), T.StructField("bon_pick", T.IntegerType()), T.StructField("bon_judged", T.BooleanType()), T.StructField("topk_coverage", T.ArrayType(T.FloatType())),
])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a stated schema; a line that does not fit is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file, with its ``path``; broken documents are left out."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])).option("multiLine", True).option("recursiveFileLookup", True)
    rows = rows.option("columnNameOfCorruptRecord", "_bad").json(path).select("*", F.col("_metadata.file_path").alias("path"))
    return rows.where(F.col("_bad").isNull()).drop("_bad")


def read_rollouts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rollout documents named ``<task>/rollout<N>...json`` with ``task`` and ``rollout`` from their path."""
    rows = read_documents(spark, path, schema)
    part = lambda k: F.regexp_extract("path", r"([^/]+)/rollout(\d+)[^/]*\.json$", k)
    return rows.withColumns({"task": part(1), "rollout": part(2).try_cast("int")})


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, or an error if a key occurs twice."""
    twice = df.groupBy(key).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {[r[0] for r in twice]}")
    return df


def read_shards(spark: SparkSession, paths: list[str], key: str = "sample_id") -> DataFrame:
    """Sealed shards of several folders; ids must be unique over all."""
    return require_unique(spark.read.schema(SHARD).parquet(*paths), key)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error if it is empty: a screen without its benchmark must not pass silently."""
    if df.isEmpty():
        raise ValueError(f"{what} is missing or empty")
    return df


def write_shards(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Zstandard Parquet; the committer makes each write all or nothing."""
    out = df.write.option("compression", "zstd").mode("errorifexists")
    (out.partitionBy(*by) if by else out).parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file, sha256, bytes)`` of the data files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def append_ledger(df: DataFrame, path: str) -> None:
    """Rows at the end of a ledger; ``seq`` orders them."""
    df.write.mode("append").json(path)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType, key: str, order: str = "seq") -> DataFrame:
    """The last row of each key."""
    return latest(read_jsonl(spark, path, schema), key, order)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(token, id)`` of a tokenizer document; added tokens replace others of the same form."""
    raw = spark.read.text(path, wholetext=True)
    base = raw.select(F.explode(F.from_json(F.get_json_object("value", "$.model.vocab"), "map<string,int>")).alias("token", "id"), F.lit(0).alias("rank"))
    added = raw.select(F.explode(F.from_json(F.get_json_object("value", "$.added_tokens"), "array<struct<content:string,id:int>>")).alias("a")).select(F.col("a.content").alias("token"), F.col("a.id").alias("id"), F.lit(1).alias("rank"))
    return latest(base.unionByName(added), "token", "rank").select("token", "id")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(path, task, metric, value)`` of evaluation result documents; null metrics are left out."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json(F.get_json_object("value", "$.results"), "map<string,map<string,string>>").alias("r"))
    tasks = raw.select("path", F.explode("r").alias("task", "m")).select("path", "task", F.explode("m").alias("metric", "v"))
    return tasks.select("path", "task", "metric", F.col("v").try_cast("double").alias("value")).where(F.col("value").isNotNull())


def read_samples(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """JSON lines of all files that a pattern matches; none at all is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    if found is None or not len(found):
        raise ValueError(f"no sample files match {pattern}")
    return read_jsonl(spark, pattern, schema)


def read_plan(text: str, sections: tuple[str, ...]) -> dict:
    """A plan as JSON (or YAML, where a parser is installed); a missing section is an error."""
    try:
        plan = json.loads(text)
    except json.JSONDecodeError:
        import yaml

        plan = yaml.safe_load(text)
    missing = [s for s in sections if s not in plan]
    if missing:
        raise ValueError(f"the plan lacks {', '.join(missing)}")
    return plan


def shard_seals(expected: DataFrame, results: DataFrame, floor: float = 0.5) -> DataFrame:
    """``(shard, total, n_rows, n_dropped, sealed)``: a shard that kept less than ``floor`` of its prompts stays open.

    ``expected`` has ``shard`` and ``sample_id``; ``results`` has ``sample_id`` and ``dropped`` (null for a kept row, else why).
    A prompt without result counts as dropped.
    """
    met = expected.join(results.select("sample_id", "dropped", F.lit(True).alias("__got")), "sample_id", "left")
    kept = F.count_if(F.col("__got") & F.col("dropped").isNull())
    t = met.groupBy("shard").agg(F.count("*").alias("total"), kept.alias("n_rows"))
    return t.select("shard", "total", "n_rows", (F.col("total") - F.col("n_rows")).alias("n_dropped"), (F.col("n_rows") >= floor * F.greatest("total", F.lit(1))).alias("sealed"))


def drop_reasons(expected: DataFrame, results: DataFrame) -> DataFrame:
    """``(shard, reason, n)`` of what was dropped; a prompt without result is ``missing``."""
    met = expected.join(results.select("sample_id", "dropped", F.lit(True).alias("__got")), "sample_id", "left")
    why = F.when(F.col("__got").isNull(), "missing").otherwise(F.col("dropped"))
    return met.select("shard", why.alias("reason")).where("reason is not null").groupBy("shard", "reason").agg(F.count("*").alias("n"))


def seal_shards(expected: DataFrame, results: DataFrame, path: str, prompts_hash: str, floor: float = 0.5) -> DataFrame:
    """Write the kept rows of shards that may be sealed, and their manifest beside them; returns ``shard_seals``.

    Shards that the manifest already has are left alone. A manifest of other prompts is an error.
    """
    spark = results.sparkSession
    expected = pending_shards(expected, sealed_manifest(spark, path), prompts_hash)
    seals = durable(shard_seals(expected, results, floor))
    kept = results.where("dropped is null").drop("dropped").join(expected.select("sample_id", "shard"), "sample_id").join(seals.where("sealed").select("shard"), "shard")
    kept.write.option("compression", "zstd").mode("append").partitionBy("shard").parquet(f"{path}/rows")
    # The manifest comes last: a shard whose rows were written but not listed is written again.
    seals.where("sealed").select("shard", "total", "n_rows", "n_dropped", F.lit(prompts_hash).alias("prompts_sha256")).write.mode("append").parquet(f"{path}/manifest")
    return seals


MANIFEST = "shard bigint, total bigint, n_rows bigint, n_dropped bigint, prompts_sha256 string"


def sealed_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a sealed corpus; without one, no rows."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest") if there else spark.createDataFrame([], MANIFEST)


def pending_shards(expected: DataFrame, manifest_: DataFrame, prompts_hash: str) -> DataFrame:
    """The rows of shards that are not sealed; a manifest of other prompts is an error, since ids would not match."""
    if not manifest_.where(~F.col("prompts_sha256").eqNullSafe(F.lit(prompts_hash))).isEmpty():
        raise ValueError("the prompts are not those of the sealed shards")
    return expected.join(manifest_.select("shard").distinct(), "shard", "left_anti")


def write_corpus(train: DataFrame, heldout: DataFrame, funnel: DataFrame, path: str) -> dict[str, dict]:
    """Training and held-out prompts as JSON lines, their funnel, and a manifest of rows and content digests."""
    about = {}
    for name, rows in (("prompts", train), ("prompts_heldout", heldout)):
        write_jsonl(rows, f"{path}/{name}")
        back = rows.sparkSession.read.text(f"{path}/{name}")
        n, digest = back.agg(F.count("*"), multiset_digest(F.sha2("value", 256))).first()
        about[name] = {"rows": n, "digest": digest}
    write_report(funnel, f"{path}/funnel")
    write_report(train.sparkSession.createDataFrame([(k, v["rows"], v["digest"]) for k, v in about.items()], "name string, rows bigint, digest string"), f"{path}/MANIFEST")
    return about


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """Training and validation rows in a folder of each."""
    write_shards(df, path, [split])


def write_tensors(df: DataFrame, path: str, shapes: dict[str, int]) -> None:
    """Rows of arrays, one row per rollout; an inner length other than the stated one is an error."""
    bad = F.lit(False)
    for name, size in shapes.items():
        bad = bad | F.exists(name, lambda x: F.size(x) != size)  # noqa: B023
    wrong = df.where(bad).limit(1).collect()
    if wrong:
        raise ValueError(f"an array has not its shape: {shapes}")
    write_shards(df, path)


def write_report(df: DataFrame, path: str, most: int = 10_000) -> None:
    """A small table as one JSON document; more than ``most`` rows are an error.

    The document is written beside its place and moved there, so a reader finds the old one or the new one.
    """
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("a report is a small table")
    spark = df.sparkSession
    draft = f"{path}.{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps([r.asDict(True) for r in rows], ensure_ascii=False, default=str),)], "value string").coalesce(1).write.text(draft)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place(path), True)
    if not files.rename(place(draft), place(path)):
        raise OSError(f"the report could not be moved to {path}")
