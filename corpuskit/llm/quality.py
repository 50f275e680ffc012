"""Quality classification by hierarchical empirical Bayes.

A logistic classifier turns each whole text into evidence. Its probabilities, summed over all documents of a host
and of a path below it, give group posteriors: a host is shrunk toward the global rate and a path toward its host,
the more so the fewer documents it has and the less such groups differ (moment estimates). A document's score adds
its own evidence to the log odds of its group without itself, so nothing is counted twice.

The classifier is fitted on at most ``max_train`` labelled rows; group statistics cover all rows. Texts are never
shuffled: they are read and scored twice, once for the group sums and once for the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks_by_bytes, shielded, short_batches, unshielded

#: Most group rows that are broadcast to the documents; more are joined by shuffle.
BROADCAST_GROUPS = 200_000
BLOCK = 4_000_000
LETTERS_UPPER = bytes(range(65, 91))
LETTERS_LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
PLAIN = b".,;:'\"-()?"
SPACE = b" \t\n\r\x0b\x0c"
#: A-Z to a-z, ASCII punctuation and digits to spaces.
FOLD = bytes((b + 32 if 65 <= b < 91 else 32 if b < 128 and not 97 <= b < 123 else b) for b in range(256))
SHAPES = ("log_words", "upper", "digit", "mark", "bang", "word_length", "distinct", "lines", "line_repeat")


def describe(text: bytes) -> tuple[list[float], set[bytes]]:
    """Shape features of a whole text and its set of folded words."""
    n = len(text) or 1
    words = text.translate(FOLD).split()
    own = set(words)
    without = lambda drop: len(text) - len(text.translate(None, drop))
    upper, lower = without(LETTERS_UPPER), without(LETTERS_LOWER)
    digits, plain, space = without(DIGITS), without(PLAIN), without(SPACE)
    high = without(bytes(range(128, 256)))
    mark = len(text) - upper - lower - digits - plain - space - high
    lines = text.split(b"\n")
    shape = [
        math.log1p(len(words)), upper / max(1, upper + lower), digits / n, mark / n, text.count(b"!") / n,
        sum(map(len, words)) / max(1, len(words)), len(own) / max(1, len(words)) ** 0.7, len(lines) / max(1, len(words)), 1 - len(set(lines)) / len(lines),
    ]
    return shape, own


@dataclass(frozen=True)
class Classifier:
    """Logistic weights: ``words`` for folded words, ``shape`` for the scaled shape features."""

    bias: float
    words: dict[bytes, float]
    shape: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def evidence(self, text: bytes) -> float:
        """Log odds that the text is good; finite for any text."""
        shape, own = describe(text)
        total = self.bias + sum(w * min(6.0, max(-6.0, (x - m) / s)) for w, x, m, s in zip(self.shape, shape, self.mean, self.scale, strict=True))
        total += sum(self.words[w] for w in own & self.words.keys())
        return min(30.0, max(-30.0, total))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, rounds: int = 300) -> np.ndarray:
    """Ridge logistic weights by accelerated gradient steps; the last column is the unpenalised bias."""
    return fit_with_bias(np.hstack([x, np.ones((len(x), 1), np.float32)]), y, ridge, rounds)


def fit_with_bias(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, rounds: int = 300) -> np.ndarray:
    """As ``fit_logistic`` of a matrix that ends in a column of ones, which need not be copied for it."""
    penalty = np.append(np.full(x.shape[1] - 1, ridge / len(x)), 0).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest curvature bounds the step
        v = x.T @ (x @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * float(np.linalg.norm(x @ v) ** 2) / len(x) * 1.05 + ridge / len(x) + 1e-9)
    w, ahead = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (p - y) / len(x) + penalty * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new.astype(np.float32)
    return w


def fit_classifier(labelled: DataFrame, text_col: str = "text", label_col: str = "good", max_words: int = 1000, min_docs: int = 8) -> Classifier:
    """Fit on ``labelled``, a bounded table (see ``labelled_sample``).

    ``max_words`` words that ``min_docs`` rows or more hold, with the largest label association, become features.
    Null labels are left out, null texts are empty. With one class only, or no rows, all evidence is the smoothed
    log odds of the labels.
    """
    short_batches(labelled.sparkSession)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_by_bytes(batches, "t", BLOCK):
            found = [describe(t) for t in part.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array([x[0] for x in found], pa.list_(pa.float64())), pa.array([sorted(x[1]) for x in found], pa.list_(pa.binary()))], ["y", "shape", "words"])

    rows = labelled.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("y"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    described = rows.mapInArrow(block, "y int, shape array<double>, words array<binary>").persist()
    try:
        n, good = described.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
        bias = math.log((good + 1) / (n - good + 1))
        none = Classifier(bias, {}, (0.0,) * len(SHAPES), (0.0,) * len(SHAPES), (1.0,) * len(SHAPES))
        if good == 0 or good == n:
            return none
        rate = good / n
        z = (F.col("k") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)))
        picked = (
            described.select("y", F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
            .where(F.col("n") >= min_docs).orderBy(F.abs(z).desc(), "w").limit(max_words).collect()
        )
        vocabulary = {bytes(r["w"]): i for i, r in enumerate(picked)}
        known = described.sparkSession.sparkContext.broadcast(vocabulary)

        def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = [sorted(known.value[w] for w in ws if w in known.value) for ws in b.column("words").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("y"), b.column("shape"), pa.array(hits, pa.list_(pa.int32()))], ["y", "shape", "hits"])

        data = described.mapInArrow(mark, "y int, shape array<double>, hits array<int>").toArrow()
    finally:
        described.unpersist()
    y = data.column("y").to_numpy().astype(np.float32)
    shape = np.array(data.column("shape").to_pylist(), np.float32)
    mean, scale = shape.mean(axis=0), np.maximum(shape.std(axis=0), 1e-6)
    x = np.zeros((len(y), len(SHAPES) + len(vocabulary) + 1), np.float32)
    x[:, -1] = 1
    x[:, : len(SHAPES)] = np.clip((shape - mean) / scale, -6, 6)
    for i, hits in enumerate(data.column("hits").to_pylist()):
        x[i, [len(SHAPES) + h for h in hits]] = 1
    w = fit_with_bias(x, y)
    words = {word: float(w[len(SHAPES) + i]) for word, i in vocabulary.items()}
    return Classifier(float(w[-1]), words, *(tuple(map(float, a)) for a in (w[: len(SHAPES)], mean, scale)))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 12_000) -> DataFrame:
    """``(text, good)`` of at most ``max_train`` labelled documents, in hash order; good means quality 1 and not toxic.

    The bounded sample of labels is what is broadcast; texts are not shuffled, but for those of the sample. Null labels
    count as not good; of rows that share an id one counts.
    """
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(1)) == 0)
    some = labels.select(F.col("doc_id").alias("labelled"), good.cast("int").alias("good")).where("labelled is not null")
    some = some.groupBy("labelled").agg(F.min("good").alias("good")).orderBy(F.xxhash64("labelled"), "labelled").limit(max_train)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    met = own.join(F.broadcast(some), F.col("id") == F.col("labelled"))
    return met.groupBy("id").agg(F.min("text").alias(text_col), F.min("good").alias("good")).drop("id")


def with_evidence(docs: DataFrame, model: Classifier, text_col: str = "text", name: str = "evidence") -> DataFrame:
    """``docs`` with the log odds of each whole text in a new column."""
    short_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            texts = pa.array(batch.column(at)).cast(pa.binary()).to_pylist()
            scores = pa.array([known.value.evidence(t or b"") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, name])

    names = docs.columns
    return docs.mapInArrow(block, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def probability(evidence: Column) -> Column:
    """Log odds as a probability."""
    return 1 / (1 + F.exp(-evidence))


def log_odds(p: Column) -> Column:
    """A probability as log odds, kept finite."""
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def strength(groups: DataFrame, n: str, k: str, center: Column) -> float:
    """Prior weight, in documents, of the mean of groups: the moment estimate of how little the groups differ."""
    p = F.col(k) / F.col(n)
    row = groups.agg(
        F.sum(F.col(n) * (p - center) ** 2).alias("spread"), F.sum(center * (1 - center)).alias("noise"), F.sum(n).alias("n"),
        F.sum(F.col(n) ** 2).alias("n2"), F.sum(F.col(n) * center * (1 - center)).alias("var"), F.count("*").alias("groups"),
    ).first()
    if not row["n"] or row["groups"] < 2 or row["n"] ** 2 <= row["n2"]:
        return 100.0
    between = (row["spread"] - row["noise"] * (row["groups"] - 1) / row["groups"]) / (row["n"] - row["n2"] / row["n"])
    usual = row["var"] / row["n"]
    return float(min(1e6, max(1.0, usual / between - 1))) if between > 0 else 1e6


def score(docs: DataFrame, model: Classifier, host_col: str = "source", path_col: str = "lang", text_col: str = "text", keep_from: float = 0.5) -> DataFrame:
    """``docs`` with ``evidence``, ``host_rate``, ``path_rate`` (shrunk), ``quality_score`` and ``keep``.

    ``quality_score`` is the posterior probability of a good document; ``keep`` means it reaches ``keep_from``. A
    null host or path is a group of its own. Null and empty texts are scored as empty. An empty table gives none.
    The new columns replace columns of the same name.
    """
    spark = docs.sparkSession
    made = ["evidence", "host_rate", "path_rate", "quality_score", "keep"]
    base, names = shielded(docs)
    host_col, path_col = names[host_col], names[path_col]
    scored = with_evidence(base, model, names[text_col])
    p = probability(F.col("evidence"))
    paths = scored.select(F.col(host_col).alias("__h"), F.col(path_col).alias("__p"), p.alias("p")).groupBy("__h", "__p").agg(F.count("*").alias("n"), F.sum("p").alias("k")).persist()
    try:
        size, n, k = paths.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0.0))).first()
        rate = (k + 0.5) / (n + 1)
        hosts = paths.groupBy("__h").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
        m_host = strength(hosts, "hn", "hk", F.lit(rate))
        hosts = hosts.withColumn("host_rate", (F.col("hk") + m_host * rate) / (F.col("hn") + m_host))
        groups = paths.join(hosts.withColumnRenamed("__h", "__g"), F.col("__h").eqNullSafe(F.col("__g"))).drop("__g")
        m_path = strength(groups, "n", "k", F.col("host_rate"))
        groups = groups.withColumn("path_rate", (F.col("k") + m_path * F.col("host_rate")) / (F.col("n") + m_path))
        groups = groups.withColumnsRenamed({c: f"__{c}" for c in ("n", "k", "hn", "hk")})  # the documents may have such columns
        if size <= BROADCAST_GROUPS:  # at most that many rows of two names and six numbers
            rows = groups.collect()
            groups = F.broadcast(spark.createDataFrame(rows, groups.schema))
    finally:
        paths.unpersist()
    # The document's own evidence leaves its groups before it is added.
    host = (F.col("__hk") - p + m_host * rate) / (F.col("__hn") - 1 + m_host)
    path = (F.col("__k") - p + m_path * host) / (F.col("__n") - 1 + m_path)
    joined = scored.join(groups, F.col(host_col).eqNullSafe(F.col("__h")) & F.col(path_col).eqNullSafe(F.col("__p")), "left")
    total = F.col("evidence") + log_odds(path) - math.log(rate / (1 - rate))
    return joined.withColumn("quality_score", probability(total)).withColumn("keep", F.col("quality_score") >= keep_from).select(*unshielded(names, made), *made)
