"""URL filters with DataFrame functions only: host and path rules, and gradient-boosted trees on lexical features.

Trees are fitted by second-order boosting on a bounded, labelled sample: each level of a tree is one grouped
aggregation of gradients by (node, feature, bin), of which only sums come to the driver. Scoring is a column
expression of nested conditions; only the table of suffix statistics, one row per suffix, is joined to the pages.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, shielded, unshielded

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters whose frequencies make up the entropy feature.
ALPHABET = LOWER + "0123456789-._~/%?&=+"
FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens", "suffix_rate", "suffix_share")
#: Most rules of a filter; they become conditions of one expression.
MAX_RULES = 500
#: Parts of the sample: the suffix rates of one come from the others, so that no url speaks for itself.
FOLDS = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does; ties go to the first named."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"a filter takes at most {MAX_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        name = F.when(rule.fits(host, path), rule.name).otherwise(name)
        verdict = F.when(rule.fits(host, path), rule.verdict).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Tree:
    """A split (``feature`` below ``cut``, that is in bin ``last`` at most, goes left) or, without a feature, a leaf."""

    value: float = 0.0
    feature: str | None = None
    cut: float = 0.0
    last: int = 0
    left: Tree | None = None
    right: Tree | None = None

    def column(self) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(F.col(f"__{self.feature}") < self.cut, self.left.column()).otherwise(self.right.column())

    def binned(self) -> Column:
        """The same on bins, as while fitting."""
        if self.feature is None:
            return F.lit(self.value)
        return F.when(F.col(f"__{self.feature}") <= self.last, self.left.binned()).otherwise(self.right.binned())


@dataclass(frozen=True)
class UrlModel:
    """Boosted trees with the suffix statistics that two of their features use.

    ``suffixes`` has one row per suffix: ``suffix``, ``share`` (of all pages) and ``rate`` (of bad urls in the sample,
    shrunk to ``usual_rate``; null where the sample has none). It may be of any size. None means that all are unknown.
    """

    bias: float
    trees: tuple[Tree, ...]
    suffixes: DataFrame | None = None
    usual_rate: float = 0.5

    def margin(self) -> Column:
        """Log odds that a url is to be blocked, from the columns of ``with_features``."""
        return sum((t.column() for t in self.trees), F.lit(self.bias))


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def shrunk(k: Column, n: Column, usual: float) -> Column:
    """The rate of ``k`` in ``n``, as if 20 more had the usual one."""
    return (k + 20 * usual) / (n + 20)


def with_features(df: DataFrame, url: Column, host: Column, path: Column) -> DataFrame:
    """``df`` with a column ``__<name>`` for each of ``FEATURES`` but those of the suffix, and ``__suffix``; null urls count as empty."""
    url = F.coalesce(url, F.lit(""))
    many = lambda text, ch: (F.char_length(text) - F.char_length(F.replace(text, F.lit(ch), F.lit("")))).cast("double")
    df = df.withColumns({"__url": F.lower(url), "__host": host, "__path": path})
    u, h, p = F.col("__url"), F.col("__host"), F.col("__path")
    n = F.greatest(F.char_length(u), F.lit(1)).cast("double")
    df = df.withColumns({f"__n{i}": many(u, ch) / n for i, ch in enumerate(ALPHABET)})
    shares_of = [F.col(f"__n{i}") for i in range(len(ALPHABET))]
    digits = [F.col(f"__n{ALPHABET.index(d)}") for d in "0123456789"]
    return df.withColumns({
        "__length": n, "__host_length": F.char_length(h).cast("double"), "__path_length": F.char_length(p).cast("double"), "__depth": many(p, "/"),
        "__digit_ratio": sum(digits[1:], digits[0]),
        "__entropy": sum((F.when(s > 0, -s * F.log2(s)).otherwise(0.0) for s in shares_of[1:]), F.when(shares_of[0] > 0, -shares_of[0] * F.log2(shares_of[0])).otherwise(0.0)),
        "__parameters": many(u, "&") + many(u, "="), "__labels": many(h, "."), "__hyphens": many(h, "-"),
        "__suffix": suffix_of(h),
    })


def with_suffixes(df: DataFrame, model: UrlModel) -> DataFrame:
    """``df`` with ``__suffix_rate`` and ``__suffix_share`` of its ``__suffix``; unknown ones have the usual rate and no share."""
    if model.suffixes is None:
        return df.withColumns({"__suffix_rate": F.lit(model.usual_rate), "__suffix_share": F.lit(0.0)})
    met = df.join(model.suffixes, F.col("__suffix") == F.col("suffix"), "left")
    return met.withColumns({"__suffix_rate": F.coalesce("rate", F.lit(model.usual_rate)), "__suffix_share": F.coalesce("share", F.lit(0.0))}).drop("suffix", "rate", "share")


def fit_urls(labelled: DataFrame, pages: DataFrame | None = None, url_col: str = "url", label_col: str = "bad", max_train: int = 20_000, rounds: int = 12, depth: int = 2, bins: int = 16, rate: float = 0.3, ridge: float = 5.0) -> UrlModel:
    """Boosted trees for labelled urls (1 is to be blocked), fitted on at most ``max_train`` rows in hash order.

    Suffixes are counted over all of ``pages`` (the labelled urls without); their rates come from the sample, and for
    the fit itself from the other folds of it. Null labels are left out, null urls are empty. Without rows, or with one
    class, the model is the smoothed log odds alone. A split needs a positive gain; leaves shrink by ``ridge``.
    """
    some = labelled.where(F.col(label_col).isNotNull()).select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("y"))
    some = some.orderBy(F.xxhash64("url", "y"), "url").limit(max_train)
    host, path = url_parts(F.col("url"))
    some = durable(with_features(some, F.col("url"), host, path).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS))))
    n, bad = some.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    bias = math.log((bad + 1) / (n - bad + 1))
    if bad in (0, n):
        return UrlModel(bias, (), usual_rate=(bad + 1) / (n + 2))
    usual = bad / n
    by_fold = durable(some.groupBy("__suffix", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("k")))
    rates = by_fold.groupBy("__suffix").agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"))
    counted = (labelled if pages is None else pages).select(suffix_of(url_parts(F.col(url_col))[0]).alias("suffix")).groupBy("suffix").agg(F.count("*").alias("n"))
    total = max(1, counted.agg(F.sum("n")).first()[0] or 0)
    shares = counted.select("suffix", (F.col("n") / total).alias("share"))
    table = shares.join(rates, F.col("suffix") == F.col("__suffix"), "left").select("suffix", "share", shrunk(F.col("all_k"), F.col("all_n"), usual).alias("rate"))
    others = by_fold.join(rates, "__suffix").select(F.col("__suffix").alias("of"), F.col("fold").alias("in"), shrunk(F.col("all_k") - F.col("k"), F.col("all_n") - F.col("n"), usual).alias("__suffix_rate"))
    described = some.join(others, (F.col("__suffix") == F.col("of")) & (F.col("fold") == F.col("in"))).join(shares.withColumnsRenamed({"suffix": "s", "share": "__suffix_share"}), F.col("__suffix") == F.col("s"), "left")
    described = durable(described.select("y", *(F.coalesce(f"__{f}", F.lit(0.0)).alias(f"__{f}") for f in FEATURES)))
    at = [F.percentile_approx(f"__{f}", [k / bins for k in range(1, bins)], 1000).alias(f) for f in FEATURES]
    cuts = {f: sorted(set(v)) for f, v in described.agg(*at).first().asDict().items()}
    bin_of = lambda f: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c <= F.col(f"__{f}")))
    data = durable(described.select("y", F.lit(bias).alias("margin"), *(bin_of(f).alias(f"__{f}") for f in FEATURES)))
    trees: list[Tree] = []
    for _ in range(rounds):  # the margin so far is a written column, so each tree's expression stands alone
        trees.append(_grow(data, F.col("margin"), cuts, depth, rate, ridge))
        data = durable(data.withColumn("margin", F.col("margin") + trees[-1].binned()))
    return UrlModel(bias, tuple(trees), table, usual)


def _grow(data: DataFrame, margin: Column, cuts: dict[str, list[float]], depth: int, rate: float, ridge: float) -> Tree:
    """One tree, level by level; each level is one aggregation over (node, feature, bin)."""
    p = 1 / (1 + F.exp(-margin))
    node_of: Column = F.lit(1)
    splits: dict[int, tuple[str, int]] = {}
    totals: dict[int, tuple[float, float]] = {}
    cells = [F.struct(F.lit(i).alias("f"), F.col(f"__{f}").alias("b")) for i, f in enumerate(FEATURES)]
    for level in range(depth):
        rows = data.select(node_of.alias("node"), (F.col("y") - p).alias("g"), (p * (1 - p)).alias("h"), F.explode(F.array(*cells)).alias("x"))
        sums: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
        for r in rows.groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            sums.setdefault(r["node"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
        for node, features in sums.items():
            if node < 1 << level:
                continue
            g, h = (sum(v[k] for v in next(iter(features.values())).values()) for k in (0, 1))
            totals[node] = (g, h)
            best = (1e-6, None)
            for f, by_bin in sorted(features.items()):
                left = [0.0, 0.0]
                for b in range(len(cuts[FEATURES[f]])):
                    left = [left[k] + by_bin.get(b, (0.0, 0.0))[k] for k in (0, 1)]
                    gl, hl, gr, hr = left[0], left[1], g - left[0], h - left[1]
                    if hl < 1 or hr < 1:
                        continue
                    gain = gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - g * g / (h + ridge)
                    if gain > best[0] + 1e-9:
                        best = (gain, (FEATURES[f], b, (gl, hl), (gr, hr)))
            if best[1]:
                name, last, totals[2 * node], totals[2 * node + 1] = best[1]
                splits[node] = (name, last)
        moved: Column = node_of
        for node, (name, last) in splits.items():
            if node >= 1 << level:
                moved = F.when(node_of == node, F.when(F.col(f"__{name}") <= last, 2 * node).otherwise(2 * node + 1)).otherwise(moved)
        node_of = moved

    def build(node: int) -> Tree:
        if node in splits:
            name, last = splits[node]
            return Tree(0.0, name, float(cuts[name][last]), last, build(2 * node), build(2 * node + 1))
        g, h = totals.get(node, (0.0, 0.0))
        return Tree(rate * g / (h + ridge))

    return build(1)


def filter_urls(pages: DataFrame, model: UrlModel, rules: list[Rule], url_col: str = "url", block_from: float = 0.5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits), ``block_score`` and ``verdict``.

    The verdict is the longest fitting rule's, else ``block`` where the model's probability reaches ``block_from``
    and ``allow`` elsewhere. A null url, or one without ``://``, has an empty host and path and no rule. The new
    columns replace columns of the same name; an empty table gives none.
    """
    made = ["host", "path", "rule", "block_score", "verdict"]
    base, names = shielded(pages)
    url = F.col(names[url_col])
    host, path = url_parts(url)
    rows = with_suffixes(with_features(base, url, host, path), model)
    name, said = matching_rule(F.col("__host"), F.col("__path"), rules)
    score = 1 / (1 + F.exp(-model.margin()))
    rows = rows.withColumns({"__rule": name, "__said": said, "__score": score})
    verdict = F.coalesce("__said", F.when(F.col("__score") >= block_from, "block").otherwise("allow"))
    own = unshielded(names, [c for c in made if c != url_col])
    return rows.select(*own, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), F.col("__score").alias("block_score"), verdict.alias("verdict"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Urls of pages whose document has a label: ``bad`` is 1 for low quality or toxic."""
    bad = ((F.coalesce("quality", F.lit(0)) != 1) | (F.coalesce("toxic", F.lit(1)) != 0)).cast("int")
    return pages.select("page_id", "url").join(labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), "page_id").select("url", "bad")
