"""The queries of the training-data operators and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontam import find_leaks
from .htmlcut import extract_main_text, fit_weights
from .linededup import dedup_lines
from .media import media_features, with_media
from .packing import pack, token_counts
from .quality import fit_classifier, labelled_sample, score
from .simhash import fingerprint_hex, near_duplicates
from .suffix import remove_repeats
from .tokenout import write_tokens
from .urlfilter import Rule, filter_urls, fit_urls, labelled_pages


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents`` by 64-bit SimHash over 3-word shingles, linked at 3 bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", fingerprint_hex().alias("fingerprint"), "component_id")


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, with re-parameterised ones: 5-word template windows over 0.8 of it."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=5, literals=3, coverage=0.8)


#: Rules of the production filter.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for every page url: the longest fitting rule's, else the boosted trees'."""
    pages = table(spark, sf_dir, "pages")
    model = fit_urls(labelled_pages(pages, table(spark, sf_dir, "labels")), pages, max_train=20_000)
    return filter_urls(pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as baseline JPEG, and what its stored bytes say when read back."""
    media = with_media(table(spark, sf_dir, "documents"))
    read = media_features(media)
    return read.select(
        "doc_id", "n_bytes", F.octet_length("thumbnail").cast("long").alias("payload_bytes"), F.col("thumbnail_sha256").alias("payload_sha256"),
        "tail_crc32", "media_bytes", "media_sha256", "feature",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes under repeated 200-byte strings."""
    kept = remove_repeats(table(spark, sf_dir, "documents"), min_len=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, weights=fit_weights(pages, max_pages=500)).select("page_id", "url", "text", "n_chars")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimal length buckets for token sequences of ``documents``, in batches of 65,536 tokens."""
    return pack(token_counts(table(spark, sf_dir, "documents")), max_len=2048, buckets=8, token_budget=65_536)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token sequence of ``documents`` in its slot of the training order, written to shards and read back."""
    return write_tokens(table(spark, sf_dir, "documents"), length=256, key=2024, shard_bytes=16 << 20)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document; source is the host and language the path below it."""
    docs = table(spark, sf_dir, "documents")
    model = fit_classifier(labelled_sample(docs, table(spark, sf_dir, "labels"), max_train=12_000))
    return score(docs, model, host_col="source", path_col="lang").select("doc_id", "source", "lang", "evidence", "host_rate", "path_rate", "quality_score", "keep")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more in 5 or more documents, kept in the last document only."""
    kept = dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the URL filter that SQL can say: host, path, and the longest rule that fits."""
    return op3_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("said"))


def media_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the media columns that SQL can say: sizes and the payload as read back from the stored bytes."""
    return op4_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_decontam": op2_decontam,
    "op3_url_filter": op3_url_filter,
    "op4_media": op4_media,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_packing": op7_packing,
    "op8_token_output": op8_token_output,
    "op9_quality": op9_quality,
    "op10_line_dedup": op10_line_dedup,
    "url_rules": url_rules,
    "media_payload": media_payload,
}

WHITE_SQL = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "url_rules": f"""
        WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {LOWER_SQL}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(said, h, q) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}),
        m AS (SELECT page_id, h || q AS rule, said, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC) AS k FROM p JOIN r ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, q))
        SELECT p.page_id, host, path, rule, said FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (page_id)
    """,
    "media_payload": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        s AS (SELECT *, CASE WHEN n = 0 THEN 192 ELSE 191 - (n - 1) % 192 END AS pad FROM d)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n + pad AS BIGINT) AS payload_bytes, sha256(t || repeat(' ', pad)) AS payload_sha256 FROM s
    """,
    "op5_suffix_dedup": """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    w AS (SELECT doc_id, i, md5(b[i + 1:i + 200]) AS h FROM (SELECT doc_id, b, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200)),
    r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
    e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM r),
    g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e),
    s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY doc_id, k),
    p AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last FROM s),
    q AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS spans, string_agg(hex(b[last + 1:a]), '' ORDER BY a) AS kept, max(z) AS tail FROM p JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
        sha256(unhex(coalesce(kept, '') || hex(b[coalesce(tail, 0) + 1:n]))) AS kept_sha256
    FROM d LEFT JOIN q USING (doc_id)
""",
    "op10_line_dedup": f"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
        keyed AS (SELECT *, translate(trim(line, {WHITE_SQL}), {LOWER_SQL}) AS k FROM lines),
        common AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT keyed.doc_id, pos, line, common.k IS NOT NULL AND keyed.doc_id <> last AS gone FROM keyed LEFT JOIN common USING (k))
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
