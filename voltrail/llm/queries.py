"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from voltrail.llm import oracles
from voltrail.llm.store import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import bpe
    return bpe.digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import token_counts
    return token_counts.count_documents(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import secret_scan
    return secret_scan.digests(documents(spark, sf_dir))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import quality_rules as q
    docs = documents(spark, sf_dir)
    rules = q.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return q.judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import simhash
    return simhash.digests(documents(spark, sf_dir))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import substring_dedup
    return substring_dedup.digests(documents(spark, sf_dir))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import decontaminate
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import license_scan
    return license_scan.digests(documents(spark, sf_dir))


@query
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import html_extract
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import warc_zip
    return warc_zip.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import merkle
    return merkle.digests(documents(spark, sf_dir))


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import mixing
    return mixing.digests(documents(spark, sf_dir))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voltrail.llm import hard_negatives
    return hard_negatives.digests(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLES["op11_merkle"] = oracles.MERKLE
ORACLES["op12_mixing"] = oracles.MIXING
ORACLES["op13_hard_negatives"] = oracles.HARD_NEGATIVES
#: RFC 4648 base 32 of a SHA-1 in hex: 20 bits, 5 hex digits, are 4 characters.
_BASE32 = """array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(x, 5 * g + 1, 5) AS INTEGER) >> s) & 31), 1)
  for s in [15, 10, 5, 0]], '') for g in range(8)], '')"""
ORACLES["op2_warc"] = f"""WITH d AS (SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS x,
 max(page_id) OVER (PARTITION BY COALESCE(html, '')) AS last FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM d"""
ORACLES["op7_substring_dedup"] = r"""WITH t AS (SELECT doc_id, [x for x in string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM t),
windows AS (SELECT doc_id, p AS pos, array_to_string(w[p:p + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM t WHERE len(w) >= 20)),
again AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM again),
kept AS (SELECT x.doc_id, COUNT(g.pos) AS n_removed, string_agg(x.word, ' ' ORDER BY x.pos) FILTER (WHERE g.pos IS NULL) AS left_over
 FROM words x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.pos = x.pos GROUP BY x.doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, COALESCE(k.n_removed, 0) AS n_removed, sha256(COALESCE(k.left_over, '')) AS kept_sha256
FROM t LEFT JOIN kept k ON k.doc_id = t.doc_id"""
