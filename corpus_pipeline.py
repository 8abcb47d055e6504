"""The training-data pipeline: STAGES in order, each a call of one operator on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.  ``run`` writes each stage's rows to the folder that all executors share and reads
them back for the next.

Rows with null or empty text fail the quality rules and go; extra columns pass through to the last
stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltrail.llm import bpe, decontaminate, quality_rules, secret_scan, simhash
from voltrail.llm.queries import vocabulary
from voltrail.llm.store import ship, written

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rules are learned from the labels of ``docs``."""
    ship(spark)
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.keep_good(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest doc_id."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their text masked."""
    ship(spark)
    return secret_scan.redact_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what the text is encoded to."""
    ship(spark)
    return bpe.digests(docs, vocabulary(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("bpe_encoding", tokens),
]
#: Learned rules, fingerprints and tokens aren't expressible in SQL: tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
