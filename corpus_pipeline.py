"""Training-corpus pipeline: quality rules, near-duplicate removal, secret redaction, source mixing,
BPE encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return the
columns of ``docs``; the last returns token ids.

Defined results, each stage: null texts count as empty; empty tables give empty tables; columns
beyond those named pass through under any name; rows with null ids are rows like others; equal rows
are judged alike (and near-duplicate removal leaves one of them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kardex.llm import bpe, jaccard_join, mixing, quality, secret_scan
from kardex.llm.common import shared_path
from kardex.llm.queries import table, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    kept, _ = quality.accepted(docs, table(spark, sf_dir, "labels"))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    return jaccard_join.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, reported spans masked; ``n_chars`` follows the text where it changed."""
    return secret_scan.redact(docs, secret_scan.report(docs), length="n_chars" if "n_chars" in docs.columns else None)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training positions."""
    return mixing.mixed_rows(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every training sample, in the order of the mix."""
    return bpe.encode(docs, vocabulary(), keep=("doc_id", "source"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mixing_to_targets),
    ("bpe encoding", bpe_encoding),
]

# Learned rules, MinHash classes and BPE have no SQL form; tests/llm/test_pipeline.py holds run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        path = shared_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage_of(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
