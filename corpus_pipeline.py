"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, PII, BPE.

Each stage takes what its predecessor kept and is written before the next one reads it. All but the last
return the columns of documents; the last returns one row for each document that stays.

Defined results: a null, empty or short text fails the quality rules; of equal and near texts the row with the smallest
doc_id stays, once, however often it is repeated; rows without a doc_id are no copies of anything; an empty table gives
no rows; extra columns, whatever their names, are passed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapweave.llm import bpe, decontaminate, near_duplicates, pii, quality
from snapweave.llm.shared import discard, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.filter_documents(docs)


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return near_duplicates.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go, word for word or by proximity."""
    return decontaminate.filter_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), near=decontaminate.Near())


def pii_sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data and the terms that disclose it are replaced in their texts."""
    return pii.sanitise(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    return bpe.encode(docs, digests=True)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicate_join), ("benchmark decontamination", benchmark_decontamination), ("PII", pii_sanitisation), ("BPE encoding and decoding", bpe_encoding)]

#: Components of a similarity graph, corpus disclosure statistics and token ids are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
        discard(before)
    return docs
