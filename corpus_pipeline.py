"""The corpus pipeline: documents to a training mix in five stages.

Each stage is one operator of ``wakeline.llm`` applied to all rows that the
stage before kept.  All stages but the last return the columns of documents.

* quality rules: documents that the rules reject go
* SimHash near-dedup: one document of each component stays
* benchmark decontamination: documents with a benchmark passage go
* secret scans: secrets are masked, the documents stay
* mixing: one row per document with what the mix takes of it

Null values, empty texts, repeated rows, empty tables and further columns are
treated as the operators' own docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import decontaminate, mix, quality, secret_scan, simhash
from wakeline.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and text of every document with size, source_size, target
    and taken: the words that the mix takes, repeats counted."""
    return mix.mix(docs, ["doc_id", "source", "text"]).selectExpr("_row.doc_id", "_row.source", "_row.text", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("mix_sources", mixing_stage),
]

#: The learned stages (hashed likelihood ratio, network) have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
