"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontaminate, html_extract, lattice_lm, license_scan, mix, quality, secret_scan, simhash, spelling,
               suffix_dedup, token_align, warc)
from .common import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lm_scores(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licences(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix.mix(table(spark, sf_dir, "documents"), ["doc_id"])
            .selectExpr("_row.doc_id", "size", "source_size", "target", "taken"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents")).drop("spans")


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extract, op2_lm_scores, op3_license_scan, op4_quality_rules,
                                   op5_secret_scan, op6_decontaminate, op7_warc, op8_simhash_near_dedup,
                                   op9_chat_format, op10_mix_sources, op11_suffix_dedup,
                                   op12_token_align, op13_spelling_variants)}

#: The warc records themselves are Spark's and pyarrow's to write; their digests can be told in SQL.
WARC_SQL = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, url, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
m AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND (page_id IS NULL OR page_id > first) THEN first END AS refers_to, url
FROM d LEFT JOIN m ON d.payload_digest = m.payload_digest
"""

ORACLE = {"op7_warc": WARC_SQL, "op9_chat_format": chat.CHAT_SQL, "op10_mix_sources": mix.MIX_SQL}
