"""The operators as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldrec.llm import (
    bpe, decontaminate, fingerprint, hard_negatives, jaccard_join, langid, quality, secret_scan, sharding, spelling, token_count, url_filter,
    warc,
)
from goldrec.llm.common import read_table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_languages(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_quality(
        read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op11_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"]))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join, op2_warc, op3_language_id, op4_url_filter, op5_sharding, op6_decontamination, op7_quality,
        op8_secret_scan, op9_fingerprint, op10_bpe, op11_token_count, op12_hard_negatives, op13_spelling,
    )
}
SQL = {"op4_url_filter": url_filter.SQL, "op12_hard_negatives": hard_negatives.SQL, "op13_spelling": spelling.SQL}
