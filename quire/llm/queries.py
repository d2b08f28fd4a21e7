"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, collocations, divergence, html_extract, jaccard_join, language_id, licenses, line_dedup, mixing, pii, pipeline, quality, secret_scan
from .common import read, sha256_hex, word_bpe_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("text")).alias("kept_sha256"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), n=3, threshold=(90, 100))
    return out.select("doc_id", "n_shingles", "component_id", "class_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("th")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(read(spark, sf_dir, "pages"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"), word_bpe_path(), full=False)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read(spark, sf_dir, "documents"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.quire.pii.key``; without one, a key drawn for this call alone, which nobody keeps."""
    key = spark.conf.get("spark.quire.pii.key", None)
    return pii.pseudonymise_documents(read(spark, sf_dir, "documents"), key.encode() if key else secrets.token_bytes(32))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_language_id": op3_language_id,
    "op4_source_mixing": op4_source_mixing,
    "op5_html_extraction": op5_html_extraction,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_bpe": op7_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_license_scan": op11_license_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline.run,
}
