"""Thin queries ``opN_<name>``: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .decontaminate import benchmark_matches
from .html_extract import main_text
from .language_id import language_id
from .license_scan import license_scan
from .ngram_jaccard import ngram_jaccard
from .ordinal import quality_classifier
from .packing import pack_documents
from .perplexity import perplexity_filter
from .suffix_dedup import suffix_dedup
from .url_filter import page_ratings, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, page_ratings(pages, _table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_filter(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_license_scan": op4_license_scan,
    "op5_perplexity": op5_perplexity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
}

ORACLES: dict[str, str] = {
    "op7_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
}
