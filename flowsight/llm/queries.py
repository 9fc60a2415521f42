"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .ann import nearest_report
from .bpe import round_trip_report
from .collocations import collocations
from .common import table
from .digest import digest_report
from .hard_negatives import hard_negative_report
from .html_extract import extract
from .langid import language_report
from .line_dedup import line_dedup_report
from .packing import pack_documents
from .quality import quality_report
from .sharding import sharding_report
from .simhash import simhash_report
from .sql import COLLOCATIONS, HARD_NEGATIVES, LINE_DEDUP
from .substring_dedup import document_report


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_report(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_report(table(spark, sf_dir, "embeddings"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_report(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negative_report(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_line_dedup": op7_line_dedup,
    "op3_simhash": op3_simhash,
    "op10_bpe": op10_bpe,
    "op6_packing": op6_packing,
    "op9_language": op9_language,
    "op4_quality": op4_quality,
    "op2_digest": op2_digest,
    "op8_html": op8_html,
    "op1_nearest": op1_nearest,
    "op5_substring": op5_substring,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}

ORACLES: dict[str, str] = {
    "op7_line_dedup": LINE_DEDUP,
    "op11_collocations": COLLOCATIONS,
    "op12_hard_negatives": HARD_NEGATIVES,
}
