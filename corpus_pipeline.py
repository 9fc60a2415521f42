"""The corpus pipeline: documents of a known language, lines, texts and passages once each, packed.

STAGES are applied in order, each to all that the one before has kept and written. The first four
return the columns of documents, `text` and `n_chars` as they are then; the last returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowsight.llm.common import table, written
from flowsight.llm.langid import keep_known_language
from flowsight.llm.line_dedup import dedup_lines
from flowsight.llm.packing import pack_documents
from flowsight.llm.simhash import keep_one_of_each
from flowsight.llm.substring_dedup import drop_repeated_passages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that fills a third of them, go."""
    return keep_known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; the document stays."""
    return dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest id stays."""
    return keep_one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id holds go; the document stays."""
    return drop_repeated_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("passages", passages),
    ("packing", packing),
]

# Trained models, fingerprints and tokens are beyond SQL: tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
