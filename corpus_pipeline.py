"""The corpus pipeline: quality, boilerplate, near duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
``run`` writes each stage's result as Parquet on shared storage and rereads
it as the next one's docs.  All stages but the last return the columns of
``documents``.  Every stage handles what its operator handles (nulls in any
column, empty and very long texts, repeated rows, empty tables, extra columns).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontaminate, jaccard, lines, pieces, quality
from touchline.llm.queries import PIECE_MODEL
from touchline.llm.shared import store, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant accepts (score of 0.7 or more)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; no document goes."""
    return lines.clean(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their count, and digests of ids and decoded text."""
    return pieces.encode(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: SQL cannot express the classifier, so tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace('_', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
