"""One query per numbered operator, over its whole table, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytepairs, decontaminate, jaccard, lines, pieces, quality, sharding, tokenfile, trie, variants, vectors, warc
from .shared import scratch, table

SHARD_BYTES = 1 << 20
TOKEN_LIMIT = 4096
PIECE_MODEL, WORD_MODEL, BYTE_MODEL = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = pieces.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), scratch(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), ids=False)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    manifest = tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_MODEL), folder)
    return tokenfile.read(spark, folder, manifest, ids=False).withColumnRenamed("id", "doc_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch(spark, "warc")
    manifest = warc.write(warc.chunks(pages, warc.decide(pages)), folder)
    return warc.pages(warc.read(spark, folder, manifest, data=False))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs).select("doc_id", "source", "n_lines", "n_dropped", "text")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_MODEL), ids=False)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_ngram_jaccard, op3_sharding, op4_sentencepiece, op5_decontamination,
                                   op6_token_files, op7_warc, op8_embedding_near_dedup, op9_quality, op10_line_dedup,
                                   op11_byte_bpe, op12_spelling_variants, op13_prefix_trie)}
ORACLES = {"op3_sharding": sharding.oracle(SHARD_BYTES), "op5_decontamination": decontaminate.ORACLE,
           "op10_line_dedup": lines.ORACLE}
