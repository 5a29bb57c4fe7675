"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelbeam.llm import (
    alignment, byte_codec, clustering, lm, mixing, ngram_join, packing, passages, quality, secret_scan, token_counts, toxicity, vector_search)
from parcelbeam.llm.common import table

#: The vocabulary file of the token operators.
VOCABULARY = "word_bpe_49k.json"
#: The rank file of byte-level encoding and decoding.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: The two tokenizers that are aligned.
SIDES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score_texts(docs, lm.fit(docs))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, SIDES))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_ngram_jaccard_join, op3_best_fit_packing, op4_secret_scans, op5_substring_dedup,
    op6_toxicity, op7_exact_top_k, op8_lm_scoring, op9_source_mixing, op10_token_counts, op11_byte_level_bpe,
    op12_tokenizer_alignment, op13_centroid_clustering)}
