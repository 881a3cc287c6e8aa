"""Registered queries of the operators in this subpackage, with DuckDB SQL
where SQL can express the result. Each query applies its operator with
production parameters to the whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, exact_dedup, hard_negatives, importance, license_scan, line_dedup, mixing
from quarry.llm.gam_quality import quality
from quarry.llm.jaccard import jaccard_join
from quarry.llm.perplexity import quality_rules
from quarry.llm.seed_dedup import seed_dedup
from quarry.llm.suffix_dedup import suffix_dedup
from quarry.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

#: the public vocabulary that operator 10 and the pipeline encode with
RANKS = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents")


def _digest(column: str) -> Column:
    return F.sha2(column, 256)


def op1_line_dedup(spark, sf):
    return line_dedup.line_dedup(_documents(spark, sf)).select(
        "doc_id", "n_lines", "n_dropped", _digest("kept_text").alias("kept_sha256"))


def op2_gam_quality(spark, sf):
    return quality(_documents(spark, sf), _table(spark, sf, "labels"))


def op3_mixing(spark, sf):
    return mixing.mix(_documents(spark, sf))


def op4_toxicity(spark, sf):
    return toxicity(_documents(spark, sf), _table(spark, sf, "labels"))


def op5_suffix_dedup(spark, sf):
    return suffix_dedup(_documents(spark, sf)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", _digest("kept").alias("kept_sha256"))


def op6_quality_rules(spark, sf):
    return quality_rules(_documents(spark, sf))


def op7_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(_documents(spark, sf))


def op8_seed_dedup(spark, sf):
    return seed_dedup(_documents(spark, sf)).select(
        "doc_id", "n_words", "n_removed", _digest("kept_text").alias("kept_sha256"))


def op9_jaccard_join(spark, sf):
    return jaccard_join(_documents(spark, sf))


def tokens(docs: DataFrame) -> DataFrame:
    """Ids of every text and the digests of the ids and of what they decode to."""
    path = public_tokenizers.path(RANKS)
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids", _digest("ids").alias("ids_sha256"), _digest("decoded").alias("decoded_sha256"))


def op10_bpe(spark, sf):
    return tokens(_documents(spark, sf)).drop("ids")


def op11_hard_negatives(spark, sf):
    by_id = F.col("vec_id")
    label = F.when(by_id % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf, "embeddings"), by_id % 50 == 0, label)


def op12_license_scan(spark, sf):
    return license_scan.license_scan(_documents(spark, sf)).drop("found")


def op13_importance(spark, sf):
    return importance.importance_resampling(_documents(spark, sf), _table(spark, sf, "benchmark"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_line_dedup, op2_gam_quality, op3_mixing, op4_toxicity, op5_suffix_dedup, op6_quality_rules, op7_exact_dedup,
    op8_seed_dedup, op9_jaccard_join, op10_bpe, op11_hard_negatives, op12_license_scan, op13_importance)}

#: operators 2, 4, 6 (learned), 5, 8, 9, 10 (beyond SQL) are tested against brute force and held-out labels
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle(),
    "op3_mixing": mixing.oracle(),
    "op7_exact_dedup": exact_dedup.oracle(),
    "op11_hard_negatives": hard_negatives.oracle(),
    "op12_license_scan": license_scan.oracle(),
    "op13_importance": importance.oracle(),
}
