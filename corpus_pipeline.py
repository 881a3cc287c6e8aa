"""From raw documents to token ids: toxicity, exact and near dedup, source mix, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. All but the last return the columns of ``documents``. A
table with repeated or null ids is handled as each operator's module says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import exact_dedup, jaccard, mixing, toxicity
from quarry.llm.common import Scratch
from quarry.llm.labels import fold
from quarry.llm.queries import tokens


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose toxicity score is 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, fold(labels["doc_id"], 5) == 0)
    return toxicity.not_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by shingle similarity of 0.8 or more."""
    return jaccard.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix of sources does, texts whole."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the decoded bytes."""
    return tokens(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: SQL can't express the learned and tokenising stages; tests/llm compares run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        kept = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
