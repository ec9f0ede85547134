"""The corpus pipeline: documents to token files in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last give the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import documents, saved
from tessera.llm.decontam import without_leaks
from tessera.llm.hyperminhash import one_of_each
from tessera.llm.mixing import mixed_documents
from tessera.llm.ordinal import good_documents
from tessera.llm.tokenfiles import token_digest, write_tokens
from tessera.session import scratch_path

#: Words of the mix as a share of all words that reach it. Sources weigh 5, 2
#: and 1 in turn; no source is taken more than twice.
MIX_SHARE = 1.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach the best grade; the others go."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return one_of_each(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them."""
    return mixed_documents(docs, weights=(5, 2, 1), share=MIX_SHARE, max_repeat=2)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold of each document."""
    path = scratch_path(spark, "pipeline_tokens")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_digest(spark, path)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: The stages fit a model, hash and encode; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
