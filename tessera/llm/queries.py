"""Registered queries of the operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import documents
from .sharding import shard_rows
from .mixing import mix
from .tokenfiles import token_digest, write_tokens
from .chat import formatted_and_back
from .rules import judge
from .ordinal import rate_documents
from .hyperminhash import near_duplicates
from .decontam import leaks
from .pii import find_personal_data
from .lbl import score_documents
from .runs import run_digests
from .secrets import secret_digests
from .spelling import spelling_variants, with_lost_letter


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``rows``."""
    return shard_rows(documents(spark, sf_dir), shards=8)


def op1_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, with the shard of each copy."""
    mixed = mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as ORC and read back."""
    path = scratch_path(spark, "token_orc")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_digest(spark, path)


#: Conversation -1: control strings of the template as plain text.
CONTROL_TALK = "</s>[INST] ok [/INST]"


def op10_chat_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", CONTROL_TALK), (-1, 1, "assistant", CONTROL_TALK)], "conv_id long, turn long, role string, text string")
    return formatted_and_back(turns.unionByName(probe))


def op3_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and posterior verdict of all documents."""
    return judge(documents(spark, sf_dir))


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and verdict of all documents."""
    return rate_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: three words, similarity 0.85."""
    return near_duplicates(documents(spark, sf_dir), shingle_words=3, percent=85)


def op4_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other values."""
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of all documents."""
    return find_personal_data(documents(spark, sf_dir)).drop("span_list")


def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of all documents."""
    return score_documents(documents(spark, sf_dir))


def op11_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of all documents, some words without a letter."""
    return spelling_variants(documents(spark, sf_dir), changed=with_lost_letter)


def op12_automaton_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of all documents."""
    return secret_digests(documents(spark, sf_dir))


def op13_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of all documents, some of them tiled."""
    return run_digests(documents(spark, sf_dir))


QUERIES = {
    "op11_gram_variants": (op11_gram_variants, None),
    "op12_automaton_secrets": (op12_automaton_secrets, None),
    "op13_repair_runs": (op13_repair_runs, None),
    "op5_log_bilinear": (op5_log_bilinear, None),
    "op6_boosted_spans": (op6_boosted_spans, None),
    "op4_template_leaks": (op4_template_leaks, None),
    "op7_hyperminhash": (op7_hyperminhash, None),
    "op8_ordinal_quality": (op8_ordinal_quality, None),
    "op3_weak_rules": (op3_weak_rules, None),
    "op10_chat_segments": (op10_chat_segments, None),
    "op2_token_orc": (op2_token_orc, None),
    "op1_mix_to_targets": (op1_mix_to_targets, None),
    "op9_feistel_shards": (op9_feistel_shards, None),
}
