"""The corpus operators on the driver's tables, one query each, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarn.llm import collocations, conversations, decontamination, katz, licenses, lines, mixing, privacy, quality, secrets, simhash, sql, substrings, tokens
from tarn.session import scratch_path
from tarn.sources.tables import read_table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.summary(_documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "last_word")


def op7_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(privacy.reveal(_documents(spark, sf_dir)))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_documents(spark, sf_dir)))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the documents' ids to the shared folder and describe what the files hold."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.checksums(tokens.read_tokens(spark, path))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, _documents(spark, sf_dir))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(_documents(spark, sf_dir)).drop("spans")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversation_trie(read_table(spark, sf_dir, "conversations"), rebuild=True)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


LLM_JOBS = {
    "op1_licenses": op1_licenses,
    "op2_katz": op2_katz,
    "op3_mixing": op3_mixing,
    "op4_lines": op4_lines,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_privacy": op7_privacy,
    "op8_simhash": op8_simhash,
    "op9_secrets": op9_secrets,
    "op10_tokens": op10_tokens,
    "op11_substrings": op11_substrings,
    "op12_conversations": op12_conversations,
    "op13_collocations": op13_collocations,
}

LLM_ORACLES = {
    "op1_licenses": sql.LICENSES,
    "op3_mixing": sql.MIXING,
    "op4_lines": sql.LINES,
    "op11_substrings": sql.SUBSTRINGS,
    "op12_conversations": sql.CONVERSATIONS,
    "op13_collocations": sql.COLLOCATIONS,
}
