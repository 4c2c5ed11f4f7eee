"""Word and letter counts over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.stemming import stem
from tarn.functions.text import WHITESPACE, first_letters
from tarn.operators.relational import lookup, tasks_for
from tarn.session import stored


def word_rows(lines: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per white-space separated word, beside the columns to ``keep``."""
    return lines.select(*keep, F.explode(F.split(text, WHITESPACE)).alias("word")).where(
        "word <> ''"
    )


def letter_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """How many purely alphabetic words start with each letter, letters in order.

    The letters are matched out of each text directly; no row per word is made.
    """
    return (
        lines.select(F.explode(first_letters(F.col(text))).alias("letter"))
        .groupBy(F.lower("letter").alias("letter"))
        .agg(F.count("*").alias("count"))
        .orderBy("letter")
    )


def stem_vocabulary(tokens: DataFrame, token: str) -> DataFrame:
    """``(token, stem)``, stored: each different lower-cased token once, and once to the stemmer."""
    different = tokens.select(F.lower(token).alias("token")).where("token IS NOT NULL").distinct()
    return stored(different.withColumn("stem", stem("token")), "vocabulary")


def stem_counts(
    tokens: DataFrame, token: str, *keys: str, name: str = "n", vocabulary: DataFrame | None = None, weight: str | None = None
) -> DataFrame:
    """Occurrences per ``(keys, stem)`` of lower-cased tokens.

    Equal tokens of a key are counted together first; then each finds its stem in the vocabulary,
    one stored table over all keys (given, or made of these tokens). Null tokens do not count. A row
    stands for ``weight`` occurrences if that column is named. The result is dealt by ``keys``.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    counted = tokens.groupBy(*keys, F.lower(token).alias("token")).agg(n.alias("_n")).where("token IS NOT NULL")
    if not keys and vocabulary is None:  # a row a token already
        return counted.withColumn("stem", stem("token")).groupBy("stem").agg(F.sum("_n").alias(name))
    counted = stored(counted, "token-counts")
    if vocabulary is None:
        vocabulary = stem_vocabulary(counted, "token")
    stems = lookup(counted, vocabulary.select("token", "stem"), "token")
    if keys:
        stems = stems.repartition(tasks_for(counted), *keys)
    return stems.groupBy(*keys, "stem").agg(F.sum("_n").alias(name))
