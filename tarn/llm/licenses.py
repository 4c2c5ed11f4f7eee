"""License scans by an exact set-similarity join of text blocks with license templates.

A text is cut into overlapping blocks of ``2 * step`` words that begin every ``step`` words, with the
smallest step (8, 16, 32 ...) not below a template's number of words, so that a notice always lies
whole in some block. A block meets a template if it holds at least ``threshold`` of the template's
distinct words. All words are ordered by their count in the corpus, the rarest first. Of a template
with t words of which r must be found, at least one of the first t - r + 1 must be in the block:
those are joined with the words of the corpus. What the join finds is checked by length (a block
needs r words of the templates' vocabulary), by position (after the first common word, both sides
must have enough words left), and last by the overlap itself. The result is that of comparing all
blocks with all templates.

Fixed phrases are looked for besides; their labels are the base labels.

Defined results: a null text is empty; rows equal in id and text are treated alike; templates
without words match nothing; an empty table gives an empty result; a long text has many blocks of
bounded size; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarn.llm.common import ascii_lower, let, small, split_words, store

#: What stands between words, after A-Z were made lower case.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9
LEAST_STEP = 8

PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

KEY = ["doc_id", "text_hash"]


def _words(text: Column) -> Column:
    return split_words(ascii_lower(text), NOT_WORD)


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "label string, text string")


def _prepared(templates: DataFrame) -> DataFrame:
    """``(template, label, tokens, step)``, stored. Templates are a small table by nature."""
    rows = templates.select("label", _words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    step = F.greatest(F.lit(LEAST_STEP), F.pow(F.lit(2), F.ceil(F.log2(F.size("words")))).cast("int"))
    rows = rows.select("label", F.array_sort(F.array_distinct("words")).alias("tokens"), step.alias("step")).distinct()
    return store(rows.withColumn("template", F.xxhash64("label", "tokens", "step")), "license-templates")


def _scan(docs: DataFrame, vocabulary: list[str], phrases: dict[str, str]) -> DataFrame:
    """Stored counts of every document, and where words of the vocabulary stand. Reads the texts once."""
    parts = {tuple(phrase.split(" ")): label for phrase, label in phrases.items()}
    known = sorted({*vocabulary, *(p[0] for p in parts)})

    def scanned(w):
        hits = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("at"), x.alias("token"))), lambda h: h["token"].isin(known))

        def places(h):
            found = [
                F.transform(
                    F.filter(h, lambda x: (x["token"] == words[0]) & (F.slice(w, x["at"] + 1, len(words)) == F.array(*map(F.lit, words)))),
                    lambda x: F.struct(x["at"].alias("at"), F.lit(label).alias("label")),
                )
                for words, label in parts.items()
            ]
            return F.struct(F.size(w).cast("bigint").alias("n_words"), h.alias("hits"), F.concat(*found).alias("base"))

        return let(hits, places)

    found = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        let(_words(F.coalesce("text", F.lit(""))), scanned).alias("s"),
    )
    return store(found.select(*KEY, "s.n_words", "s.hits", "s.base"), "license-scan")


def matches(scanned: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_hash, label, template, first_word, end_word, containment)`` of every block that meets a template."""
    words = scanned.select(*KEY, F.explode("hits").alias("h")).select(*KEY, "h.at", "h.token")
    counts = words.groupBy("token").agg(F.count("*").alias("count"))
    tokens = templates.select("template", "step", F.size("tokens").alias("t"), F.explode("tokens").alias("token"))
    known = tokens.select("token").distinct().join(counts, "token", "left").select("token", F.coalesce("count", F.lit(0)).alias("count"))
    # the global order, over the templates' vocabulary: no other word can be common
    ranks = store(known.select("token", F.row_number().over(Window.orderBy("count", "token")).alias("rank")), "license-ranks")
    needed = F.ceil(F.col("t") * threshold - 1e-9).cast("int")
    place = F.row_number().over(Window.partitionBy("template").orderBy("rank"))
    ordered = tokens.join(ranks, "token").withColumn("needed", needed).withColumn("i", place)
    prefix = ordered.filter(F.col("i") <= F.col("t") - F.col("needed") + 1)
    prefix = small(store(prefix.select("token", "template", "step", "t", "needed", "i", "rank"), "license-prefix"), 64)
    block = F.explode(F.array_distinct(F.array(F.floor(F.col("at") / F.col("step")), F.greatest(F.floor(F.col("at") / F.col("step")) - 1, F.lit(0)))))
    met = words.join(prefix, "token").select(*KEY, "template", "step", "t", "needed", "i", "rank", block.alias("block"))
    first = F.min_by(F.struct("i", "rank"), "i")
    candidates = met.groupBy(*KEY, "template", "step", "t", "needed", "block").agg(first.alias("first")).select(
        *[F.col(c).alias(f"c_{c}") for c in KEY], "template", "step", "t", "needed", "block", "first.i", "first.rank"
    )
    candidates = store(candidates, "license-candidates")
    same = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("text_hash") == F.col("c_text_hash"))
    begin = F.col("block") * F.col("step")
    rows = scanned.select(*KEY, "hits").dropDuplicates(KEY).join(small(candidates, 80), same).select(
        *KEY, "template", "step", "t", "needed", "block", "i", F.col("rank").alias("first_rank"),
        F.explode(F.array_distinct(F.transform(F.filter("hits", lambda h: (h["at"] >= begin) & (h["at"] < begin + 2 * F.col("step"))), lambda h: h["token"]))).alias("token"),
    )
    group = [*KEY, "template", "step", "t", "needed", "block", "i"]
    sets = rows.join(small(ranks, 64), "token").groupBy(*group).agg(
        F.collect_set("token").alias("block_tokens"), F.count_if(F.col("rank") > F.col("first_rank")).alias("after")
    )
    by_length = F.size("block_tokens") >= F.col("needed")
    by_position = 1 + F.least(F.col("t") - F.col("i"), F.col("after")) >= F.col("needed")
    overlap = F.size(F.array_intersect("block_tokens", "tokens"))
    found = sets.filter(by_length & by_position).join(small(templates.select("template", "label", "tokens"), 2048), "template")
    return found.withColumn("overlap", overlap).filter("overlap >= needed").select(
        *KEY, "label", "template", begin.alias("first_word"), (begin + 2 * F.col("step")).alias("end_word"), (F.col("overlap") / F.col("t")).alias("containment")
    )


def scan(
    docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None
) -> DataFrame:
    """One row a document: ``doc_id, n_words``, its base places and labels, all ``labels``, ``score``
    (the best containment; 1 for a base phrase; 0 for nothing) and the number of matching blocks."""
    prepared = _prepared(default_templates(docs.sparkSession) if templates is None else templates)
    # the vocabulary of the templates, bounded by their table
    vocabulary = [r.token for r in prepared.select(F.explode("tokens").alias("token")).distinct().collect()]
    scanned = _scan(docs, vocabulary, PHRASES if phrases is None else phrases)
    by_doc = matches(scanned, prepared, threshold).groupBy(*KEY).agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"), F.count("*").alias("n_blocks")
    )
    by_doc = store(by_doc, "license-matches").toDF("m_id", "m_hash", "found", "best", "n_blocks")
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
    places, base = F.transform("base", lambda b: b["at"]), F.array_distinct(F.transform("base", lambda b: b["label"]))
    labels = F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))
    return scanned.join(by_doc, same, "left").select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"),
        F.array_max(places).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )
