"""Quality rules with risk-controlled thresholds; DataFrame functions only.

Each rule is a share (0..1) of a text of which a large value is bad. For every stratum (language)
and rule, a cutoff on a fixed grid is valid if the labelled good documents prove by an exact
binomial bound that it rejects at most ``max_false / rules`` of the good ones. The error
probability ``delta`` is divided by the number of all tests (strata x rules x grid), so with
probability 1 - delta no stratum loses more than ``max_false`` of its good documents, whichever
valid cutoffs are chosen. Chosen is the one that rejects the most of the bad labels less the share
of good ones. The rules are fixed beforehand and nothing is fitted: all labels are holdout.

A trial of the bound is a distinct text of a stratum, however many labelled documents hold it, since
copies are no independent trials: what is proven is the share of distinct good texts. Texts that
are merely similar still count as several.

Defined results: a null text has no words and fails the base rules; a null stratum is a stratum
of its own; a stratum with too few good labels to prove anything, or no bad ones, gets no cutoff
and keeps what the base rules keep; a document labelled both good and bad counts as good; a text counts as good
if any of its documents does; labels without a document or a quality are left out; repeated
documents are judged alike; an empty table gives an empty result; other columns, whatever their names, stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import GAP, UPPER, fresh, let, split_words, store

#: Cutoffs 0, 1/GRID, 2/GRID .. of every rule.
GRID = 64
#: Largest share of a stratum's good documents that all rules together may reject, and the
#: probability with which that may fail anywhere.
MAX_FALSE = 0.05
DELTA = 0.05
MIN_WORDS = 50

#: The rules: two counts of a text, of which the first is a part of the second.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
}


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    31 bits of a window's hash and its position form one long each. Sorted, windows of one hash
    stand side by side; only those are then compared as texts. Linear but for the sorts.
    """

    def gram(w, i):
        return F.concat_ws(" ", w[i], w[i + 1], w[i + 2])

    def coded(w):
        codes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.shiftleft(F.xxhash64(w[i], w[i + 1], w[i + 2]), 32).bitwiseOR(i.cast("bigint")),
        )
        return F.sort_array(codes)

    def beside(s, same):
        last = F.size(s) - 1
        return F.filter(
            s, lambda x, j: ((j > 0) & same(x, s[F.greatest(j - 1, F.lit(0))])) | ((j < last) & same(x, s[F.least(j + 1, last)]))
        )

    def candidates(w):
        same_hash = lambda a, b: F.shiftright(a, 32) == F.shiftright(b, 32)
        return let(coded(w), lambda s: F.transform(beside(s, same_hash), lambda x: x.bitwiseAND(0xFFFFFFFF).cast("int")))

    def positions(w):
        named = F.array_sort(F.transform(candidates(w), lambda i: F.struct(gram(w, i).alias("gram"), i.alias("at"))))
        twice = let(named, lambda s: beside(s, lambda a, b: a["gram"] == b["gram"]))
        return F.array_sort(F.transform(twice, lambda x: x["at"]))

    def covered(p):
        last = F.size(p) - 1
        each = F.transform(p, lambda at, j: F.when(j == last, 3).otherwise(F.least(F.lit(3), p[F.least(j + 1, last)] - at)))
        return F.aggregate(each, F.lit(0).cast("bigint"), lambda total, n: total + n)

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(let(positions(w), covered)))


def _without(text: Column, marks: str) -> Column:
    """How many characters of the text are among ``marks``."""
    return (F.length(text) - F.length(F.translate(text, marks, ""))).cast("bigint")


def counts(text: Column) -> Column:
    """All counts of a text as one struct. A null text counts as empty."""

    def of(t):
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        by_line = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        by_word = let(split_words(t), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("dup")))
        return F.struct(
            by_word["n"].cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(t, GAP, "")).cast("bigint").alias("word_chars"),
            _without(t, "#*$%&|<>").alias("n_symbols"),
            by_line["dup"].cast("bigint").alias("n_dup_lines"),
            by_word["dup"].cast("bigint").alias("n_repeat_words"),
            by_line["n"].cast("bigint").alias("n_lines"),
            _without(t, UPPER).alias("n_capitals"),
        )

    return let(F.coalesce(text, F.lit("")), lambda t: let(of(t), lambda c: c))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def level(c: Column, rule: str) -> Column:
    """The largest cutoff (in steps of the grid) that rejects this text; -1 if none does."""
    part, whole = RULES[rule]
    return F.least(F.ceil(c[part] * GRID / F.greatest(c[whole], F.lit(1))) - 1, F.lit(GRID - 1)).cast("int")


def allowed(n: Column, tests: Column, max_false: float, delta: float) -> Column:
    """The largest k with P(Binomial(n, max_false) <= k) <= delta / tests; -1 if there is none.

    To see only k of n good documents rejected then shows, at that error level, a true rate below
    ``max_false``. The terms are summed as logarithms, each from the one before; k stays below the mean.
    """
    odds = math.log(max_false) - math.log1p(-max_false)
    first = n * math.log1p(-max_false)
    start = F.struct(first.alias("term"), first.alias("sum"), F.lit(-1).cast("bigint").alias("k"))
    bound = F.log(F.lit(delta) / tests)

    def step(s, i):  # term and sum are those of i
        term = s["term"] + F.log((n - i).cast("double") / (i + 1)) + odds
        top = F.greatest(s["sum"], term)
        total = top + F.log(F.exp(s["sum"] - top) + F.exp(term - top))
        return F.struct(
            term.alias("term"), total.alias("sum"), F.when(s["sum"] <= bound, i).otherwise(s["k"]).alias("k")
        )

    steps = F.sequence(F.lit(0).cast("bigint"), F.floor(n * max_false).cast("bigint"))
    return F.aggregate(steps, start, step, lambda s: s["k"])


def cutoffs(judged: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, delta: float = DELTA) -> DataFrame:
    """``(stratum, rule, n_good, max_rejects, rejects, cutoff)`` of each rule that gets a cutoff.

    ``judged`` has ``doc_id, stratum, text_hash, base_failed`` and the level of each rule. Only documents
    that the base rules keep count, since the rules work on those; ``n_good`` counts their distinct texts.
    """
    labelled = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    rule = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("level")) for name in RULES]))
    held = judged.filter(~F.col("base_failed")).join(labelled, "doc_id").groupBy("stratum", "text_hash")
    # documents of one text have the same levels
    held = held.agg(F.max("good").alias("good"), *[F.max(name).alias(name) for name in RULES]).select("stratum", "good", rule.alias("r"))
    by_level = store(
        held.groupBy("stratum", "r.rule", "r.level").agg(
            F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
        ),
        "quality-levels",
    )
    tests = F.lit(by_level.select("stratum").distinct().count() * len(RULES) * GRID)
    # at most GRID + 1 rows a group
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("level"))
    whole = Window.partitionBy("stratum", "rule")
    rejecting = by_level.select(
        "stratum",
        "rule",
        F.col("level").alias("cutoff"),
        F.sum("good").over(above).alias("rejects"),
        F.sum("bad").over(above).alias("bad_rejects"),
        F.sum("good").over(whole).alias("n_good"),
        F.sum("bad").over(whole).alias("n_bad"),
    )
    sizes = rejecting.select("stratum", "rule", "n_good").distinct()
    limits = sizes.withColumn("max_rejects", allowed(F.col("n_good"), tests, max_false / len(RULES), delta))
    same = F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r"))
    limits = limits.select(F.col("stratum").alias("s"), F.col("rule").alias("r"), "max_rejects")
    # bad_rejects / n_bad - rejects / n_good in whole numbers, so that ties are ties
    gain = F.col("bad_rejects") * F.col("n_good") - F.col("rejects") * F.col("n_bad")
    valid = rejecting.join(limits, same).withColumn("gain", gain)
    valid = valid.filter("cutoff >= 0 AND rejects <= max_rejects AND gain > 0")
    best = F.max_by(F.struct("cutoff", "rejects"), F.struct("gain", "cutoff"))
    return valid.groupBy("stratum", "rule", "n_good", "max_rejects").agg(best.alias("best")).select(
        "stratum", "rule", "n_good", "max_rejects", "best.rejects", "best.cutoff"
    )


def _scored(docs: DataFrame) -> DataFrame:
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    counted = docs.select("doc_id", F.col("lang").alias("stratum"), text_hash.alias("text_hash"), counts(F.col("text")).alias("c"))
    c = F.col("c")
    levels = [level(c, name).alias(name) for name in RULES]
    return store(counted.select("doc_id", "stratum", "text_hash", "c.*", base_failed(c).alias("base_failed"), *levels), "quality-counts")


def _by_stratum(chosen: DataFrame) -> DataFrame:
    """One row a stratum; a rule without a cutoff gets one above every level."""
    limit = [F.coalesce(F.min(F.when(F.col("rule") == name, F.col("cutoff"))), F.lit(GRID)) for name in RULES]
    return store(
        chosen.groupBy("stratum").agg(F.struct(*[x.alias(name) for x, name in zip(limit, RULES)]).alias("limits")), "quality-cutoffs"
    )


def _broken(limits: Column, levels: dict[str, Column]) -> Column:
    """The names of the rules broken; a stratum without limits breaks none."""
    return F.array_compact(F.array(*[F.when(x >= limits[name], F.lit(name)) for name, x in levels.items()]))


def judge(docs: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, delta: float = DELTA) -> DataFrame:
    """One row a document: its counts, ``base_failed``, ``kept`` and the names of the rules it breaks."""
    scored = _scored(docs)
    limits = _by_stratum(cutoffs(scored, labels, max_false, delta)).withColumnRenamed("stratum", "of")
    joined = scored.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left")
    broken = _broken(F.col("limits"), {name: F.col(name) for name in RULES})
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"),
        F.array_join(broken, ",").alias("broken"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, delta: float = DELTA) -> DataFrame:
    """The documents that all rules keep, with all their columns.

    The texts are counted twice, once for the thresholds and once to apply them, and never shuffled.
    """
    of, limits = fresh(docs, "quality_stratum", "quality_limits")
    table = _by_stratum(cutoffs(_scored(docs), labels, max_false, delta)).toDF(of, limits)
    joined = docs.join(table, F.col("lang").eqNullSafe(F.col(of)), "left")

    # one expression, so that no rewriting of the filter counts a text more than once
    def keeps(c):
        return ~base_failed(c) & (F.size(_broken(F.col(limits), {name: level(c, name) for name in RULES})) == 0)

    return joined.filter(let(counts(F.col("text")), keeps)).select(*docs.columns)
