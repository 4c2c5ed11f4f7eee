"""Mixing sources to target weights by hash thresholds; DataFrame functions only.

A document's place in its source is a 60-bit hash. Words are summed by source and hash bucket,
the bucket in which a source's budget ends is found, and only the documents of that bucket are
summed again by the next bits. A source needs no sort: a document is in the mix when its hash
lies below the threshold of its source. Thresholds of different budgets are nested, so a smaller
budget takes a subset of what a larger one takes.

Defined results: a null text has no words; a null source is a source of its own (last in code
point order); rows equal in id and text have one hash and go together; a source without words
has the target 0; an empty table gives an empty mix; other columns, whatever their names, are
left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import fresh, store, word_count

HASH_BITS = 60
#: Bits of one level of the histogram: at most 4096 rows a source.
LEVEL_BITS = 12


def source_key(source: Column) -> Column:
    """A not-null key in code point order, a null source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def place(doc_id: Column, text: Column) -> Column:
    """The document's hash, 0 <= place < 2**60, the same in every run."""
    content = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(content), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def cycle_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights dealt in turn to the sources by key order (one row a source in the window)."""
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))


def targets(sources: DataFrame, cap: int = 3) -> DataFrame:
    """``(key, source_size, weight)`` -> also ``target``: all words dealt out by weight.

    A target stops at ``cap`` times its source; what is over is dealt again to the others by
    weight until none is above. Each round is one sum over the sources; two numbers reach the driver.
    """
    limit = F.col("source_size") * cap
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight, full_size, full_weight = total or 0, weight or 0, 0, 0
    while True:
        left, right = total - full_size, weight - full_weight
        full = limit.cast("double") * right <= F.col("weight").cast("double") * left
        row = sources.filter(full).agg(F.sum(limit), F.sum("weight")).first()
        found = (row[0] or 0, row[1] or 0)
        if found == (full_size, full_weight) or right <= 0:
            break
        full_size, full_weight = found
    shared = F.col("weight") * F.lit(left).cast("double") / F.lit(max(right, 1))
    return sources.withColumn("target", F.when(full, limit.cast("double")).otherwise(shared))


def thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source how often all its documents are taken, and the hash below which once more.

    ``sized`` has ``key, place, size``; ``sources`` has ``key, source_size, target``. The group of
    documents in which the budget ends (one hash) is taken if that leaves the source nearer its target.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    open_ = store(
        sources.select(
            "key",
            rounds.cast("bigint").alias("rounds"),
            (F.col("target") - rounds * F.col("source_size")).alias("budget"),
            F.lit(0).cast("bigint").alias("prefix"),
            F.lit(0).cast("bigint").alias("before"),
        ),
        "mix-open",
    )
    done, rest = [], sized.select("key", "place", "size")
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - (level + 1) * LEVEL_BITS
        bucket = F.shiftright("place", shift)
        sums = rest.groupBy("key", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        running = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("size").over(running))
        hit = (
            sums.join(open_, "key")
            .withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
            .filter((F.col("start") <= F.col("budget")) & (F.col("budget") < F.col("start") + F.col("size")))
        )
        found = store(
            hit.select(
                "key", "rounds", "budget", "size", F.col("bucket").alias("prefix"), F.col("start").alias("before"), "first", "last"
            ),
            "mix-level",
        )
        single = F.col("first") == F.col("last")
        nearer = 2 * F.col("before") + F.col("size") <= 2 * F.col("budget")
        done.append(found.filter(single).select("key", "rounds", (F.col("last") + nearer.cast("bigint")).alias("below")))
        open_ = found.filter(~single).select("key", "rounds", "budget", "prefix", "before")
        if open_.isEmpty():
            break
        rest = rest.withColumn("prefix", bucket).join(open_.select("key", "prefix"), ["key", "prefix"], "left_semi").drop("prefix")
    ends = reduce(DataFrame.unionAll, done)
    nothing = sources.join(ends, "key", "left_anti").select("key", rounds.cast("bigint").alias("rounds"), F.lit(0).cast("bigint").alias("below"))
    return store(ends.unionAll(nothing), "mix-thresholds")


def times(rounds: Column, below: Column, place_: Column) -> Column:
    return rounds + (place_ < below).cast("bigint")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> tuple[DataFrame, DataFrame]:
    """The sized documents ``(doc_id, source, key, size, place)`` and their sources' plan.

    The texts are read once; later passes read the stored sizes and hashes.
    """
    sized = store(
        docs.select(
            "doc_id",
            source_key(F.col("source")).alias("key"),
            word_count(F.col("text")).alias("size"),
            place(F.col("doc_id"), F.col("text")).alias("place"),
        ),
        "mix-sized",
    )
    sums = store(sized.groupBy("key").agg(F.sum("size").alias("source_size")), "mix-sources")
    sources = store(targets(store(cycle_weights(sums, weights), "mix-weights"), cap), "mix-targets")
    plan = sources.join(thresholds(sized, sources), "key")
    return sized, store(plan, "mix-plan")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row a document: ``doc_id, size, source_size, target, taken``."""
    sized, plan = plan_mix(docs, weights, cap)
    return sized.join(plan, "key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times(F.col("rounds"), F.col("below"), F.col("place"))).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with all their columns.

    A document without words takes no part in the sums and follows the threshold like the others.
    """
    _, plan = plan_mix(docs, weights, cap)
    key, rounds, below, copy = fresh(docs, "mix_key", "mix_rounds", "mix_below", "mix_copy")
    plan = plan.select(F.col("key").alias(key), F.col("rounds").alias(rounds), F.col("below").alias(below))
    n = times(F.col(rounds), F.col(below), place(F.col("doc_id"), F.col("text")))
    placed = docs.withColumn(key, source_key(F.col("source"))).join(plan, key)
    return placed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), n.cast("int")))).select(*docs.columns)
