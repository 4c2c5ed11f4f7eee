"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Every three consecutive words of the corpus are looked up among those of the benchmark items, one
hash join in one pass over the texts. An item's seeds are the rarer part of its n-grams, by their
count in this corpus: relative to the item, so that a passage that very many documents hold keeps
its seeds. Wherever a seed is found, the words around it are aligned with the item's; edited,
shortened and lengthened copies score by the words that still match in order. The score of a
verbatim copy is 1; unrelated texts that share a phrase stay far below the threshold of a half.

Defined results: null texts and null items have no words; an item of fewer than three words is no
evidence and never matches; items without an id match like any other, with a null id; repeated
documents are reported once a distinct (id, text), repeated items once an id; empty tables give an
empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import fresh, let, small, split_words, store

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED_WORDS = 3
#: Share of an item's n-grams, the rarest, that serve as seeds.
RARE = 0.75
THRESHOLD = 0.5
#: Price of a changed, missing or added word; a matching word earns 1.
PRICE = 0.5
#: Start positions of a passage are gathered in stretches of so many words.
STRETCH = 64
#: Cells of one batch of alignments, a bound on a worker's memory.
CELLS = 1 << 20

KEY = ["doc_id", "text_hash"]


def _words(text: Column) -> Column:
    return split_words(F.lower(text), NOT_WORD)


def _grams(words: Column, n: int) -> Column:
    """Hashes of all n consecutive words, in order."""

    def of(w):
        hashed = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)]))
        return F.when(F.size(w) >= n, hashed).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), _words(F.col("text")).alias("words"))


def _align(long: np.ndarray, short: np.ndarray, sizes: np.ndarray, price: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local alignment of rows of word numbers: best score, and where it ends in both.

    ``short`` is padded with -2 beyond ``sizes``, ``long`` with -1. One step a word of the item for
    all rows at once; gaps along the text are a running maximum.
    """
    slope = price * np.arange(long.shape[1])
    rows = np.arange(len(long))
    above = np.zeros(long.shape)
    best, end, item_end = np.zeros(len(long)), np.zeros(len(long), dtype=np.int64), np.zeros(len(long), dtype=np.int64)
    for i in range(short.shape[1]):
        diagonal = np.zeros(long.shape)
        diagonal[:, 1:] = above[:, :-1]
        here = np.maximum(diagonal + np.where(long == short[:, i : i + 1], 1.0, -price), above - price)
        here = np.maximum.accumulate(np.maximum(here, 0) + slope, axis=1) - slope
        at = here.argmax(axis=1)
        better = (here[rows, at] > best) & (i < sizes)
        best[better], end[better], item_end[better] = here[rows, at][better], at[better], i
        above = here
    return best, end, item_end


def _score(batches: Iterator[pa.RecordBatch], price: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, items = batch.column("passage").to_pylist(), batch.column("item").to_pylist()
        start, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
        last = np.zeros(len(texts), dtype=np.int64)
        order = sorted(range(len(texts)), key=lambda r: (len(items[r]), len(texts[r])))
        while order:
            width = len(texts[order[-1]])
            part, order = order[-max(1, CELLS // max(width, 1)) :], order[: -max(1, CELLS // max(width, 1))]
            sizes = np.array([len(items[r]) for r in part])
            width = max(len(texts[r]) for r in part)
            long, short = np.full((len(part), width), -1), np.full((len(part), sizes.max()), -2)
            for k, r in enumerate(part):
                number = {w: n for n, w in enumerate(items[r])}
                long[k, : len(texts[r])] = [number.get(w, -1) for w in texts[r]]
                short[k, : len(items[r])] = [number[w] for w in items[r]]
            best, end, item_end = _align(long, short, sizes, price)
            # the same alignment read backwards from its end gives its start
            back_long, back_short = np.full_like(long, -1), np.full_like(short, -2)
            for k in range(len(part)):
                back_long[k, : end[k] + 1] = long[k, end[k] :: -1] if end[k] else long[k, :1]
                back_short[k, : item_end[k] + 1] = short[k, item_end[k] :: -1] if item_end[k] else short[k, :1]
            _, length, _ = _align(back_long, back_short, item_end + 1, price)
            score[part], last[part], start[part] = best / sizes, end, end - length
        offset = batch.column("from").to_numpy()
        out = {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "item_id": batch.column("item_id")}
        out |= {"score": pa.array(score), "first_word": pa.array(start + offset), "last_word": pa.array(last + offset)}
        yield pa.RecordBatch.from_pydict(out)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, rare: float = RARE, price: float = PRICE
) -> DataFrame:
    """``(doc_id, text_hash, item_id, score, first_word, last_word)`` of each document and item that align.

    Words are numbered from 0. Of several passages with the same item the best is reported.
    """
    n = SEED_WORDS
    items = benchmark.select("item_id", _words(F.col("text")).alias("item")).filter(F.size("item") >= n).distinct()
    items = store(items.withColumn("item_key", F.xxhash64("item_id", "item")), "decon-items")
    grams = items.select("item_key", F.size("item").alias("length"), F.posexplode(_grams(F.col("item"), n)).alias("at", "gram"))
    grams = store(grams, "decon-grams")
    known = small(store(grams.select("gram").distinct(), "decon-known"), 16)
    places = _keyed(docs).select(*KEY, F.posexplode(_grams(F.col("words"), n)).alias("pos", "gram"))
    hits = store(places.join(known, "gram"), "decon-hits")
    # seeds: the rarest n-grams of each item, all that tie with the last included
    by_count = grams.join(hits.groupBy("gram").agg(F.count("*").alias("count")), "gram")
    window = Window.partitionBy("item_key")
    ranked = by_count.select(
        "*", F.rank().over(window.orderBy("count")).alias("rank"), F.count("*").over(window).alias("found")
    )
    seeds = store(ranked.filter(F.col("rank") <= F.ceil(F.col("found") * rare)).select("gram", "item_key", "at", "length"), "decon-seeds")
    stretch = F.floor((F.col("pos") - F.col("at")) / STRETCH).cast("int")
    # a passage may begin anywhere in a stretch and be longer than the item by half
    begin = F.greatest(stretch * STRETCH - F.col("length"), F.lit(0))
    places = hits.join(small(seeds, 40), "gram").select(
        *KEY, "item_key", begin.alias("from"), (stretch * STRETCH + STRETCH + 2 * F.col("length") - begin).alias("words_long")
    )
    places = store(places.distinct(), "decon-places")
    wanted = places.groupBy(*KEY).agg(F.collect_list(F.struct("item_key", "from", "words_long")).alias("places"))
    id_, hash_ = "wanted_id", "wanted_hash"
    wanted = wanted.toDF(id_, hash_, "places")
    keyed = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col("text_hash") == F.col(hash_))
    rows = keyed.join(wanted, same).select("doc_id", "text_hash", _words(F.col("text")).alias("words"), "places")
    rows = rows.select(*KEY, "words", F.explode("places").alias("p"))
    rows = rows.select(*KEY, F.col("p.item_key"), F.col("p.from").alias("from"), F.slice("words", F.col("p.from") + 1, F.col("p.words_long")).alias("passage"))
    rows = rows.join(small(items, 2048), "item_key").select(*KEY, "item_id", F.col("from").cast("bigint"), "passage", "item")
    id_type = dict(items.dtypes)["item_id"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _score(batches, price)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash bigint, item_id {id_type}, score double, first_word bigint, last_word bigint"
    scored = rows.mapInArrow(score, schema).filter(F.col("score") >= threshold)
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct("score", -F.col("first_word")))
    return scored.groupBy(*KEY, "item_id").agg(best.alias("best")).select(*KEY, "item_id", "best.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns."""
    id_, hash_ = fresh(docs, "decon_id", "decon_text")
    found = store(contaminated(docs, benchmark, threshold).select(*KEY).distinct().toDF(id_, hash_), "decon-found")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(hash_))
    return docs.join(small(found, 32), same, "left_anti")
