"""Repeated passages by relative Lempel-Ziv parsing.

The reference is the whole corpus, cut into overlapping blocks: of every window of ``WINDOW`` words the
``GRAM`` consecutive words with the smallest hash are its anchor, and the windows that share an anchor
at one place make up a block, the words they cover. Equal passages have equal anchors, so a block is
indexed by its anchor, wherever the passage stands. Texts are then factored: each takes, from left to
right, as long a run as the index allows of blocks that occur elsewhere too. A block found whole
elsewhere settles all its windows at once. Only where a factor may begin or end inside a block (its
anchor occurs elsewhere, but in other surroundings) are the windows compared one by one. A factor is
a run of repeated windows, ``WINDOW`` words long or longer; its words go.

Equal texts are parsed once, with their number. Blocks and windows are compared by hashes of 64 bits
under an anchor of 64 bits more. Nothing compares pairs: counts by key decide, and of the keys that
many rows share none meets in one task.

Defined results: null and empty texts have no words; a text of fewer words than a window loses none;
repeated rows are occurrences of each other, whatever their ids; texts of any length are parsed whole;
an empty table gives no rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import by_size, hot_join, mapped, split_spaces, store

WINDOW, GRAM = 35, 8
#: Bytes of text worked on at a time.
AT_ONCE = 6_000_000
#: White space between words as single bytes; all of it becomes a space.
BYTES = np.arange(256, dtype=np.uint8)
BYTES[9:14] = 32
#: Odd factors of the polynomials and mixes.
_ODD = np.random.default_rng(11).integers(0, 1 << 64, 8, dtype=np.uint64) | np.uint64(1)
BASE, BACK = _ODD[0], np.uint64(pow(int(_ODD[0]), -1, 1 << 64))


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD[1]
    return (values ^ (values >> np.uint64(29))) * _ODD[2]


def _power(factor: np.uint64, exponent: int) -> np.uint64:
    return np.uint64(pow(int(factor), exponent, 1 << 64))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts and how many each has."""
    return split_spaces(mapped(texts, BYTES))


def _word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w, 11) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return known[coded.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.uint64)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each place on, by doubling."""
    done, covered, step, width = None, 0, hashes, 1
    while size:
        if size & 1:
            n = len(hashes) - covered - width + 1
            done = step if done is None else done[:n] * _power(BASE, width) + step[covered : covered + n]
            covered += width
        size >>= 1
        if size:
            step = step[:-width] * _power(BASE, width) + step[width:] if len(step) > width else step[:0]
            width *= 2
    return _mix(done)


def _anchors(grams: np.ndarray) -> np.ndarray:
    """For each window the place of its smallest gram, the first of equal ones."""
    values, places, width, full = grams, np.arange(len(grams)), 1, WINDOW - GRAM + 1
    while width < full:
        step = min(width, full - width)
        later = values[step:] < values[:-step]
        places = np.where(later, places[step:], places[:-step])
        values = np.where(later, values[step:], values[:-step])
        width += step
    return places


def _blocks(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Text, first word, end, anchor and hash of every block of some texts."""
    words, counts = _words(texts)
    ends = np.cumsum(counts)
    n = len(words)
    if n < WINDOW:
        return tuple(np.zeros(0, dtype=kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = _word_hashes(words)
    grams = _rolled(hashes, GRAM)
    places = _anchors(grams)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(places)) + WINDOW <= ends[row[: len(places)]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (places[1:] != places[:-1]) | (row[1 : len(places)] != row[: len(places) - 1])
    goes_on = np.zeros(len(places), dtype=bool)
    goes_on[:-1] = inside[1:] & ~begins[1:]
    starts, lasts = np.flatnonzero(begins), np.flatnonzero(inside & ~goes_on)
    stops = lasts + WINDOW
    # the words of a block as a polynomial, from running sums
    powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, BASE))))
    back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, BACK))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers)))
    content = (sums[stops] - sums[starts]) * back[starts]
    anchor = places[starts]
    shape = ((stops - starts) * 64 + (anchor - starts)).astype(np.uint64)
    own = row[starts]
    before = (ends - counts)[own]
    return own, starts - before, stops - before, grams[anchor], _mix(content ^ (shape * _ODD[3]))


def blocks(texts: DataFrame) -> DataFrame:
    """Stored ``(no, copies, s, e, a, c)``: the blocks of ``(no, copies, text)``, words s to e, under anchor a."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 2, AT_ONCE):
            own, s, e, a, c = _blocks(batch.column(2))
            taken = [batch.column(k).take(pa.array(own)) for k in (0, 1)]
            columns = [*taken, pa.array(s, pa.int32()), pa.array(e, pa.int32()), pa.array(a.view(np.int64)), pa.array(c.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["no", "copies", "s", "e", "a", "c"])

    return store(texts.select("no", "copies", "text").mapInArrow(cut, "no bigint, copies bigint, s int, e int, a bigint, c bigint"), "passage-blocks")


def _windows(wanted: DataFrame) -> DataFrame:
    """``(a, h, no, s, n)``: the windows of the listed blocks of ``(no, text, blocks)``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 1, AT_ONCE):
            words, counts = _words(batch.column(1))
            rolled = _rolled(_word_hashes(words), WINDOW)
            lists = batch.column(2)
            own = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            s, e, a, n = (pc.struct_field(lists.flatten(), k).to_numpy().astype(np.int64) for k in range(4))
            sizes = e - s - WINDOW + 1
            block = np.repeat(np.arange(len(sizes)), sizes)
            first = s[block] + np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            before = np.cumsum(counts) - counts
            columns = [a[block], rolled[before[own[block]] + first].view(np.int64), None, first.astype(np.int32), n[block]]
            columns[2] = batch.column(0).take(pa.array(own[block]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "h", "no", "s", "n"])

    return wanted.select("no", "text", "blocks").mapInArrow(hashed, "a bigint, h bigint, no bigint, s int, n bigint")


def repeated(texts: DataFrame) -> DataFrame:
    """``(no, ranges)``: of stored ``(no, copies, text)`` the stretches of words ``(s, e)`` whose windows all
    occur elsewhere too; stretches may overlap."""
    every = blocks(texts)
    anchors = every.groupBy("a").agg(F.sum("copies").alias("n"), (F.min("c") != F.max("c")).alias("open")).filter("n > 1")
    index = store(anchors.select("a", "open"), "passage-index")
    hits = store(hot_join(every, index, ["a"]), "passage-hits")
    # under an anchor with one surrounding all blocks are equal; else they are counted by content
    several = hits.filter("open").groupBy("a", "c").agg(F.sum("copies").alias("n"), F.max("no").alias("sample"))
    open_hits = store(hot_join(hits.filter("open").drop("open"), several, ["a", "c"]), "passage-open")
    whole = hits.filter("NOT open").select("no", "s", "e").unionAll(open_hits.filter("n > 1").select("no", "s", "e"))
    # at the factors' ends: the windows of each block found once, against one sample of each other block
    asked = open_hits.filter("n = 1 OR no = sample").groupBy("no").agg(F.collect_list(F.struct("s", "e", "a", "n")).alias("blocks"))
    windows = store(_windows(texts.join(asked, "no")), "passage-windows")
    again = windows.groupBy("a", "h").agg(F.sum("n").alias("all")).filter("all > 1").select("a", "h")
    singles = hot_join(windows.filter("n = 1"), store(again, "passage-again"), ["a", "h"]).select("no", "s", (F.col("s") + WINDOW).alias("e"))
    return whole.unionAll(singles).groupBy("no").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))


def _factors(sizes: np.ndarray, own: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which words of some texts lie in a factor: runs of repeated windows merged from left to right."""
    before = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
    np.add.at(change, before[own] + s, 1)
    np.add.at(change, before[own] + e, -1)
    return np.cumsum(change[:-1]) > 0


def _parsed(rows: DataFrame) -> DataFrame:
    """``(k1, k2, n_words, n_removed, kept_sha256, spans)`` of ``(k1, k2, text, ranges)``; a span is a factor."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 2, AT_ONCE):
            words, counts = _words(batch.column(2))
            lists = pc.fill_null(batch.column(3).value_lengths(), 0).to_numpy(zero_copy_only=False)
            ranges = batch.column(3).flatten()
            s, e = (pc.struct_field(ranges, k).to_numpy().astype(np.int64) for k in (0, 1))
            gone = _factors(counts, np.repeat(np.arange(len(lists)), lists), s, e)
            row = np.repeat(np.arange(len(counts)), counts)
            kept = np.bincount(row[~gone], minlength=len(counts))
            offsets = pa.array(np.concatenate(([0], np.cumsum(kept))), pa.int32())
            left = pc.binary_join(pa.ListArray.from_arrays(offsets, words.cast(pa.string()).filter(pa.array(~gone))), " ")
            sums = [hashlib.sha256(t.encode()).hexdigest() for t in left.to_pylist()]
            # a factor's first and last words
            edge = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            starts, stops = gone.copy(), gone.copy()
            starts[1:] &= ~gone[:-1] | np.isin(np.arange(1, len(gone)), edge)
            stops[:-1] &= ~gone[1:] | np.isin(np.arange(1, len(gone)), edge)
            first, last = np.flatnonzero(starts), np.flatnonzero(stops) + 1
            before = np.cumsum(counts) - counts
            spans = pa.StructArray.from_arrays([pa.array((v - before[row[first]]), pa.int32()) for v in (first, last)], ["first_word", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(first, np.concatenate((before, [len(row)]))), pa.int32()), spans)
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(counts - kept, pa.int64()), pa.array(sums, pa.string()), spans]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "n_words", "n_removed", "kept_sha256", "spans"])

    schema = "k1 bigint, k2 bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<first_word int, end int>>"
    return rows.select("k1", "k2", "text", "ranges").mapInArrow(parse, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row a document: ``doc_id, n_words, n_removed, kept_sha256`` and the removed ``spans`` of words."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", *[F.xxhash64(F.lit(k), text).alias(f"k{k}") for k in (1, 2)], text.alias("text"))
    ids = store(keyed.select("doc_id", "k1", "k2"), "passage-ids")
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = store(texts.withColumn("no", F.monotonically_increasing_id()), "passage-texts")
    ranges = store(repeated(texts), "passage-ranges")
    parsed = store(_parsed(texts.join(ranges, "no", "left")), "passage-parsed")
    return hot_join(ids, parsed, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
