"""Phrase collocations by prefix-free parsing.

Every text is a sequence of words and piece ends. Words whose hash is a multiple of ``TRIGGER`` cut it
into chunks; a chunk goes on for ``longest - 1`` tokens past the next trigger word, so each phrase
lies whole in the chunk in which it starts, and is counted there alone. Where the overlap begins is
seen in the chunk itself: at its first trigger word behind the first token. Equal chunks are counted
together (the dictionary and its parse frequencies), and phrases are counted inside distinct chunks,
weighted by the frequencies.

Counting goes by length. A phrase can only reach ``least`` if both phrases of one word less do, so
those that do are marked in a bit map of a fixed size, which drops most others before the shuffle.
The map never loses a phrase; one that is too full for a huge vocabulary only drops fewer. Counts
themselves are exact, by the phrases' texts.

Scores are computed in decimals of 38 digits, exact for counts below 10^16.

Defined results: null and empty texts have no words; a null language is ``und``, together with any text
that names it so; repeated rows count each; a text is never cut short, and a text without a trigger
word is one chunk; ties are ranked by their phrase's bytes; an empty table gives no rows; other
columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import by_size, hot_join, mapped, split_spaces, store
from tarn.operators.relational import top_k

#: One word in so many cuts.
TRIGGER = 32
#: Bytes of text worked on at a time.
AT_ONCE = 6_000_000
#: Bits of a map of frequent phrases, and of one slice of it.
MAP_BITS, SLICE_BITS = 27, 16
#: Parts of a language's phrases that are ranked side by side.
RANK_PARTS = 64
#: Numbers of phrases stay below this while they are multiplied.
NUMBERS = 1 << 63
PIECE_END = "\n"
#: A-Z in lower case, every mark between pieces a line break, a tab a space.
BYTES = np.arange(256, dtype=np.uint8)
BYTES[65:91] += 32
BYTES[[*b".,;:!?\n\x0b\x0c\r"]] = 10
BYTES[9] = 32
_ODD = np.random.default_rng(13).integers(0, 1 << 64, 16, dtype=np.uint64) | np.uint64(1)
#: Factors of a word's bytes by their places, again from the first where they end.
_FACTORS = np.random.default_rng(14).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word's bytes: their sum by factors of their places, mixed. Equal words have equal ones
    everywhere; that two words share one costs work, no result."""
    texts = words.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    held = np.frombuffer(data if data is not None else b"", dtype=np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    place = np.arange(len(held)) - np.repeat(ends[:-1], np.diff(ends))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((held + np.uint64(1)) * _FACTORS[place & 255], dtype=np.uint64)))
    mixed = sums[ends[1:]] - sums[ends[:-1]]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[12]
    return mixed ^ (mixed >> np.uint64(29))


def _piece_ends(words: pa.Array) -> np.ndarray:
    return pc.equal(words, PIECE_END).to_numpy(zero_copy_only=False)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Numbers of all tokens, the distinct tokens, their hashes, and the tokens of each text."""
    flat, counts = split_spaces(texts)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, _hashes(coded.dictionary), counts


def _chunks(langs: pa.Array, texts: pa.Array, overlap: int) -> pa.Table:
    """``(lang, chunk, n)``: the distinct chunks of some texts."""
    ids, words, hashes, counts = _tokens(pc.replace_substring(mapped(texts, BYTES), PIECE_END, f" {PIECE_END} "))
    cuts = (hashes % np.uint64(TRIGGER) == 0) & ~_piece_ends(words)
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.zeros(len(ids), dtype=bool)
    ends = np.cumsum(counts)
    first[(ends - counts)[counts > 0]] = True
    starts = np.flatnonzero(first | cuts[ids])
    stops = np.minimum(np.append(starts[1:], len(ids)) + overlap, ends[row[starts]])
    sizes = stops - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.cast(pa.string()).take(pa.array(ids[places])))
    found = pa.table({"lang": langs.take(pa.array(row[starts])), "chunk": pc.binary_join(lists, " ")})
    return found.group_by(["lang", "chunk"]).aggregate([([], "count_all")]).rename_columns(["lang", "chunk", "n"])


def dictionary(docs: DataFrame, longest: int = 3) -> DataFrame:
    """``(lang, chunk, n)``: the distinct chunks of all texts and how often each occurs."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, 1, AT_ONCE):
            table = _chunks(batch.column(0), batch.column(1), longest - 1)
            yield from table.cast(pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("n", pa.int64())])).to_batches()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text <> ''")
    return rows.mapInArrow(chunks, "lang string, chunk string, n bigint").groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _marks(langs: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """The bit of the phrase of ``size`` words that starts at each place but the last few."""
    n = max(len(words) - size + 1, 0)
    mixed = langs[:n] * _ODD[0]
    for at in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[1] + words[at : at + n] * _ODD[2 + at % 8]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[11]
    return (mixed >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _phrases(batch: pa.RecordBatch, size: int, frequent: np.ndarray | None) -> pa.Table:
    """``(lang, phrase, f)`` of the phrases of ``size`` words that start in the chunks' own parts;
    words come with one more row a language, the empty phrase, for their number."""
    ids, words, hashes, counts = _tokens(batch.column(1).cast(pa.large_string()))
    langs = batch.column(0).dictionary_encode()
    lang = np.repeat(langs.indices.to_numpy().astype(np.int64), counts)
    weight = np.repeat(batch.column(2).to_numpy(), counts)
    ends = np.cumsum(counts)
    end, start = np.repeat(ends, counts), np.repeat(ends - counts, counts)
    at = np.arange(len(ids))
    is_end = _piece_ends(words)
    cut = (hashes % np.uint64(TRIGGER) == 0) & ~is_end
    # a chunk's own part ends at its first trigger behind its first token
    behind = np.flatnonzero(cut[ids] & (at > start))
    own_end = ends.copy()
    np.minimum.at(own_end, np.repeat(np.arange(len(counts)), counts)[behind], behind)
    mark = is_end[ids]
    good = (at < np.repeat(own_end, counts)) & (at + size <= end)
    for step in range(size):
        good[: len(ids) - step] &= ~mark[step:]
        good[len(ids) - step :] = False
    if frequent is not None:
        lang_hashes, token_hashes = _hashes(langs.dictionary)[lang], hashes[ids]
        bits = _marks(lang_hashes, token_hashes, size - 1)
        passed = (frequent[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
        both = passed[:-1] & passed[1:]
        good[: len(both)] &= both
        good[len(both) :] = False
    places = np.flatnonzero(good)
    # phrases are numbered by their words, anew where their numbers would pass 63 bits
    codes, most = lang[places], len(langs.dictionary)
    for step in range(size):
        if most * len(words) >= NUMBERS:
            codes = np.unique(codes, return_inverse=True)[1]
            most = len(codes)
        codes, most = codes * len(words) + ids[places + step], most * len(words)
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(codes), 1), dtype=bool), codes[1:] != codes[:-1])))
    sums = np.add.reduceat(weight[places[order]], first) if len(first) else np.zeros(0, dtype=np.int64)
    where = places[order[first]]
    names = words.cast(pa.string())
    texts = [names.take(pa.array(ids[where + step])) for step in range(size)]
    phrase = pc.binary_join_element_wise(*texts, " ") if size > 1 else texts[0]
    found = [pa.table({"lang": langs.dictionary.take(pa.array(lang[where])).cast(pa.string()), "phrase": phrase, "f": pa.array(sums)})]
    if size == 1:
        totals = np.zeros(len(langs.dictionary), dtype=np.int64)
        np.add.at(totals, lang[places], weight[places])
        empty = pa.array([""] * len(totals), pa.string())
        found.append(pa.table({"lang": langs.dictionary.cast(pa.string()), "phrase": empty, "f": pa.array(totals)}))
    return pa.concat_tables(found)


def _bit_map(frequent: DataFrame, size: int) -> np.ndarray:
    """The map of all phrases in ``frequent``: at most ``2 ** MAP_BITS`` bits on the driver."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, counts = split_spaces(batch.column(1).cast(pa.large_string()))
            langs = np.repeat(_hashes(batch.column(0)), counts)
            found = _marks(langs, _hashes(flat), size)[::size] if len(flat) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(found))], ["bit"])

    def packed(table: pa.Table) -> pa.Table:
        held = np.zeros(1 << SLICE_BITS, dtype=bool)
        held[table.column(1).to_numpy()] = True
        return pa.table({"slice": table.column(0)[:1], "bits": pa.array([np.packbits(held, bitorder="little").tobytes()])})

    marked = frequent.filter("phrase <> ''").select("lang", "phrase").mapInArrow(bits, "bit bigint").distinct()
    slices = marked.selectExpr(f"bit >> {SLICE_BITS} AS slice", f"bit & {(1 << SLICE_BITS) - 1} AS bit")
    out = np.zeros((1 << (MAP_BITS - SLICE_BITS), 1 << (SLICE_BITS - 3)), dtype=np.uint8)
    for row in slices.groupBy("slice").applyInArrow(packed, "slice bigint, bits binary").collect():
        out[row.slice] = np.frombuffer(row.bits, dtype=np.uint8)
    return out.reshape(-1)


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10) -> list[DataFrame]:
    """For each length from 1 to ``longest`` a stored ``(lang, phrase, f)`` of the phrases found at least
    ``least`` times. Among the words the empty phrase counts all of a language."""
    context = docs.sparkSession.sparkContext
    chunks = store(dictionary(docs, longest), "collocation-chunks")
    levels: list[DataFrame] = []
    for size in range(1, longest + 1):
        shared = context.broadcast(_bit_map(levels[-1], size - 1)) if levels else None

        def count(batches: Iterator[pa.RecordBatch], size: int = size, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in by_size(batches, 1, AT_ONCE):
                yield from _phrases(batch, size, shared.value if shared else None).to_batches()

        found = chunks.mapInArrow(count, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        levels.append(store(found.filter((F.col("f") >= least) | (F.col("phrase") == "")), f"collocation-{size}"))
    return levels


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of 2 to ``longest`` words.

    A phrase found ``a`` times scores by its worst cut into parts found ``l`` and ``r`` times. One that
    lies in a longer phrase found at least ``covered`` percent as often is left out.
    """
    levels = phrase_counts(docs, longest, least)
    found = levels[1]
    for level in levels[2:]:
        found = found.unionAll(level)
    known = levels[0].filter("phrase <> ''")
    for level in levels[1:-1]:
        known = known.unionAll(level)
    words = F.split("phrase", " ")
    joined = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("left"), joined(k + 1, F.size(words) - k).alias("right")))
    cut = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("first"), F.col("left").alias("part")), F.struct(F.lit(False).alias("first"), F.col("right").alias("part"))))
    parts = store(cut.select("lang", "phrase", "a", "k", sides.alias("side")).select("lang", "phrase", "a", "k", "side.*"), "collocation-parts")
    counted = hot_join(parts, known.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    both = counted.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    big = lambda name: F.col(name).cast("decimal(38,0)")
    score = both.withColumn("_up", F.lit(1000000).cast("decimal(38,0)") * big("a") * big("a")).withColumn("_down", big("l") * big("r"))
    score = score.withColumn("score", F.expr("_up DIV _down")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda size: F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda at: joined(at, size)))
    )
    longer = found.filter(F.size(words) > 2).select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = score.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longest") < covered * F.col("a"), F.lit(True)))
    totals = levels[0].filter("phrase = ''").select("lang", F.col("f").alias("n"))
    rows = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # first among parts of a language, so that one task ranks no more than RANK_PARTS lists of them
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    ranked = top_k(top_k(parts, ["lang", "_part"], order, top, rank="_place").drop("_part", "_place"), ["lang"], order, top)
    # a row a language: as many as there are names of languages
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
