"""Line dedup: exact copies, and lines one word apart, by a deletion-neighbourhood join.

A line is the sequence of its words, A-Z in lower case. Two lines are near if one word put in, left
out or changed turns one into the other. Each line emits all its variants within that bound as
hashed keys: with one word left out, with the place marked where it was (two lines that share such
a key differ in that word alone), and itself (it shares a key with each line that has one word
more). Of all lines with a key only the earliest matters, a minimum, so a key that very many lines
share makes no pairs. What a key proposes is verified on the words.

Before that, lines without any possible partner are set aside: near lines agree in all words of
their first or of their second half, by the length of the shorter one. That needs four keys a line
and leaves none out.

A line goes if an equal line stands earlier (smaller document id, null last; then line number), or
if its first occurrence has a near line earlier. Lines under ``MIN_WORDS`` words are only compared
for equality; lines without words stay.

Defined results: a null text has no lines with words; rows equal in id and text count as one
document, and lines equal in id and number stand equally early; equality of lines is that of 128
hash bits; an empty table gives an empty result; other columns, whatever their names, stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import ascii_lower, fresh, let, small, split_words, store

MIN_WORDS = 10
KEY = ["doc_id", "text_hash"]
LINE = ["h1", "h2"]
#: An odd number; powers of it weigh the words of a line, modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _halves(words: Column) -> Column:
    """Keys of the two halves, for this line's number of words and for one less."""

    def keys(m):
        half = F.floor(m / 2).cast("int")
        # with one word less than the line has, its first half and its last words count
        return (
            F.xxhash64(F.lit(0), m, F.concat_ws(" ", F.slice(words, F.lit(1), half))),
            F.xxhash64(F.lit(1), m, F.concat_ws(" ", F.slice(words, F.size(words) - (m - half) + 1, m - half))),
        )

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= MIN_WORDS, F.array(*keys(F.size(words)), *keys(F.size(words) - 1))).otherwise(none)


def _line(line: Column, number: Column) -> Column:
    def of(w):
        hashes = let(F.concat_ws(" ", w), lambda j: F.struct(F.xxhash64(j).alias("h1"), F.xxhash64(F.lit(1), j).alias("h2")))
        return let(
            hashes,
            lambda h: F.struct(
                number.alias("line"), F.size(w).alias("n"), h["h1"].alias("h1"), h["h2"].alias("h2"), _halves(w).alias("halves")
            ),
        )

    return let(split_words(line), of)


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, lines)``: each document's lines that have words."""
    lines = F.transform(F.split(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), "\n"), _line)
    return docs.select("doc_id", _text_hash().alias("text_hash"), F.filter(lines, lambda x: x["n"] > 0).alias("lines"))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each line: ``role`` 0 for a marked place, 1 for a word left out, 2 for itself."""
    for batch in batches:
        rows, keys, roles = [], [], []
        for row, words in enumerate(batch.column("words").to_pylist()):
            h = np.array([xxhash.xxh64_intdigest(w.encode()) for w in words], dtype=np.uint64)
            n = len(h)
            powers = np.cumprod(np.array([1] + [BASE] * n, dtype=np.uint64), dtype=np.uint64)
            before = np.concatenate(([np.uint64(0)], np.cumsum(h * powers[:n], dtype=np.uint64)))
            # what follows the word left out moves one place down
            down = np.concatenate((np.cumsum((h[1:] * powers[: n - 1])[::-1], dtype=np.uint64)[::-1], [np.uint64(0)]))
            without = before[:-1] + down
            marked = without * np.uint64(2) + powers[:n] * np.uint64(BASE ^ 2)
            keys.append(np.concatenate((marked, without, before[-1:])))
            roles.append(np.repeat(np.array([0, 1, 2], dtype=np.int8), [n, n, 1]))
            rows.append(np.full(2 * n + 1, row))
        at = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        out = batch.select(["h1", "h2", "earliest"]).take(pa.array(at))
        key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        role = np.concatenate(roles) if roles else np.zeros(0, dtype=np.int8)
        yield pa.RecordBatch.from_arrays(
            [*out.columns, pa.array(key.view(np.int64)), pa.array(role)], ["h1", "h2", "earliest", "key", "role"]
        )


def one_edit(a: Column, b: Column) -> Column:
    """Whether one word put in, left out or changed turns one list of words into the other."""

    def of(x, y):  # x has as many words as y or one more
        same = F.size(F.filter(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), lambda e: e))
        changed = (F.size(x) == F.size(y)) & (same == F.size(x) - 1)
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False).cast("int")
        rest = F.size(x) - differs
        longer = (F.size(x) == F.size(y) + 1) & (F.slice(x, differs + 1, rest) == F.slice(y, differs, rest))
        return changed | longer

    return F.when(F.size(a) >= F.size(b), of(a, b)).otherwise(of(b, a))


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(h1, h2, near)`` of each distinct line with an earlier near line: the earliest one's place."""
    halves = distinct.select(*LINE, F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    shared = store(shared, "lines-halves")
    paired = store(halves.join(small(shared, 16), "half").select(*LINE).distinct(), "lines-paired")
    paired = distinct.join(paired, LINE).select(*LINE, "earliest")
    paired = store(paired, "lines-candidates")
    # the words of these lines, from the documents where each stands first
    homes = store(paired.select("earliest.doc_id", "earliest.text_hash").distinct().toDF("home", "home_text"), "lines-homes")
    at_home = F.col("doc_id").eqNullSafe(F.col("home")) & (_text_hash() == F.col("home_text"))
    texts = docs.select("doc_id", "text").join(small(homes, 32), at_home, "left_semi")
    words = texts.select(F.explode(F.split("text", "\n")).alias("line")).select(split_words(ascii_lower(F.col("line"))).alias("words"))
    joined = F.concat_ws(" ", "words")
    words = words.filter(F.size("words") >= MIN_WORDS).select(F.xxhash64(joined).alias("h1"), F.xxhash64(F.lit(1), joined).alias("h2"), "words")
    known = store(words.join(paired, LINE).dropDuplicates(LINE), "lines-words")
    types = dict(known.dtypes)
    emitted = known.mapInArrow(_variants, f"h1 bigint, h2 bigint, earliest {types['earliest']}, key bigint, role tinyint")
    emitted = store(emitted, "lines-variants")
    # only the keys move until it is known which of them meet
    met = store(emitted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "lines-met")
    emitted = store(emitted.join(small(met, 16), "key"), "lines-meeting")
    one = F.struct("earliest", *LINE)
    by_key = emitted.groupBy("key").agg(
        F.min(F.when(F.col("role") == 2, one)).alias("whole"),
        F.min(F.when(F.col("role") != 2, one)).alias("cut"),
    )
    by_key = store(by_key, "lines-keys")
    other = F.when(F.col("role") == 1, F.col("whole")).otherwise(F.col("cut"))
    links = emitted.join(by_key, "key").select(*LINE, "earliest", other.alias("other")).filter("other.earliest < earliest").distinct()
    text = known.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("words").alias("other_words"))
    both = links.join(known.select(*LINE, "words"), LINE).join(text, (F.col("other.h1") == F.col("o1")) & (F.col("other.h2") == F.col("o2")))
    return both.filter(one_edit(F.col("words"), F.col("other_words"))).groupBy(*LINE).agg(F.min("other.earliest").alias("near"))


def duplicate_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' stored lines, and ``(doc_id, text_hash, line, first, near)`` of every line to remove.

    ``first`` is where an equal line stood first, ``near`` where the earliest near line stood; one is null.
    """
    stored = store(_lines(docs), "lines-all")
    lines = stored.select(*KEY, F.explode("lines").alias("l")).select(*KEY, "l.*")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "text_hash")
    distinct = lines.groupBy(*LINE).agg(F.min(place).alias("earliest"), F.first("halves").alias("halves"))
    distinct = store(distinct, "lines-distinct")
    near = store(_near(docs, distinct), "lines-near")
    first = distinct.select(*LINE, "earliest").join(near, LINE, "left")
    same_place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line") == F.struct(
        F.col("earliest.none").alias("none"), F.col("earliest.doc_id").alias("doc_id"), F.col("earliest.line").alias("line")
    )
    judged = lines.join(first, LINE).withColumn("is_first", F.coalesce(same_place, F.lit(False)))
    removed = judged.filter(~F.col("is_first") | F.col("near").isNotNull()).select(
        *KEY, "line", F.when(~F.col("is_first"), F.col("earliest")).alias("first"), F.when(F.col("is_first"), F.col("near")).alias("near")
    )
    return stored, removed


def _by_document(removed: DataFrame) -> DataFrame:
    """``(id, hash, exact, close)``: the numbers of the lines that go, in order."""
    return store(
        removed.groupBy(*KEY).agg(
            F.array_sort(F.collect_set(F.when(F.col("near").isNull(), F.col("line")))).alias("exact"),
            F.array_sort(F.collect_set(F.when(F.col("near").isNotNull(), F.col("line")))).alias("close"),
        ),
        "lines-removed",
    )


def summary(docs: DataFrame) -> DataFrame:
    """One row a document: ``doc_id, n_lines`` (with words), ``n_exact, n_near`` (to remove) and their numbers from 0."""
    stored, removed = duplicate_lines(docs)
    by_doc = _by_document(removed).toDF("id", "hash", "exact", "close")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    none = F.array().cast("array<int>")
    exact, close = F.coalesce("exact", none), F.coalesce("close", none)
    return stored.select(*KEY, F.size("lines").cast("bigint").alias("n_lines")).join(by_doc, same, "left").select(
        "doc_id",
        "n_lines",
        F.size(exact).cast("bigint").alias("n_exact"),
        F.size(close).cast("bigint").alias("n_near"),
        F.array_join(F.array_sort(F.concat(exact, close)), ",").alias("removed"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without the lines that repeat earlier ones; all other columns stay."""
    id_, hash_, exact, close = fresh(docs, "lines_id", "lines_text", "lines_exact", "lines_close")
    by_doc = _by_document(duplicate_lines(docs)[1]).toDF(id_, hash_, exact, close)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (_text_hash() == F.col(hash_))
    gone = F.concat(exact, close)
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(gone, i))
    text = F.when(F.col(id_).isNull() & F.col(hash_).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return docs.join(small(by_doc, 256), same, "left").withColumn("text", text).select(*docs.columns)
