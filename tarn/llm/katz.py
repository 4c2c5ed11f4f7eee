"""A Katz backoff model of word pairs, learned from one part of the documents and applied to all.

Counts are discounted after Good and Turing (counts above ``TOP`` are kept), those of pairs seen once
too, and each word's backoff weight makes its probabilities, over all words seen in
training and one unknown word, sum to one. A token is scored by its pair if the model has it, else
by its predecessor's weight times its own probability, else by what is left for unknown words.

Neither the model nor a document's tokens ever go to one place. Documents are dealt into chunks of
bounded size, stored bucketed by chunk. Each chunk asks for its distinct words, then for its distinct
pairs, sorted into hash buckets; a bucket adds up the chunks' counts and answers each of them in the
order of its question. Answers meet their chunk's texts again, which need no shuffle. So what moves
is distinct words and pairs of chunks, in arrays. There are as many buckets as the corpus has times
``BUCKET_CHARS``, so neither a chunk nor a bucket grows with it, and a chunk asks only those that it
has pairs for. Word and pair tables are written by kind of row. A word so frequent that it makes up a
third of the corpus is one word in each chunk, and its pairs spread over all buckets.

Defined results: a null text has only the end; a document without an id is trained on; repeated
rows count each; without training documents each token is unknown, with probability 1; an empty
table gives an empty result; a very long text is a chunk of its own; other columns are left alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import UPPER, store
from tarn.session import scratch_path

SPACES = "\t\n\v\f\r"
#: The end of a text as a word: no word holds a space.
END = " "
#: As predecessor of a text's first word.
START = -1
CHUNK_CHARS = 8_000_000
#: Hash buckets at least; with a wider shuffle as many as that has partitions. No result depends on it.
BUCKETS = 128
#: Characters of the corpus to a bucket, at most.
BUCKET_CHARS = 8_000_000
#: Pairs judged at a time.
SLICE = 1 << 16
#: Numbers of pairs stay below this.
NUMBERS = 1 << 63
#: Counts up to this are discounted.
TOP = 5
#: Pairs seen less often in training are not in the model: only those never seen there.
LEAST_PAIR = 1
ANSWERS = "chunk bigint, kind int, bucket int, first array<bigint>, second array<bigint>, third array<double>"


def default_fold(doc_id: Column) -> Column:
    """Held out: a tenth of the documents by the checksum of their ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _chunks(docs: DataFrame, held_out: Column, buckets: int) -> DataFrame:
    """``(chunk, chars, doc_id, held_out, text)`` in a table bucketed by chunk: grouping by chunk moves nothing."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, chars = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers, sizes = [], pc.utf8_length(batch.column("text")).cast(pa.int64())
            for size in sizes.to_pylist():
                if chars and chars + size > CHUNK_CHARS:
                    chunk, chars = chunk + 1, 0
                chars += size
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), sizes, *batch.columns], ["chunk", "chars", *batch.schema.names])

    # A-Z in lower case, all white space as spaces
    text = F.translate(F.coalesce("text", F.lit("")), UPPER + SPACES, UPPER.lower() + " " * len(SPACES))
    rows = docs.select("doc_id", held_out.alias("held_out"), text.alias("text"))
    types = dict(rows.dtypes)
    rows = rows.mapInArrow(cut, f"chunk bigint, chars bigint, doc_id {types['doc_id']}, held_out boolean, text string")
    name, path = f"katz_{uuid.uuid4().hex}", scratch_path(docs.sparkSession, "katz-chunks")
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, "chunk").saveAsTable(name)
    return docs.sparkSession.table(name)


def _by_bucket(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The order by bucket that leaves each bucket's own order."""
    return np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")


class Chunk:
    """One chunk's tokens, as numbers of its distinct words, and their order by bucket and hash.

    Arrow's offsets bound a chunk's text, so its own numbers take four bytes.
    """

    def __init__(self, table: pa.Table, buckets: int):
        self.buckets = buckets
        parts = pc.split_pattern(table.column("text").combine_chunks().cast(pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary.cast(pa.large_binary()).to_pylist()
        words, row = coded.indices.to_numpy(), np.repeat(np.arange(table.num_rows, dtype=np.int32), parts.value_lengths().to_numpy())
        del parts, coded
        if b"" in names:  # between two spaces
            real = words != names.index(b"")
            words, row = words[real], row[real]
        n_words = np.bincount(row, minlength=table.num_rows)
        self.sizes = n_words + 1
        # word 0 is the end
        self.tokens = np.insert(words + np.int32(1), np.cumsum(n_words), 0)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(~table.column("held_out").to_numpy().astype(bool), self.sizes)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, [END.encode(), *names]), dtype=np.uint64, count=len(names) + 1)
        self.word_bucket = (self.hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(self.hashes)
        self.word_order = order[_by_bucket(self.word_bucket[order], buckets)]

    def pairs(self, ids: np.ndarray) -> None:
        """Distinct pairs of neighbours, by word ids and by the chunk's own numbers, with their order and the tokens' place in it."""
        before = np.roll(self.tokens, 1)
        before[self.starts] = START
        # numbered in the order of their ids, words give pairs in that order
        words = np.argsort(ids, kind="stable").astype(np.int32)
        place = np.zeros(len(ids) + 1, dtype=np.int64)  # START is the last place
        place[words] = np.arange(1, len(ids) + 1)
        codes = place[before]
        codes *= len(ids) + 1
        codes += place[self.tokens]
        del before
        order = np.argsort(codes)
        codes = codes[order]
        new = np.append(True, codes[1:] != codes[:-1])
        self.pair_of = np.empty(len(order), dtype=np.int32)
        self.pair_of[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        del order
        codes = codes[new]
        words = np.concatenate((np.array([START], dtype=np.int32), words))
        self.left, self.right = words[codes // (len(ids) + 1)], words[codes % (len(ids) + 1)]
        del codes
        self.first, self.second = np.append(ids, START)[self.left], ids[self.right]
        mixed = self.first.astype(np.uint64)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= self.second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed >>= np.uint64(33)
        mixed %= np.uint64(self.buckets)
        self.pair_bucket = mixed.astype(np.min_scalar_type(self.buckets))
        del mixed
        self.pair_order = _by_bucket(self.pair_bucket, self.buckets).astype(np.int32)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The tokens' values added up by text; each text has its end."""
        return np.add.reduceat(values, self.starts)


def _pair_order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The order by both, each at least ``START``: by one number a pair where 63 bits hold it."""
    width = int(second.max(initial=0)) + 2
    if (int(first.max(initial=0)) + 2) * width < NUMBERS:
        return np.argsort((first.astype(np.int64) + 1) * width + second + 1)
    return np.lexsort((second, first))


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(kind.to_pandas_dtype(), copy=False), kind))


def _question(chunk: int, buckets: int, bucket: np.ndarray, order: np.ndarray, *columns: np.ndarray, long: bool = True) -> pa.Table:
    """One row a bucket that has values: the columns' values of that bucket, in order."""
    sizes = np.bincount(bucket, minlength=buckets)
    some = np.flatnonzero(sizes)
    ends = np.concatenate(([0], np.cumsum(sizes[some])))
    lists = [_lists(c[order], ends, pa.int64() if long else pa.int32()) for c in columns]
    names = ["bucket", "chunk", *"abcd"[: len(lists)]]
    return pa.Table.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk)), *lists], names)


def _answered(table: pa.Table, kind: int, column: str, order: np.ndarray, dtype) -> np.ndarray:
    """A chunk's answers, bucket after bucket, put back into the order of its words or pairs."""
    rows = table.select(["bucket", column]).filter(pc.equal(table.column("kind"), kind)).sort_by("bucket")
    out = np.zeros(len(order), dtype=dtype)
    out[order] = _flat(rows, column)
    return out


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _of_counts(totals: np.ndarray) -> list[int]:
    """How many, their sum, and how many were counted once, twice .. ``TOP + 1`` times."""
    seen = totals[totals > 0]
    return [len(seen), int(seen.sum()), *[int((seen == r).sum()) for r in range(1, TOP + 2)]]


def discounts(of_counts: list[int]) -> list[float]:
    """Factors for the counts 0 .. ``TOP`` (0 unused) by Good and Turing in Katz's form.

    Counts of counts too irregular for that (a factor outside 0..1) are discounted like absolute
    discounting does, by n1 / (n1 + 2 n2 + 1).
    """
    n = [0, *of_counts]
    if min(n[1 : TOP + 2]) > 0:
        tail = (TOP + 1) * n[TOP + 1] / n[1]
        factors = [((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if tail != 1 else 0.0 for r in range(1, TOP + 1)]
        if all(0 < d < 1 for d in factors):
            return [1.0, *factors]
    cut = n[1] / (n[1] + 2 * n[2] + 1)
    return [1.0, *[1 - cut / r for r in range(1, TOP + 1)]]


class Model:
    """The numbers that belong to the whole model."""

    def __init__(self, words: list[int], end_count: int):
        self.n_words, self.tokens = words[0], words[1]
        self.word_factors = discounts(words[2:])
        self.end_count = end_count
        kept = self.tokens - sum((1 - self.word_factors[r]) * r * words[1 + r] for r in range(1, TOP + 1))
        # with nothing to spare, an unknown word counts as one more token
        self.total = self.tokens + (1 if self.tokens - kept < 1e-9 * max(self.tokens, 1) else 0)
        self.unknown = 1 - kept / self.total if self.total else 1.0
        self.pair_factors: list[float] = []

    def word_probability(self, count: np.ndarray) -> np.ndarray:
        factor = np.array([*self.word_factors, 1.0])[np.minimum(count, TOP + 1)]
        return np.where(count > 0, factor * count / max(self.total, 1), self.unknown)

    def discounted(self, count: np.ndarray) -> np.ndarray:
        return np.array([*self.pair_factors, 1.0])[np.minimum(count, TOP + 1)] * count


def _factor(count: Column, factors: list[float]) -> Column:
    """The discount factor of a positive count."""
    return F.array(*map(F.lit, [*factors[1:], 1.0]))[F.least(count, F.lit(TOP + 1)).cast("int") - 1]


def _tables(answers: DataFrame, name: str) -> DataFrame:
    path = scratch_path(answers.sparkSession, name)
    answers.write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return answers.sparkSession.read.schema(answers.schema).parquet(path)


def _sums(rows: list[list[int]]) -> list[int]:
    """Sums over the buckets."""
    return [sum(column) for column in zip(*rows)] if rows else [0] * (TOP + 5)


def score(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """One row a document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities; ``base_score`` is that of single words with 0.1 added to each count.
    """
    width = max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    stored = _chunks(docs, default_fold(F.col("doc_id")) if held_out is None else held_out, width)
    buckets = max(width, -(-(stored.agg(F.sum("chars")).first()[0] or 0) // BUCKET_CHARS))
    chunks = stored.drop("chars")

    # words: ask, add up, answer. Kinds of answers: 0 for a chunk, 9 the table, 8 counts of counts
    def ask_words(table: pa.Table) -> pa.Table:
        c = Chunk(table, buckets)
        counts = np.bincount(c.tokens[c.train], minlength=len(c.hashes))
        return _question(table.column("chunk")[0].as_py(), buckets, c.word_bucket, c.word_order, c.hashes.view(np.int64), counts)

    def add_words(table: pa.Table) -> pa.Table:
        hashes, counts = _flat(table, "a"), _flat(table, "b")
        words, place = np.unique(hashes, return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(words)).astype(np.int64)
        end = np.flatnonzero(words == np.uint64(xxhash.xxh64_intdigest(END.encode())).view(np.int64))
        of_counts = [*_of_counts(totals), int(totals[end].sum()), len(words)]
        return _answers(table, table.column("a"), place, totals[place], 0, words, totals, of_counts)

    asked = chunks.groupBy("chunk").applyInArrow(ask_words, "bucket int, chunk bigint, a array<bigint>, b array<bigint>")
    words = _tables(asked.groupBy("bucket").applyInArrow(add_words, ANSWERS), "katz-words")
    counted = [r.first for r in words.filter("kind = 8").select("first").collect()]
    sums = _sums(counted)
    model = Model(sums[: TOP + 3], sums[TOP + 3])
    # whether ids and counts need eight bytes
    long = max(buckets * (max((c[TOP + 4] for c in counted), default=0) + 1), model.tokens) >= 1 << 31

    # pairs likewise, by word ids: a word's place in its bucket times the number of buckets plus the bucket;
    # with the second word's count, so that its probability is at hand where the pair is
    def ids_of(c: Chunk, answers: pa.Table) -> np.ndarray:
        return _answered(answers, 0, "first", c.word_order, np.int64) * buckets + c.word_bucket

    def ask_pairs(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, buckets)
        c.pairs(ids_of(c, answers))
        counts = np.bincount(c.pair_of[c.train], minlength=len(c.first))
        of_second = _answered(answers, 0, "second", c.word_order, np.int64)[c.right]
        return _question(table.column("chunk")[0].as_py(), buckets, c.pair_bucket, c.pair_order, c.first, c.second, counts, of_second, long=long)

    def add_pairs(table: pa.Table) -> pa.Table:
        first, second, counts, of_second = (_flat(table, x) for x in "abcd")
        order = _pair_order(first, second)
        a, b = first[order], second[order]
        new = np.concatenate((np.ones(min(len(a), 1), dtype=bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        place = np.zeros(len(a), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        totals = np.bincount(place, weights=counts, minlength=int(new.sum())).astype(np.int64)
        known = totals >= LEAST_PAIR
        words = of_second[order[new][known]]
        return _answers(
            table, table.column("a"), np.where(known, totals, 0)[place], None, 1, a[new][known], totals[known], _of_counts(totals), words
        )

    to_words = words.filter("kind = 0")
    lists = ", ".join(f"{x} array<{'bigint' if long else 'int'}>" for x in "abcd")
    asked = chunks.groupBy("chunk").cogroup(to_words.groupBy("chunk")).applyInArrow(ask_pairs, f"bucket int, chunk bigint, {lists}")
    pairs = _tables(asked.groupBy("bucket").applyInArrow(add_pairs, ANSWERS), "katz-pairs")
    model.pair_factors = discounts(_sums([r.first for r in pairs.filter("kind = 8").select("first").collect()])[2 : TOP + 3])

    weights = store(_weights(words, pairs, model, buckets), "katz-weights")
    start = weights.filter(F.col("id") == START).first()
    start_weight = start.weight if start else 1.0
    # each chunk's words get their weights, in the order of its question
    table = weights.filter(F.col("id") != START).select((F.col("id") % buckets).cast("int").alias("bucket"), F.floor(F.col("id") / buckets).alias("place"), "weight")

    def add_weights(asked: pa.Table, found: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _EMPTY
        places = _flat(asked, "first")
        all_weights = np.ones(int(places.max(initial=0)) + 1)
        at = found.column("place").to_numpy()
        inside = at < len(all_weights)
        all_weights[at[inside]] = found.column("weight").to_numpy()[inside]
        lists = asked.column("first").combine_chunks()
        none = pa.nulls(asked.num_rows, pa.list_(pa.int64()))
        third = _lists(all_weights[places], np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))), pa.float64())
        kind = pa.array(np.full(asked.num_rows, 2, dtype=np.int32))
        return pa.Table.from_arrays([asked.column("chunk"), kind, asked.column("bucket"), none, none, third], schema=_EMPTY.schema)

    weighed = to_words.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(add_weights, ANSWERS)

    def evaluate(table: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(table, buckets)
        c.pairs(ids_of(c, answers))
        word_count = _answered(answers, 0, "second", c.word_order, np.int64)
        weight = np.append(_answered(answers, 2, "third", c.word_order, np.float64), start_weight)
        # once a distinct pair, or word; pairs by slices, so that not all of them wait for each step
        pair_count = _answered(answers, 1, "first", c.pair_order, np.int64)
        del answers, c.first, c.second, c.pair_order
        before, alone = np.append(word_count, model.end_count), model.word_probability(word_count)  # START is the last place
        score = np.empty(len(pair_count))
        for at in range(0, len(score), SLICE):
            part = slice(at, at + SLICE)
            count, left = pair_count[part], c.left[part]
            back = weight[left]
            # a negative weight marks a predecessor with one more in its total, see _weights
            seen = model.discounted(count) / np.maximum(before[left] + (back < 0), 1)
            score[part] = np.log10(np.where(count > 0, seen, np.abs(back) * alone[c.right[part]]))
        base = (word_count + 0.1) / (model.tokens + 0.1 * (model.n_words + 1))
        n = len(c.sizes)
        columns = [
            table.column("doc_id"),
            table.column("held_out"),
            pa.array(c.sizes),
            pa.array(c.sums((word_count > 0).astype(np.int64)[c.tokens])),
            pa.array(np.full(n, model.tokens)),
            pa.array(c.sums(np.log10(base)[c.tokens])),
            pa.array(c.sums(score[c.pair_of])),
        ]
        return pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    order = ["chunk", "kind", "bucket", "first", "second", "third"]
    answers = to_words.select(order).unionAll(pairs.filter("kind = 1").select(order)).unionAll(weighed.select(order))
    id_type = dict(docs.dtypes)["doc_id"]
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        evaluate, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def _weights(words: DataFrame, pairs: DataFrame, model: Model, buckets: int) -> DataFrame:
    """``(id, weight)`` of every predecessor in the model: what its pairs leave, over what their words leave.

    Where the discounts of its pairs leave nothing, its total counts one more, and the weight is negative.
    """
    known = words.filter("kind = 9").select("bucket", F.posexplode("second").alias("place", "n"))
    known = known.select((F.col("place") * buckets + F.col("bucket")).alias("id"), "n").filter("n > 0")
    # one array is opened and the others looked up: zipped, a bucket's pairs would all be objects at once
    rows = pairs.filter("kind = 9").select("second", "third", F.posexplode("first").alias("at", "before"))
    rows = rows.select("before", F.col("second")[F.col("at")].alias("r"), F.col("third")[F.col("at")].cast("bigint").alias("n"))
    probability = _factor(F.col("n"), model.word_factors) * F.col("n") / max(model.total, 1)
    sums = rows.groupBy("before").agg(F.sum(_factor(F.col("r"), model.pair_factors) * F.col("r")).alias("pairs"), F.sum(probability).alias("words"))
    totals = known.select(F.col("id").alias("before"), "n")
    named = sums.filter(F.col("before") != START).join(totals, "before")
    start = sums.filter(F.col("before") == START).withColumn("n", F.lit(model.end_count).cast("bigint"))
    full = F.col("pairs") > F.col("n") * (1 - 1e-9)
    total = F.col("n") + full.cast("int")
    weight = (1 - F.col("pairs") / total) / (1 - F.col("words")) * F.when(full, -1).otherwise(1)
    return named.select("before", "pairs", "words", "n").unionAll(start.select("before", "pairs", "words", "n")).select(
        F.col("before").alias("id"), weight.alias("weight")
    )


_EMPTY = pa.schema(
    [
        ("chunk", pa.int64()),
        ("kind", pa.int32()),
        ("bucket", pa.int32()),
        ("first", pa.list_(pa.int64())),
        ("second", pa.list_(pa.int64())),
        ("third", pa.list_(pa.float64())),
    ]
).empty_table()


def _answers(
    table: pa.Table,
    asked: pa.ChunkedArray,
    first: np.ndarray,
    second: np.ndarray | None,
    kind: int,
    table_first: np.ndarray,
    table_second: np.ndarray,
    of_counts: list[int],
    table_third: np.ndarray | None = None,
) -> pa.Table:
    """The rows of a bucket: an answer to each chunk, the bucket's part of the table, its counts of counts."""
    ends = np.concatenate(([0], np.cumsum(asked.combine_chunks().value_lengths().to_numpy())))
    n, bucket = table.num_rows, table.column("bucket")[0].as_py()

    def one(values) -> pa.Array:
        return pa.array([None if values is None else values])

    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    columns = [
        pa.concat_arrays([table.column("chunk").combine_chunks(), pa.array([-1, -1], pa.int64())]),
        pa.array([kind] * n + [9, 8], pa.int32()),
        pa.array([bucket] * (n + 2), pa.int32()),
        pa.concat_arrays([_lists(first, ends, pa.int64()), one(table_first).cast(longs), one(of_counts).cast(longs)]),
        pa.concat_arrays(
            [pa.nulls(n, longs) if second is None else _lists(second, ends, pa.int64()), one(table_second).cast(longs), pa.nulls(1, longs)]
        ),
        pa.concat_arrays([pa.nulls(n, doubles), one(table_third).cast(doubles), pa.nulls(1, doubles)]),
    ]
    return pa.Table.from_arrays(columns, schema=_EMPTY.schema)
