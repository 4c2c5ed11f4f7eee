"""Token ids in ORC files.

The ids of each document are one row ``(doc_id, n_tokens, offset, ids)``, in ascending order of the
document ids over all files of a data set. ORC packs the ids by integer run-length encoding, keeps
minima and maxima of the document ids for every few hundred rows, and Bloom filters on them, so a
reader of some documents skips stripes and rows by metadata alone; stripes are read in parallel.
``offset`` is the number of ids before a document in its own file, and a manifest beside the data
gives each file's start, so a position in the whole stream needs neither a sort nor a running sum.

Defined results: a null or empty text is the end id alone; null document ids come first; documents
that share an id stand together, ordered by the hash of their texts; texts that hold a special token's
name are encoded as the tokenizer does by itself, the name as that token; a very long text is one row;
an empty table gives files without rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END = 0
#: Rows between two entries of the row index.
INDEX_ROWS = 1000
STRIPE_BYTES = 16 << 20
#: Distinct units of text that a worker remembers with their ids, and that it encodes at a time.
MEMORY = 600_000
AT_ONCE = 4096
PLAIN_AT_ONCE = 50_000
#: Characters of texts encoded at a time; a longer text is encoded alone.
AT_ONCE_CHARS = 8_000_000

#: A space between two characters that are no white space always begins a new token.
CUT = re.compile(r"(?<=\S) (?=\S)")
MARK = "\0"
#: Letters and marks: two units of a word in every version of the Unicode tables.
LETTERS, MARKS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]", r"[.,!?;:|#$%&*]"
#: A unit that the tokenizer does not split.
UNIT = rf"^ ?(?:{LETTERS}+|{MARKS}+)$"
#: A piece of such units: a word with marks or marks alone, and the same again after a line break.
PLAIN = (
    rf"^(?:(?P<word> ?{LETTERS}+)(?P<marks>{MARKS}*)|(?P<alone> ?{MARKS}+))"
    rf"(?:(?P<line>\n)(?:(?P<next_word>{LETTERS}+)(?P<next_marks>{MARKS}*)|(?P<next_alone>{MARKS}+)))?$"
)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones for themselves, the others
    the letters from 256 on in their order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def cuts_at_spaces(tokenizer: str) -> bool:
    """Whether the file is a byte-level BPE that may be asked piece by piece: texts as they are, split by
    its usual pattern, merged without chance or extra marks."""
    whole = json.loads(tokenizer)
    split, model = whole.get("pre_tokenizer") or {}, whole["model"]
    return (
        whole.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space", True)
        and split.get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "unk_token", "ignore_merges"))
    )


class Encoder:
    """Encodes texts as the tokenizer does without its special tokens, and remembers the ids of units.

    Byte-level BPE never joins characters across the beginning of a word: cut before each single
    space, the pieces' ids in order are the text's ids. Most pieces are words and marks, perhaps with a
    line break between two, which fall into units without asking the tokenizer; every other piece is a unit
    by itself. A unit's ids are those of its own text. Most units repeat, so each is encoded once.
    New units of letters or of marks go to the tokenizer's merges at once; others go to the tokenizer in one text
    with a zero character between them: no merge takes that character in, and behind it a unit's
    leading space begins a new token as it does anywhere. Units without that leading space, with such a
    character or with white space at an end are encoded on their own.

    A text that holds the name of an added token is left to the tokenizer whole, and so are all
    texts where the file is no byte-level BPE of this kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.by_piece = cuts_at_spaces(self.tokenizer.to_str())
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids[0] if self.by_piece else -1
        self.letters = byte_letters() | {10: "\n"}  # units of letters or marks hold no line break; it parts them
        self.units = pa.array([], pa.large_string())
        self.ids = np.zeros(0, dtype=np.int32)
        # by a unit's number: where its ids begin, how many, and how often it was asked for
        self.first, self.size, self.used = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep what was asked for more than once, at most half of the memory, the most asked for first."""
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > MEMORY // 2:
            keep = np.sort(keep[np.argsort(-self.used[keep], kind="stable")[: MEMORY // 2]])
        self.units = self.units.take(pa.array(keep))
        self.ids, self.size = _gathered(self.ids, self.first, self.size, keep), self.size[keep]
        self.first, self.used = np.cumsum(self.size) - self.size, np.zeros(len(keep), dtype=np.int64)

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        return np.fromiter(chain.from_iterable(coded), dtype=np.int32, count=int(sizes.sum())), sizes

    def _merged(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Units of letters or marks, which the tokenizer would not split."""
        # the letters that stand for the units' bytes, all at once
        letters = "\n".join(units.to_pylist()).encode().decode("latin-1").translate(self.letters).split("\n")
        merge = self.merges.tokenize
        ids = [[t.id for t in merge(u)] for u in letters]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum())), sizes

    def _together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units with a leading space."""
        ids, _ = self._alone([MARK.join(units)])
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) != len(units) - 1:
            return self._alone(units)
        return np.delete(ids, marks), np.diff(np.concatenate(([-1], marks, [len(ids)]))) - 1

    def _learn(self, new: pa.Array) -> None:
        first, size = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64)
        parts, known = [self.ids], len(self.ids)

        def keep(places: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal known
            size[places] = sizes
            first[places] = known + np.cumsum(sizes) - sizes
            parts.append(ids)
            known += len(ids)

        plain = pc.match_substring_regex(new, UNIT)
        places = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        units = new.filter(plain)
        for at in range(0, len(places), PLAIN_AT_ONCE):
            keep(places[at : at + PLAIN_AT_ONCE], *self._merged(units.slice(at, PLAIN_AT_ONCE)))
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        names = new.take(pa.array(others)).to_pylist()
        together = np.array([n[:1] == " " and n[1:].strip() == n[1:] != "" and MARK not in n for n in names], dtype=bool)
        for chosen, encode in ((together, self._together), (~together, self._alone)):
            which = np.flatnonzero(chosen)
            for at in range(0, len(which), AT_ONCE):
                some = which[at : at + AT_ONCE]
                keep(others[some], *encode([names[n] for n in some.tolist()]))
        self.units = pa.concat_arrays([self.units, new])
        self.ids = np.concatenate(parts)
        self.first, self.size = np.append(self.first, first), np.append(self.size, size)
        self.used = np.append(self.used, np.zeros(len(new), dtype=np.int64))

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, each text followed by the end id; and their sizes."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()), "")
        if not self.by_piece:
            return self._whole(texts.to_pylist())
        named = np.zeros(len(texts), dtype=bool)
        for name in self.added:
            named |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        if not named.any():
            return self._pieced(texts)
        ids, sizes = self._pieced(pc.if_else(pa.array(named), "", texts))
        own_ids, own_sizes = self._whole(texts.filter(pa.array(named)).to_pylist())
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for row, part in zip(np.flatnonzero(named).tolist(), np.split(own_ids, np.cumsum(own_sizes)[:-1])):
            parts[row] = part
        sizes[named] = own_sizes
        return np.concatenate(parts), sizes

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self._alone(texts)
        ends = np.cumsum(sizes)
        return np.insert(ids, ends, END).astype(np.int32), sizes + 1

    def _pieced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.units) > MEMORY:
            self._forget()
        cut = pc.split_pattern(texts, " ")
        counts = cut.value_lengths().to_numpy().astype(np.int64)
        pieces = cut.flatten()
        coded = pieces.dictionary_encode()
        starts = np.cumsum(counts) - counts
        firsts = pieces.take(pa.array(starts)).dictionary_encode()
        numbers = coded.indices.to_numpy().copy()
        numbers[starts] = firsts.indices.to_numpy() + len(coded.dictionary)
        # a piece has its space in front, but for a text's first
        space, nothing = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
        pieces = pa.concat_arrays([pc.binary_join_element_wise(space, coded.dictionary, nothing), firsts.dictionary])
        ids, sizes, spaced = self._ids_of(pieces, len(coded.dictionary))
        # where white space stands beside a space, only spaces between words are cuts
        rows = np.unique(np.repeat(np.arange(len(texts)), counts)[spaced[numbers]]) if spaced.any() else spaced[:0]
        rows = [k for k in rows.tolist() if texts[k].as_py()]
        if rows:
            words = [CUT.split(texts[k].as_py()) for k in rows]
            again = pa.array([w if n == 0 else " " + w for cut in words for n, w in enumerate(cut)], pa.large_string()).dictionary_encode()
            own_ids, own_sizes, _ = self._ids_of(again.dictionary, 0)
            own = again.indices.to_numpy() + len(sizes)
            ids, sizes = np.concatenate((ids, own_ids)), np.concatenate((sizes, own_sizes))
            parts, at = np.split(numbers, starts[1:]), 0
            for k, cut in zip(rows, words):
                parts[k], counts[k], at = own[at : at + len(cut)], len(cut), at + len(cut)
            numbers = np.concatenate(parts)
        ids = _gathered(ids, np.cumsum(sizes) - sizes, sizes, numbers)
        # one end id behind the last piece of each text
        last = np.concatenate(([0], np.cumsum(sizes[numbers])))[np.cumsum(counts)]
        return np.insert(ids, last, END), np.diff(np.concatenate(([0], last))) + 1

    def _ids_of(self, pieces: pa.Array, inner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces' ids one after the other, how many each has, and whether it shows a space that is no
        cut. The first ``inner`` pieces have a space in front."""
        found = pc.extract_regex(pieces, PLAIN)
        other = pc.is_null(found)
        columns = [pc.fill_null(column, "") for column in found.flatten()]
        coded = pa.concat_arrays([*columns, pieces.filter(other)]).dictionary_encode()
        numbers = self._numbered(coded.dictionary)[coded.indices.to_numpy()]
        units = np.empty((len(pieces), len(columns) + 1), dtype=np.int64)
        units[:, :-1] = numbers[: len(columns) * len(pieces)].reshape(len(columns), len(pieces)).T
        other = other.to_numpy(zero_copy_only=False)
        units[:, -1] = -1
        units[other, -1] = numbers[len(columns) * len(pieces) :]
        held = units >= 0
        sizes = np.where(held, self.size[units], 0).sum(axis=1)
        spaced = np.zeros(len(pieces), dtype=bool)
        texts = pieces.filter(pa.array(other))
        at = np.flatnonzero(other)
        texts = pc.if_else(pa.array(at < inner), pc.utf8_slice_codeunits(texts, 1), texts)
        bare = pc.equal(pc.utf8_trim_whitespace(texts), texts)
        spaced[at] = pc.or_(pc.equal(texts, ""), pc.invert(bare)).to_numpy(zero_copy_only=False)
        return _gathered(self.ids, self.first, self.size, units[held]), sizes, spaced

    def _numbered(self, units: pa.Array) -> np.ndarray:
        """The numbers of different units; new ones are learned. That of the empty one is -1."""
        real = pc.not_equal(units, "")
        asked = units.filter(real)
        found = pc.index_in(asked, value_set=self.units)
        unknown = pc.is_null(found)
        numbers = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        new = asked.filter(unknown)
        if len(new):
            numbers[numbers < 0] = len(self.units) + np.arange(len(new))
            self._learn(new)
        self.used[numbers] += 1
        out = np.full(len(units), -1, dtype=np.int64)
        out[real.to_numpy(zero_copy_only=False)] = numbers
        return out


def _gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` with the given numbers, one after the other."""
    sizes = size[which]
    ends = np.cumsum(sizes)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[which] - (ends - sizes), sizes)]


def worker_encoder(path: str) -> Encoder:
    """One encoder a worker process, for all its tasks. The library's functions travel to the
    workers by value, so it is kept under a name of its own among the loaded modules."""
    kept = sys.modules.setdefault("tarn_worker_memory", types.ModuleType("tarn_worker_memory"))
    if getattr(kept, "encoder_path", None) != path:
        kept.encoder, kept.encoder_path = Encoder(path), path
    return kept.encoder


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write ``docs`` to ``path/ids`` and ``path/manifest``. ``tokenizer`` is a file on every machine."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = worker_encoder(tokenizer), 0
        for batch in batches:
            # a few rows at a time: a worker holds no more than some million characters
            texts = batch.column("text")
            chars = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + AT_ONCE_CHARS, side="right")))
                ids, sizes = encoder.encode(texts.slice(at, stop - at))
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, stop - at), pa.array(sizes), pa.array(before + ends - sizes), lists],
                    ["doc_id", "n_tokens", "offset", "ids"],
                )
                before, at = before + int(ends[-1]), stop

    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, offset bigint, ids array<int>"
    writer = rows.mapInArrow(encode, schema).write.option("compression", "zstd")
    writer = writer.option("orc.row.index.stride", INDEX_ROWS).option("orc.stripe.size", STRIPE_BYTES)
    writer.option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id").orc(f"{path}/ids")
    spark = docs.sparkSession
    files = spark.read.orc(f"{path}/ids").groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    with_starts(files).write.orc(f"{path}/manifest")


def with_starts(files: DataFrame) -> DataFrame:
    """The manifest's rows, one a file, with the number of ids in all files before. Files are numbered as
    the parts of one write; the numbers are compared, not the names, whose padding ends at five digits."""
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; filters on ``doc_id`` reach the files' indexes."""
    manifest = spark.read.orc(f"{path}/manifest").select("file", F.col("start").alias("file_start"))
    rows = spark.read.orc(f"{path}/ids").select("*", F.col("_metadata.file_name").alias("file"))
    return rows.join(manifest, "file").select("doc_id", (F.col("file_start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: the checksum of the ids as little-endian 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = f"doc_id {dict(tokens.dtypes)['doc_id']}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return tokens.mapInArrow(crc, schema)
