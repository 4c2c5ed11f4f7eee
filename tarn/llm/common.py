"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.session import scratch_path

#: A run of white space between words; a word is a maximal run of anything else.
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of a stored frame times its row width up to this many bytes may be broadcast.
BROADCAST_BYTES = 32 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, gap: str = GAP) -> Column:
    """The words of a text in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def word_count(text: Column) -> Column:
    """Number of words (bigint). Only the first and the last piece of a split can be empty."""
    pieces = F.split(F.coalesce(text, F.lit("")), GAP)
    return let(
        pieces,
        lambda p: F.size(p) - (p[0] == "").cast("int") - ((F.size(p) > 1) & (p[F.size(p) - 1] == "")).cast("int"),
    ).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and go on from the files.

    Cuts the lineage (a lost executor costs a re-read) and, unlike a checkpoint of rows,
    stays column-pruned, filtered on reading and of a known size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(stored: DataFrame, row_bytes: int) -> DataFrame:
    """The stored frame, marked for broadcast if its counted rows fit the bound."""
    return F.broadcast(stored) if stored.count() * row_bytes <= BROADCAST_BYTES else stored


#: A key with more than one in so many rows is hot; so there are never more hot keys than this.
HOT_SHARE = 1024


def hot_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of a stored frame with one that has each key at most once.

    A hot key's rows would meet in one task. Rows of the at most ``HOT_SHARE`` hot keys stay where
    they are and get their partner by broadcast; all others move to it.
    """
    counts = store(left.groupBy(*keys).agg(F.count("*").alias("_rows")), "hot-keys")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = counts.filter(F.col("_rows") * HOT_SHARE > total).select(*keys)
    partners = F.broadcast(store(right.join(F.broadcast(hot), keys, "left_semi"), "hot-partners"))
    rest = left.join(F.broadcast(hot), keys, "left_anti")
    return left.join(partners, keys).unionByName(rest.join(right, keys))


def by_size(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows anew in batches of about ``size`` bytes of the text column, one longer text alone."""
    waiting, held = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            stop = max(int(np.searchsorted(ends, before + size - held, side="right")), at + (not waiting))
            if stop > at:
                waiting.append(batch.slice(at, stop - at))
                held, at = held + int(ends[stop - 1] - before), stop
            if at < len(ends) or held >= size:
                yield pa.concat_batches(waiting)
                waiting, held = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def mapped(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """Texts with each byte replaced by ``table``, which must leave bytes from 128 on alone; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data if data is not None else b"", dtype=np.uint8)[ends[0] : ends[-1]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(table[held].tobytes()))


def split_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts' words between single spaces, one after the other, and how many each text has."""
    cut = pc.split_pattern(texts, " ")
    pieces = cut.flatten()
    row = np.repeat(np.arange(len(texts)), cut.value_lengths().to_numpy().astype(np.int64))
    full = pc.not_equal(pc.binary_length(pieces), 0)
    return pieces.filter(full), np.bincount(row[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
