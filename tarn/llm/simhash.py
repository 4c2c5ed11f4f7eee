"""SimHash near-duplicates by a grid join on segment bit counts.

A fingerprint is cut into 32 segments of two bits; its bit counts there are a point of a grid. The
Manhattan distance of two points never exceeds the Hamming distance of the fingerprints, so links
can be sought as points within ``distance`` of each other. The 32 axes are dealt to
``distance + 4`` groups: a Manhattan distance of at most ``distance`` leaves at least four groups
untouched, so any link has both ends in the same grid cell of some four groups. Each fingerprint
goes to its cell for each choice of four groups, an equal join on the cell. The pairs of a cell
must be within ``distance`` of each other as points; those that are, are verified bit by bit.

Equal fingerprints are one node from the start. Inside a cell the nodes are cut into blocks of a
fixed size, every two blocks are one small unit of work, and a unit returns only a spanning forest
of the links it finds: nothing emits all pairs of a group, no link between components is lost.

Defined results: a null or empty text has the fingerprint zero, linked like any other; texts of
fewer words than a shingle are one shingle; documents without an id form components by their
fingerprints too, whose name is the smallest id that is not null (null if there is none); repeated
rows give repeated rows; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import fresh, hot_join, small, store
from tarn.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SEED = 42
CHUNK = 1 << 16
#: Words of a shingle and bits that may differ, as the contract of ``op8_simhash`` says.
CONTRACT, DISTANCE = 3, 3
#: Nodes of one block of a cell: a unit of work compares about this many with as many.
BLOCK = 512
#: The lower bit of each of the 32 axes.
EVEN = np.uint64(0x5555555555555555)
#: Groups of axes that agree exactly in a cell.
AGREE = 4


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, in parts of bounded size; nothing for a text without words."""
    words = [w.encode() for w in WORD.findall((text or "").translate(LOWER))]
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - shingle + 1, 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    for at in range(0, n, CHUNK):  # bounded memory for very long texts
        spans = zip(starts[at : min(at + CHUNK, n)].tolist(), ends[at : min(at + CHUNK, n)].tolist())
        yield np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The bits set in more than half of the shingles' hashes."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, name: str, shingle: int = 3) -> DataFrame:
    """The documents with one more column: the fingerprint's 64 bits as a bigint."""

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64), dtype="int64")

    return docs.withColumn(name, of("text"))


def _cells(nodes: DataFrame, distance: int) -> DataFrame:
    """``(cell, fp)``: each fingerprint's cell for each choice of ``AGREE`` groups of axes."""
    groups = [axes.tolist() for axes in np.array_split(np.arange(32), distance + AGREE)]
    choices = [[axis for g in chosen for axis in groups[g]] for chosen in combinations(range(len(groups)), AGREE)]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            point = (bits[:, 0::2] + bits[:, 1::2]).astype(np.int64)  # 0, 1 or 2 on each axis
            for number, axes in enumerate(choices):
                cell = np.full(len(fps), number, dtype=np.int64)
                for axis in axes:
                    cell = cell * 3 + point[:, axis]
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fps)], ["cell", "fp"])

    return nodes.select("fp").mapInArrow(cells, "cell bigint, fp bigint")


def points(fps: np.ndarray) -> np.ndarray:
    """The grid points of fingerprints: each axis's bit count 0, 1 or 2 written as 00, 01 or 11.

    So written, the differing bits of two points number their Manhattan distance.
    """
    even, odd = fps & EVEN, (fps >> np.uint64(1)) & EVEN
    return (even | odd) | ((even & odd) << np.uint64(1))


def near_pairs(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of the links: near as points first, then exactly."""
    i, j = np.nonzero(np.bitwise_count(points(left)[:, None] ^ points(right)[None, :]) <= distance)
    apart = np.bitwise_count(left[i] ^ right[j])
    linked = (apart <= distance) & (apart > 0)
    return i[linked], j[linked]


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links between two blocks of nodes (or inside one)."""
    i, j = near_pairs(left, right, distance)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    a, b = [], []
    for x, y in zip(left[i].tolist(), right[j].tolist()):
        root, other = find(x), find(y)
        if root != other:
            parent[root] = other
            a.append(x)
            b.append(y)
    return a, b


def _units(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """The links of each unit of work; the rows of a unit follow one another."""
    rest = None
    for batch in _with_end(batches):
        table = batch if rest is None else (rest if batch is None else pa.concat_batches([rest, batch]))
        if table is None or not table.num_rows:
            rest = None if batch is None else table
            continue
        unit, fps, second = (table.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        ends = np.append(starts[1:], len(unit))
        if batch is not None:  # the last unit may go on in the next batch
            rest, starts, ends = table.slice(starts[-1]), starts[:-1], ends[:-1]
        fps = fps.astype(np.int64).view(np.uint64)
        pairs = starts[ends - starts == 2]
        near = np.bitwise_count(points(fps[pairs]) ^ points(fps[pairs + 1])) <= distance
        near &= np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= distance
        a, b = [fps[pairs][near]], [fps[pairs + 1][near]]
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            one, two = fps[s:e][~second[s:e]], fps[s:e][second[s:e]]
            x, y = _forest(one, two if len(two) else one, distance)
            a.append(np.array(x, dtype=np.uint64))
            b.append(np.array(y, dtype=np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"])


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints at most ``distance`` bits apart.

    Between them they connect whatever is connected; links implied by others may be missing.
    """
    cells = store(_cells(nodes, distance), "simhash-cells")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = store(sizes.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "simhash-crowded")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    placed = cells.join(crowded, "cell").select("cell", "fp", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # the nodes of block i meet those of every block j >= i, in the unit (i, j)
    unit = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
    units = placed.select(unit.alias("unit"), "fp", (F.col("block") > F.col("other")).alias("second"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _units(batches, distance)

    found = units.repartition("unit").sortWithinPartitions("unit").mapInArrow(find, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``(doc_id, text_hash, fp)`` of each document, and ``(fp, root)`` of each node ``fp``."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", text_hash.alias("text_hash"), "fp")
    marked = store(marked, "simhash-documents")
    nodes = store(marked.select("fp").distinct(), "simhash-nodes")
    rooted = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    return marked, nodes.join(rooted, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = CONTRACT, distance: int = DISTANCE) -> DataFrame:
    """One row a document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    marked, rooted = _grouped(docs, shingle, distance)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = store(rooted.join(least, "fp"), "simhash-rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(names, "root").select("fp", "component_id"), "simhash-components")
    out = marked.join(named, "fp")
    hex_digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", hex_digits.alias("fingerprint"), "component_id")


def first_documents(docs: DataFrame, shingle: int = CONTRACT, distance: int = DISTANCE) -> DataFrame:
    """The documents without near duplicates, all columns kept: of each component the document
    with the smallest id stays (null last, then by the hash of the text), and of rows equal in both one.
    """
    marked, rooted = _grouped(docs, shingle, distance)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = store(marked.groupBy("doc_id", "text_hash", "fp").agg(F.count("*").alias("n")), "simhash-distinct")
    rows = store(hot_join(distinct, store(rooted, "simhash-rooted"), ["fp"]), "simhash-rows")
    best = rows.groupBy("root").agg(F.min(order).alias("best"))
    judged = hot_join(rows, store(best, "simhash-best"), ["root"]).select("doc_id", "text_hash", "n", (order == F.col("best")).alias("stays"))
    doc_id, text_hash, n, stays = fresh(docs, "simhash_id", "simhash_text", "simhash_n", "simhash_stays")
    special = store(judged.filter("NOT stays OR n > 1").toDF(doc_id, text_hash, n, stays), "simhash-judged")
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (hashed == F.col(text_hash))
    single = docs.join(small(special.select(doc_id, text_hash), 32), same, "left_anti")
    repeated = docs.join(small(store(special.filter(stays), "simhash-repeated"), 32), same).dropDuplicates([doc_id, text_hash])
    return single.select(*docs.columns).unionAll(repeated.select(*docs.columns))
