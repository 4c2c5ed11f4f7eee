"""SimHash against a plain computation, and the cases its docstring defines."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarn.llm import simhash
from tarn.llm.components import components

SF_DIR = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, distance=3):
    fps = np.array(fps, dtype=np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= distance):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, doc in enumerate(ids):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(ids))]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return sorted((r.doc_id, r.text) for r in docs.collect())


def test_against_brute_force(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [plain_fingerprint(text) for _, text in rows]
    expected = plain_components([i for i, _ in rows], fps)
    assert [out[i].fingerprint for i, _ in rows] == [f"{x:016x}" for x in fps]
    assert [out[i].component_id for i, _ in rows] == expected
    assert len(set(expected)) < len(expected)


def test_one_of_each_component_stays(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = simhash.first_documents(docs)
    assert kept.columns == docs.columns
    expected = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_links_of_a_crowded_cell(spark, monkeypatch):
    """Hundreds of fingerprints close to one another, in blocks of eight."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    fps = {int(b) for b in base}
    for _ in range(400):
        mask = np.uint64(0)
        for bit in rng.integers(0, 64, rng.integers(1, 5)):
            mask |= np.uint64(1) << np.uint64(bit)
        fps.add(int(base[rng.integers(0, 4)] ^ mask))
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp bigint")
    found = simhash.links(frame).collect()
    root = dict(zip(fps, plain_components(fps, fps)))
    unsigned = lambda x: int(np.int64(x).view(np.uint64))
    merged = {x: x for x in fps}
    for r in found:
        a, b = unsigned(r.a), unsigned(r.b)
        assert (a ^ b).bit_count() <= 3
        a, b = merged[a], merged[b]
        merged = {x: min(a, b) if y in (a, b) else y for x, y in merged.items()}
    assert merged == root
    assert len(found) < len(fps) * 40


def test_grid_points_bound_the_distance():
    """The Manhattan distance of the bit counts, taken plainly, never exceeds the bits that differ, and filters."""
    rng = np.random.default_rng(6)
    fps = rng.integers(0, 2**63, 300, dtype=np.uint64)
    other = fps.copy()
    for i in range(len(other)):
        for bit in rng.integers(0, 64, i % 9):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    plain = lambda x: [(int(x) >> at & 3).bit_count() for at in range(0, 64, 2)]
    manhattan = [sum(abs(a - b) for a, b in zip(plain(x), plain(y))) for x, y in zip(fps, other)]
    assert np.bitwise_count(simhash.points(fps) ^ simhash.points(other)).tolist() == manhattan
    bits = np.bitwise_count(fps ^ other)
    assert (bits >= manhattan).all() and (bits > manhattan).any()
    i, j = simhash.near_pairs(fps, other, 3)
    expected = [(a, b) for a in range(300) for b in range(300) if 0 < int(fps[a] ^ other[b]).bit_count() <= 3]
    assert sorted(zip(i.tolist(), j.tolist())) == expected


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert out == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_defined_cases(spark):
    data = [(1, None, 7), (2, "", 8), (None, "", 9), (3, "one two", 1), (4, "ONE two", 2), (5, "a b c " * 3000, 3), (5, "a b c " * 3000, 3)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, fp bigint")
    out = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in out) == [(0, 1), (1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (5, 5)]
    kept = simhash.first_documents(docs)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id, r.fp) for r in kept.collect()) == [(1, 7), (3, 1), (5, 3)]
    empty = docs.filter(F.lit(False))
    assert simhash.near_duplicates(empty).count() == simhash.first_documents(empty).count() == 0
