"""The Katz model against plain counting, its sums of probability, and held-out accuracy."""

import cProfile
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import katz

SF_DIR = "/root/testdata/sf0.01"


class Plain:
    """The same model from dictionaries of words."""

    def __init__(self, texts):
        self.word, self.pair = Counter(), Counter()
        for text in texts:
            tokens = tokens_of(text)
            self.word.update(tokens)
            self.pair.update(zip([None, *tokens[:-1]], tokens))
        self.n = sum(self.word.values())
        self.dw, self.dp = self.factors(self.word), self.factors(self.pair)
        kept = sum(self.dw(c) * c for c in self.word.values())
        self.total = self.n + (kept > self.n * (1 - 1e-9))
        self.unknown = 1 - kept / self.total if self.total else 1.0
        self.after = defaultdict(dict)
        for (h, w), c in self.pair.items():
            self.after[h][w] = c
        self.history = {**self.word, None: self.word[" "]}
        self.weight = {h: self.total_and_weight(h) for h in self.after}

    @staticmethod
    def factors(counts):
        n = Counter(counts.values())
        k = 5
        try:
            tail = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) for r in range(1, k + 1)}
        except ZeroDivisionError:
            d = {}
        if not d or n[k + 1] == 0 or not all(0 < x < 1 for x in d.values()):
            cut = n[1] / (n[1] + 2 * n[2] + 1)
            d = {r: 1 - cut / r for r in range(1, k + 1)}
        return lambda c: d.get(c, 1.0)

    def p_word(self, w):
        c = self.word.get(w, 0)
        return self.dw(c) * c / self.total if c else self.unknown

    def total_and_weight(self, h):
        seen = self.after[h]
        mass = sum(self.dp(c) * c for c in seen.values())
        total = self.history[h] + (mass > self.history[h] * (1 - 1e-9))
        return total, (1 - mass / total) / (1 - sum(map(self.p_word, seen)))

    def p(self, h, w):
        if h not in self.weight:
            return self.p_word(w)
        total, weight = self.weight[h]
        seen = self.after[h]
        return self.dp(seen[w]) * seen[w] / total if w in seen else weight * self.p_word(w)

    def score(self, text):
        tokens = tokens_of(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip([None, *tokens[:-1]], tokens))


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), " "]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def check(spark_rows, docs):
    model = Plain([t for i, t in docs if not held_out(i)])
    v = len(model.word)
    expected = {}
    for i, t in docs:
        tokens = tokens_of(t)
        base = sum(math.log10((model.word.get(w, 0) + 0.1) / (model.n + 0.1 * (v + 1))) for w in tokens)
        expected[i, t] = (held_out(i), len(tokens), sum(w in model.word for w in tokens), model.n, base, model.score(t))
    assert len(spark_rows) == len(docs)
    by_id = defaultdict(list)
    for i, t in docs:
        by_id[i].append(expected[i, t])
    for r in spark_rows:
        row = (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        assert any(row[:4] == e[:4] and row[4:] == pytest.approx(e[4:], rel=1e-9, abs=1e-9) for e in by_id[r.doc_id])
    return model


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(katz, "BUCKETS", 8)


def test_against_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_CHARS", 200_000)
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    rows = katz.score(frame).collect()
    model = check(rows, docs)
    for h in (None, "the", "de", *list(model.after)[:40], "never seen"):
        total = sum(model.p(h, w) for w in model.word) + model.p(h, "\0unknown")
        assert total == pytest.approx(1, abs=1e-9)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_pairs_in_order(monkeypatch):
    """Pairs are sorted by word ids, whether one number holds a pair or not."""
    draw = np.random.default_rng(4)
    first, second = draw.integers(-1, 9, 500), draw.integers(0, 9, 500)
    once = katz._pair_order(first, second)
    monkeypatch.setattr(katz, "NUMBERS", 1)
    for order in (once, katz._pair_order(first, second)):
        assert list(zip(first[order].tolist(), second[order].tolist())) == sorted(zip(first.tolist(), second.tolist()))
    assert len(katz._pair_order(first[:0], second[:0])) == 0
    table = pa.table({"text": ["b a b c", "", "c b a"], "held_out": [False, True, False]})
    chunk = katz.Chunk(table, 128)
    ids = np.array([40, 10, 30, 20])  # of the end, b, a, c
    chunk.pairs(ids)
    pairs = list(zip(chunk.first.tolist(), chunk.second.tolist()))
    assert pairs == sorted({(-1, 10), (10, 30), (30, 10), (10, 20), (20, 40), (-1, 40), (-1, 20), (20, 10), (30, 40)})
    assert [pairs[n] for n in chunk.pair_of[:5].tolist()] == [(-1, 10), (10, 30), (30, 10), (10, 20), (20, 40)]
    assert [(b, w) for b, w in zip(np.append(ids, -1)[chunk.left].tolist(), ids[chunk.right].tolist())] == pairs


def test_no_call_a_word():
    """A chunk of more different words makes no more Python calls."""

    def calls(words):
        table = pa.table({"text": [" ".join(f"w{n}" for n in range(words))], "held_out": [False]})
        profile = cProfile.Profile()
        profile.runcall(lambda: katz.Chunk(table, 128).pairs(np.arange(words + 1)))
        return sum(entry.callcount for entry in profile.getstats())

    calls(100)  # what is imported when first used
    assert calls(5000) < calls(100) + 100


def test_defined_cases(spark):
    data = [(None, "a b a b", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, "A  b\nc", 4), (4, "x " * 5000, 5), (5, "never\x85seen é", 6)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, score int")
    check(katz.score(docs).collect(), [(i, t) for i, t, _ in data])
    assert katz.score(docs.filter(F.lit(False))).count() == 0
    untrained = katz.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.score, r.base_score, r.n_known) for r in untrained} == {(0, 0.0, 0.0, 0)}


def test_a_bucket_does_not_grow(spark, monkeypatch):
    """More text makes more buckets, none of them larger, and a chunk asks only those that it has pairs for."""
    monkeypatch.setattr(katz, "CHUNK_CHARS", 4000)
    monkeypatch.setattr(katz, "BUCKET_CHARS", 2000, raising=False)
    tables, made = [], katz._tables
    monkeypatch.setattr(katz, "_tables", lambda answers, name: tables.append(made(answers, name)) or tables[-1])
    width = spark.conf.get("spark.sql.shuffle.partitions")

    def largest(texts):
        draw = np.random.default_rng(7)
        docs = [(i, " ".join(f"w{n}" for n in draw.integers(0, 900, 100))) for i in range(texts)]
        check(katz.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect(), docs)
        asked = tables[-1].filter("kind = 1")
        assert asked.filter("size(first) = 0").isEmpty()
        return asked.groupBy("bucket").agg(F.sum(F.size("first")).alias("n")).agg(F.max("n")).first()[0]

    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        few, many = largest(50), largest(400)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert many < 1.5 * few


def test_memory_of_a_chunk():
    """A chunk's pairs take a bounded number of bytes a token beside the text."""
    draw = np.random.default_rng(7)
    table = pa.table({"text": [" ".join(f"w{n}" for n in draw.integers(0, 20_000, 200_000))], "held_out": [False]})
    tracemalloc.start()
    try:
        chunk = katz.Chunk(table, 128)
        chunk.pairs(np.arange(len(chunk.hashes)) * 128)
        assert tracemalloc.get_traced_memory()[1] < 90 * len(chunk.tokens)
    finally:
        tracemalloc.stop()
