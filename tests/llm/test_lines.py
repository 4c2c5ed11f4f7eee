"""Line dedup against plain comparison of all lines, and the cases its docstring defines."""

import random

import pytest
from pyspark.sql import functions as F

from tarn.llm import lines


def within_one(a, b):
    """Whether two lists of words are one edit apart, by the full table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] == 1


def plain(docs):
    """(id, text) pairs of distinct ids -> {id: (lines, exact, near)} by comparing each line with all."""
    first, out = {}, {}
    for i, text in sorted(docs):
        for no, line in enumerate((text or "").split("\n")):
            words = tuple(line.lower().split())
            if words:
                first.setdefault(words, (i, no))
    long = [w for w in first if len(w) >= lines.MIN_WORDS]
    near = {a for a in long if any(first[b] < first[a] and abs(len(a) - len(b)) < 2 and within_one(a, b) for b in long)}
    for i, text in docs:
        exact, close, n = [], [], 0
        for no, line in enumerate((text or "").split("\n")):
            words = tuple(line.lower().split())
            n += bool(words)
            if words and first[words] != (i, no):
                exact.append(no)
            elif words in near:
                close.append(no)
        out[i] = (n, exact, close)
    return out


@pytest.fixture(scope="module")
def corpus():
    """Lines with edits at every place, repeated words, chains of edits and copies."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 16))] for _ in range(25)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(6):
            line = list(rng.choice(pool))
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            pool.append(line)
            text.append(rng.choice((" ", "  ")).join(line).replace("w1", rng.choice(("w1", "W1"))))
        docs.append((i, "\n".join(text)))
    return docs


def test_against_all_comparisons(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id bigint, text string")
    expected = plain(corpus)
    rows = lines.summary(frame).collect()
    assert {r.doc_id: (r.n_lines, r.n_exact, r.n_near) for r in rows} == {i: (n, len(e), len(c)) for i, (n, e, c) in expected.items()}
    assert {r.doc_id: r.removed for r in rows} == {i: ",".join(map(str, sorted(e + c))) for i, (_, e, c) in expected.items()}
    assert sum(len(c) for _, _, c in expected.values()) > 20
    texts = {r.doc_id: r.text for r in lines.deduplicated(frame).collect()}
    for i, text in corpus:
        gone = {*expected[i][1], *expected[i][2]}
        assert texts[i] == "\n".join(x for no, x in enumerate(text.split("\n")) if no not in gone)


def test_a_line_shared_by_all_makes_no_pairs(spark):
    base = "one two three four five six seven eight nine ten eleven".split()
    docs = [(i, " ".join([*base[:5], f"changed{i}", *base[6:]])) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = lines.summary(frame).collect()
    assert sum(r.n_near for r in rows) == 499 and {r.doc_id for r in rows if not r.n_near} == {0}


def test_defined_cases(spark):
    long = " ".join(f"x{i}" for i in range(20000))
    data = [(1, "same\n\n  \nsame", "a"), (None, "same\nonly", "b"), (2, None, "c"), (3, "", "d"), (4, long, "e"), (5, long + " more", "f"), (4, long, "e")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lines string")
    rows = sorted((r.doc_id or 0, r.n_lines, r.n_exact, r.n_near, r.removed) for r in lines.summary(frame).collect())
    assert rows == [(0, 2, 1, 0, "0"), (1, 2, 1, 0, "3"), (2, 0, 0, 0, ""), (3, 0, 0, 0, ""), (4, 1, 0, 0, ""), (4, 1, 0, 0, ""), (5, 1, 0, 1, "0")]
    out = lines.deduplicated(frame)
    assert out.columns == frame.columns
    assert {(r.lines, r.text) for r in out.collect() if r.lines in "abcdf"} == {("a", "same\n\n  "), ("b", "only"), ("c", None), ("d", ""), ("f", "")}
    empty = frame.filter(F.lit(False))
    assert lines.summary(empty).count() == lines.deduplicated(empty).count() == 0
