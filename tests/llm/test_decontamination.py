"""Decontamination: edited copies against a plain alignment, hot passages, and the cases defined."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import decontamination as d

WORDS = [f"word{i}" for i in range(400)]


def plain_score(text, item):
    """Smith-Waterman over all words of a text, cell by cell."""
    a, b = (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower()) for x in (item, text))
    last, best = [0.0] * (len(b) + 1), 0.0
    for x in a:
        row = [0.0]
        for j, y in enumerate(b, 1):
            row.append(max(0, last[j - 1] + (1 if x == y else -d.PRICE), last[j] - d.PRICE, row[-1] - d.PRICE))
        best, last = max(best, *row), row
    return best / len(a)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(8)
    items = [(k, " ".join(rng.choices(WORDS, k=rng.randint(12, 60)))) for k in range(15)]
    docs = []
    for i in range(120):
        words = rng.choices(WORDS, k=rng.randint(0, 300))
        if i % 3 == 0:
            copy = items[rng.randrange(15)][1].split()
            for _ in range(int(len(copy) * rng.choice((0, 0.05, 0.1, 0.2, 0.3)))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = rng.choices(WORDS, k=rng.randint(0, 2))
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
        docs.append((i, ", ".join(words).capitalize()))
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def test_edited_copies_against_plain_alignment(spark, data):
    docs, items = data
    rows = d.contaminated(*frames(spark, docs, items)).collect()
    found = {(r.doc_id, r.item_id): r for r in rows}
    expected = {(i, k): s for i, t in docs for k, x in items if (s := plain_score(t, x)) >= d.THRESHOLD}
    assert {pair: r.score for pair, r in found.items()} == pytest.approx(expected)
    assert len(expected) > 25 and any(s < 0.8 for s in expected.values())
    texts, passages = dict(docs), dict(items)
    for (i, k), r in found.items():
        span = re.findall(r"\w+", texts[i].lower())[r.first_word : r.last_word + 1]
        assert plain_score(" ".join(span), passages[k]) == pytest.approx(r.score)


def test_a_passage_that_most_documents_hold(spark, data):
    _, items = data
    docs = [(i, f"{WORDS[i % 7]} {items[3][1]} {WORDS[i % 11]}") for i in range(300)] + [(999, " ".join(WORDS[::3]))]
    frame = frames(spark, docs, items)
    assert sorted((r.doc_id, r.item_id) for r in d.contaminated(*frame).collect()) == [(i, 3) for i in range(300)]
    assert [r.doc_id for r in d.clean_documents(*frame).collect()] == [999]


def test_alignment_numbers():
    long = np.array([[7, 1, 2, 9, 3, 4, -1], [1, 2, 3, 4, -1, -1, -1]])
    short = np.array([[1, 2, 3, 4], [3, 4, -2, -2]])
    best, end, item_end = d._align(long, short, np.array([4, 2]), 0.5)
    assert best.tolist() == [3.5, 2.0] and end.tolist() == [5, 3] and item_end.tolist() == [3, 1]


def test_defined_cases(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame(
        [(None, text, "p"), (1, None, "q"), (2, "", "r"), (3, text, "s"), (3, text, "s"), (4, "alpha beta", "t"), (5, "x " * 20000 + text, "u")],
        "doc_id bigint, text string, item_id string",
    )
    items = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "alpha beta")], "item_id bigint, text string")
    rows = d.contaminated(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0, r.score) for r in rows) == [(i, k, 1.0) for i in (0, 3, 5) for k in (0, 1)]
    kept = d.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.item_id for r in kept.collect()) == ["q", "r", "t"]
    none, no_items = docs.filter(F.lit(False)), items.filter(F.lit(False))
    assert d.contaminated(none, items).count() == d.contaminated(docs, no_items).count() == 0
    assert d.clean_documents(docs, no_items).count() == 7
