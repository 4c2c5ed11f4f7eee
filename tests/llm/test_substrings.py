"""Repeated passages against plain comparison of all windows, and the cases defined."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import substrings

SF_DIR = "/root/testdata/sf0.01"


def plain(rows, window=35):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    count = Counter(" ".join(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[" ".join(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    result = substrings.without_repeats(docs).collect()
    for r in result:
        assert sum(s.end - s.first_word for s in r.spans) == r.n_removed
    return sorted((tuple(r)[:4] for r in result), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in expected) > 0
    assert found(docs) == expected


@pytest.mark.parametrize("vocabulary", [3, 500])
def test_passages_of_all_lengths(spark, vocabulary):
    """Passages of 25 to 80 words at chance places, some with a word changed, beside a hot one."""
    draw = np.random.default_rng(vocabulary)
    word = lambda: f"w{draw.integers(vocabulary)}"
    passages = [[word() for _ in range(int(draw.integers(25, 81)))] for _ in range(12)]
    hot = [word() for _ in range(60)]
    rows = []
    for doc in range(150):
        words = [word() for _ in range(int(draw.integers(0, 90)))]
        for _ in range(int(draw.integers(0, 4))):
            passage = list(passages[int(draw.integers(len(passages)))])
            if draw.random() < 0.4:
                passage[int(draw.integers(len(passage)))] = "changed"
            words += passage + [word() for _ in range(int(draw.integers(0, 30)))]
        if doc % 3 == 0:
            words += hot + [word()]
        rows.append((doc, " ".join(words)))
    expected = plain(rows)
    assert sum(r[2] for r in expected) > 1000 and any(r[1] > r[2] > 0 for r in expected)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == expected


def test_defined_cases(spark):
    own = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, own("a", 34)), (5, own("a", 34)), (6, own("b", 35)), (6, own("b", 35)), (None, own("c", 40)),
        (None, own("c", 40)), (7, "same " * 36), (8, "same " * 35 + "end"), (9, own("d", 50000)), (10, own("d", 50000) + " more"),
        (11, own("e", 40).replace(" ", "\x0b\n")), (12, own("E", 40)), (13, own("e", 40)), (14, own("f", 17) + " " + own("f", 17) + " " + own("f", 17)),
        (15, own("\xa0g", 60)), (16, "x " + own("\xa0g", 60)),
    ]
    docs = spark.createDataFrame([(*r, 5, 7) for r in rows], "doc_id bigint, text string, no int, copies int")
    result = found(docs)
    assert result == plain(rows)
    assert [r[2] for r in result if r[0] in (7, 8)] == [36, 35]
    assert substrings.without_repeats(docs.filter(F.lit(False))).count() == 0
