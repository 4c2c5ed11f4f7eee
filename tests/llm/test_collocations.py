"""Phrase collocations against plain counting, the chunks' properties, and the cases defined."""

import cProfile
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import collocations
from tarn.llm.common import by_size, hot_join, mapped, split_spaces, store


def plain(rows, longest=3, least=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        ranked = []
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= covered * a:
                continue
            score, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, collocations.collocations(docs, **options).collect()))


def made(spark, rows):
    return spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "doc_id bigint, lang string, text string")


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_plain_counts(spark, longest):
    """Few words, so that phrases overlap, repeat and contain each other; every other chunk is cut."""
    draw = np.random.default_rng(longest)
    words = [f"w{k}" for k in range(40)] + ["Big", "big", "é", "don't", "x\x0by", "\x1c"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " ; "]
    rows = []
    for _ in range(60):
        size = int(draw.integers(0, 300))
        picks = (draw.zipf(1.4, size) - 1) % len(words)
        rows.append((["en", "de", None][int(draw.integers(3))], "".join(words[p] + gaps[int(draw.integers(len(gaps)))] for p in picks)))
    rows += rows[:20] * 3
    expected = plain(rows, longest=longest, least=5)
    assert len(expected) > 50
    assert found(made(spark, rows), longest=longest, least=5) == expected


def test_every_phrase_starts_in_one_chunk(spark):
    text = " ".join(f"a{k % 977} b{k % 31}" for k in range(3000)) + ". end"
    chunks = collocations.dictionary(made(spark, [("en", text)])).collect()
    assert len(chunks) > 50 and max(len(c.chunk.split(" ")) for c in chunks) < 1000
    levels = collocations.phrase_counts(made(spark, [("en", text)]), least=1)
    assert [level.filter("phrase <> \'\'").agg(F.sum("f")).first()[0] for level in levels] == [6001, 5999, 5998]


def test_a_full_map_drops_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MAP_BITS", 4)
    monkeypatch.setattr(collocations, "SLICE_BITS", 3)
    rows = [("en", " ".join(f"a{k % 7} b{k % 5}" for k in range(400)))]
    assert found(made(spark, rows), least=2) == plain(rows, least=2) != []


def batch_of(rows):
    return pa.record_batch([pa.array([lang for lang, _ in rows]), pa.array([text for _, text in rows]), pa.array([1 + n % 3 for n in range(len(rows))])], ["lang", "chunk", "n"])


def test_numbers_of_phrases_stay_small(monkeypatch):
    """Phrases numbered anew after every word are told apart as in one go, and counted right."""
    draw = np.random.default_rng(3)
    rows = [(lang, " ".join(f"v{k}" for k in draw.integers(0, 9, 40))) for lang in ("a", "b") for _ in range(20)]
    monkeypatch.setattr(collocations, "TRIGGER", 1 << 62)
    once = [sorted(map(tuple, collocations._phrases(batch_of(rows), size, None).to_pandas().values.tolist())) for size in (1, 2, 3)]
    monkeypatch.setattr(collocations, "NUMBERS", 1)
    assert once == [sorted(map(tuple, collocations._phrases(batch_of(rows), size, None).to_pandas().values.tolist())) for size in (1, 2, 3)]
    counts = Counter()
    for n, (lang, text) in enumerate(rows):
        words = text.split()
        counts.update({(lang, " ".join(words[i : i + 2])): 0 for i in range(len(words) - 1)})
        for i in range(len(words) - 1):
            counts[lang, " ".join(words[i : i + 2])] += 1 + n % 3
    assert [tuple(r) for r in once[1]] == sorted((*k, f) for k, f in counts.items())


def test_no_call_a_word():
    """Cutting and counting make no more Python calls for more different words."""

    def calls(words):
        batch = batch_of([("en", " ".join(f"w{n}" for n in range(k, k + 50))) for k in range(0, words, 50)])
        profile = cProfile.Profile()
        profile.runcall(collocations._chunks, batch.column(0), batch.column(1), 2)
        profile.runcall(collocations._phrases, batch, 2, np.full(1 << (collocations.MAP_BITS - 3), 255, dtype=np.uint8))
        return sum(entry.callcount for entry in profile.getstats())

    calls(500)  # what is imported when first used
    assert calls(20000) < calls(500) + 500


def test_hashes_are_of_the_bytes():
    words = ["", "a", "b", "ab", "ba", "é", "x" * 256, "x" * 257, "y" + "x" * 256, "\n", "a\0", "🙂"]
    hashes = collocations._hashes(pa.array(words))
    assert len(set(hashes.tolist())) == len(words)
    assert (collocations._hashes(pa.array(["q", *words, "r"]).slice(1, len(words))) == hashes).all()
    assert (collocations._hashes(pa.array(words[::-1], pa.large_string()))[::-1] == hashes).all()
    assert len(collocations._hashes(pa.array([], pa.string()))) == len(collocations._hashes(pa.array(["x"]).slice(1))) == 0
    many = collocations._hashes(pa.array([f"word{n}" for n in range(32000)]))
    assert 800 < (many % np.uint64(32) == 0).sum() < 1200 and len(np.unique(many)) == 32000


def test_defined_cases(spark):
    phrase = "new york city "
    rows = [("en", phrase * 30), (None, "x y, " * 12), ("und", "x y"), ("en", None), ("en", ""), ("fr", " .\n\t "), ("en", "word " * 40000)]
    rows += [("en", "New York")] * 9
    result = found(made(spark, rows))
    assert result == plain(rows)
    assert {r[0] for r in result} == {"en", "und"} and ("und", 1, "x y", 13, 13, 13, 26, 1000000) in result
    empty = made(spark, rows).filter(F.lit(False))
    assert found(empty) == []
    clashing = spark.createDataFrame([(1, "en", "a b " * 20, "x", 3)], "phrase int, lang string, text string, chunk string, n int")
    assert found(clashing) == plain([("en", "a b " * 20)])


def test_ties_go_by_bytes_and_only_the_top_stays(spark):
    rows = [("en", f"{a} {b}. " * 10) for a, b in (("z", "y"), ("é", "e"), ("b", "c"), ("b2", "c"))]
    assert [r[2] for r in found(made(spark, rows), top=3)] == [r[2] for r in plain(rows, top=3)]


def test_hot_join(spark):
    left = store(spark.range(5000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id"), "left")
    right = spark.range(0, 5000, 2).selectExpr("id AS k", "id * 10 AS v")
    expected = sorted((r.k, r.id, r.v) for r in left.join(right, "k").collect())
    assert sorted((r.k, r.id, r.v) for r in hot_join(left, right, ["k"]).collect()) == expected


def test_helpers_keep_all_rows():
    texts = ["a" * 5, "", None, "b" * 50, "c", "d" * 9, "e" * 3]
    batches = [pa.RecordBatch.from_pydict({"n": list(range(i, j)), "t": pa.array(texts[i:j], pa.string())}) for i, j in ((0, 3), (3, 4), (4, 7))]
    out = list(by_size(iter(batches), 1, 10))
    assert [n for b in out for n in b.column(0).to_pylist()] == list(range(7))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= 10 for b in out)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    assert mapped(pa.array(["xAéÉ", None, "", "B C"])[1:], lower).to_pylist() == ["", "", "b c"]
    words, counts = split_spaces(pa.array(["  a b", "", " ", "c"]))
    assert words.to_pylist() == ["a", "b", "c"] and counts.tolist() == [2, 0, 0, 1]
