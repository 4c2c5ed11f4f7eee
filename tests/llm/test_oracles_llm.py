"""The corpus queries that have SQL against DuckDB, and the edges of their operators."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tarn.llm import licenses, mixing, quality
from tarn.llm.jobs import LLM_JOBS, LLM_ORACLES

SF_DIR = os.environ.get("TARN_SF_DIR", "/root/testdata/sf0.01")


def rounded(rows):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    answer = duck.execute(LLM_ORACLES[name])
    columns = [d[0] for d in answer.description]
    result = LLM_JOBS[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert rounded(result.select(columns).collect()) == rounded(answer.fetchall())


def test_mix_defined_cases(spark):
    data = [(1, "a b c", "x", "k"), (2, None, "x", "k"), (None, "d e", None, "k"), (None, "d e", None, "k"), (3, "f " * 9000, "y", "k"), (4, "", "z", "k")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string, mix_key string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(data)
    for r in rows:
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
    # x has 3 words, z none, null 4; y has nearly all and can hold the rest
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].target == 9 and by_id[4].target == 0 and by_id[2].taken == 0
    assert sorted(r.taken for r in mixing.mix(docs).collect()) == sorted(r.taken for r in rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.filter("doc_id = 1").count() * 3 == by_id[1].taken
    empty = docs.filter(F.lit(False))
    assert mixing.mix(empty).count() == mixing.mixed_documents(empty).count() == 0


def test_mix_levels_by_plain_sums(spark):
    """Many documents of one source, few hash bits a level's worth apart: refined to single hashes."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', int(id % 7)) AS text", "if(id % 3 = 0, 'a', 'b') AS source")
    rows = mixing.mix(docs).collect()
    for source in (0, 1):
        own = [r for r in rows if (r.doc_id % 3 > 0) == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 6


def test_license_defined_cases(spark):
    notice = "Permission is hereby granted, free of charge, to any persons obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"
    data = [
        (1, notice, ""), (2, None, ""), (None, "under the MIT license under the mit license", ""), (3, "", ""), (3, "", ""),
        (4, "word " * 20000 + notice, ""), (5, "mit the under license released far", ""), (6, "the mit and the license and the rest", ""),
    ]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, hits string")
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (rows[1].labels, rows[1].base_labels, rows[1].n_base) == ("mit", "", 0) and 0.9 <= rows[1].score < 1
    assert rows[4].labels == "mit" and rows[5].labels == "mit" and rows[6].labels == ""
    assert (rows[None].n_base, rows[None].first_word, rows[None].last_word) == (2, 0, 4)
    assert licenses.scan(docs).count() == len(data)
    assert licenses.scan(docs.filter(F.lit(False))).count() == 0
    own = spark.createDataFrame([("x", "alpha beta"), ("none", ""), ("null", None)], "label string, text string")
    assert {r.labels for r in licenses.scan(spark.createDataFrame([(1, "beta, alpha")], "doc_id bigint, text string"), own).collect()} == {"x"}


def plain_counts(text):
    words = text.split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    return sum(any(tuple(words[j : j + 3]) in twice for j in range(max(0, i - 2), i + 1)) for i in range(len(words)))


def test_repeated_words(spark):
    texts = ["", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "x a b c y a b c z a b d", "a b c d a b c d a b c d e", "q w e r t y " * 3]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = [r.c.n_repeat_words for r in rows.select("n", quality.counts(F.col("text")).alias("c")).orderBy("n").collect()]
    assert found == [plain_counts(t) for t in texts]


def test_exact_binomial_bound(spark):
    from math import exp, lgamma, log

    for n, p, bound in ((10, 0.3, 0.05), (300, 0.0125, 1e-2), (2000, 0.0125, 1e-4), (5000, 0.05, 1e-5)):
        total, k = 0.0, -1
        for i in range(n + 1):
            total += exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p))
            if total > bound:
                break
            k = i
        column = quality.allowed(F.lit(n).cast("bigint"), F.lit(1), p, bound)
        assert spark.range(1).select(column.alias("k")).first().k == k


def test_quality_cutoffs(spark):
    """Good documents without symbols, bad ones with many: the rule rejects the bad ones only."""
    rows = [(i, f"d{i} " + " ".join(f"w{j}" + ("#" * 3 if i % 4 == 0 else "") for j in range(60)), "en") for i in range(6000)]
    rows += [(9000, None, "en"), (9001, "", None), (9002, "one two", "xx"), (9003, "w " * 40000, "en"), (9003, "w " * 40000, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("quality", F.lit("k"))
    labels = spark.range(6000).selectExpr("id AS doc_id", "int(id % 4 > 0) AS quality", "0 AS toxic")
    labels = labels.unionAll(spark.sql("SELECT null, 1, 0 UNION ALL SELECT 7L, null, 0 UNION ALL SELECT 9L, 0, 1"))
    out = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert all(out[i].kept == (i % 4 > 0) for i in range(6000))
    assert all(out[i].base_failed and not out[i].kept for i in range(9000, 9004))
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4500
    few = labels.filter("doc_id < 100")
    assert quality.kept_documents(docs, few).count() == 6000, "too few labels prove nothing"
    assert quality.judge(docs.filter(F.lit(False)), labels).count() == 0
    assert quality.judge(docs, labels.filter(F.lit(False))).filter("kept").count() == 6000


def test_quality_copies_are_no_trials(spark):
    """Ten good texts, however often repeated, prove nothing; nor does a text that is also labelled bad reject itself."""
    rows = [(i, f"d{i % 20} " + " ".join(f"w{j}" + ("#" * 3 if i % 2 else "") for j in range(60)), "en") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.range(6000).selectExpr("id AS doc_id", "int(id % 2 = 0) AS quality")
    assert quality.cutoffs(quality._scored(docs), labels).count() == 0
    assert quality.kept_documents(docs, labels).count() == 6000


def test_quality_verdicts_on_the_given_labels(spark):
    """Cutoffs and verdicts computed plainly, with the binomial sums in whole numbers."""
    from collections import defaultdict
    from math import comb

    large = "/root/testdata/sf0.1"
    docs = {r.doc_id: (r.lang, r.text or "") for r in spark.read.parquet(f"{large}/documents.parquet").collect()}
    good = defaultdict(bool)
    for r in spark.read.parquet(f"{large}/labels.parquet").collect():
        if r.doc_id is not None and r.quality is not None:
            good[r.doc_id] |= r.quality > 0
    scored = quality._scored(spark.read.parquet(f"{large}/documents.parquet"))
    counted = {r.doc_id: r for r in scored.collect()}
    names = list(quality.RULES)

    def levels(r):  # the largest cutoff c in 0..63 with part / whole > c / 64
        pairs = [(r[part], max(r[whole], 1)) for part, whole in quality.RULES.values()]
        return [max((c for c in range(64) if 64 * part > c * whole), default=-1) for part, whole in pairs]

    trials = defaultdict(dict)
    for i, (lang, text) in docs.items():
        if i in good and not counted[i].base_failed:
            before = trials[lang].get(text, (False, None))[0]
            trials[lang][text] = (good[i] or before, levels(counted[i]))
    tests = len(trials) * len(names) * 64
    chosen = {}
    for lang, texts in trials.items():
        for n, name in enumerate(names):
            fine, bad = ([lv[n] for is_good, lv in texts.values() if is_good is kind] for kind in (True, False))
            total, most = 0, -1  # P(X <= k) <= 0.05 / tests for a rate of 1 / 80, in whole numbers
            for k in range(len(fine) // 80 + 1):
                total += comb(len(fine), k) * 79 ** (len(fine) - k)
                if total * tests * 20 > 80 ** len(fine):
                    break
                most = k
            options = []
            for cutoff in set(fine + bad) - {-1}:
                rejects = sum(x >= cutoff for x in fine)
                gain = sum(x >= cutoff for x in bad) * len(fine) - rejects * len(bad)
                if rejects <= most and gain > 0:
                    options.append((gain, cutoff))
            if options:
                chosen[lang, name] = max(options)[1]
    out = quality.judge(spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")).collect()
    for r in out:
        broken = [name for name, lv in zip(names, levels(counted[r.doc_id])) if lv >= chosen.get((docs[r.doc_id][0], name), 64)]
        assert r.broken == ",".join(broken)
        assert r.kept == (not r.base_failed and not broken)
    found = {(r.stratum, r.rule): r.cutoff for r in quality.cutoffs(scored, spark.read.parquet(f"{large}/labels.parquet")).collect()}
    assert found == chosen
    assert chosen


def test_quality_counts_of_all_documents(spark):
    import re
    from collections import Counter

    rows = {r.doc_id: r for r in LLM_JOBS["op5_quality"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        text, r = doc.text or "", rows[doc.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        n = Counter(grams)
        repeat = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        assert r.n_repeat_words == len(repeat)
        assert r.base_failed == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (r.kept and r.base_failed)
