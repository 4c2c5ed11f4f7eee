"""Personal data and the terms hidden against plain code, disclosure on small corpora, and the cases defined."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tarn.llm import privacy

SF_DIR = "/root/testdata/sf0.01"
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(number) <= 19 and luhn(number)
    return kind == "email" or 9 <= len(number) <= 15


def plain(text):
    found = []
    for rank, (kind, pattern) in enumerate(STATED.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def spans_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    found = privacy.base_spans(F.col("text"))
    rows = frame.select("n", privacy.listed(found).alias("spans")).collect()
    return [r.spans for r in sorted(rows, key=lambda r: r.n)]


def test_base_of_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries()["op7_privacy"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == base
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in STATED]
        assert base or not r.spans
    assert min(sum(r[f"n_{k}"] for r in rows) for k in STATED) > 0


def test_odd_texts(spark):
    texts = [
        "a@b.c_d@e.f x@y @z.w a@b@c.d a..b@-c-.d. é@é.é a@b..c u@v.w.x,y@z.q", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.2.3 1.2.3.4.",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 41111111111111111111111 4 1 1 1", "+1 (743) 555-3824 ++12345678 +1234567890123456 +12 34 5678-9) x",
        "🙂 é+49 30 1234567é a.b@c.de🙂", None, "", "+", "@", "1" * 50000, "1 " * 50000, "a." * 50000 + "@", "x@" + "a." * 50000, "a@b.c " * 3000,
    ]
    assert spans_of(spark, texts) == [",".join(plain(t)) for t in texts]


@pytest.fixture
def corpus(spark):
    """An address beside one person's name in five texts, common words everywhere."""
    rows = [(i, f"ask {('dear', 'kind', 'good', 'old', 'our')[i]} Ellery about it: ellery{0}@host.org or the desk", "x") for i in range(5)]
    rows += [(10 + i, f"the desk is open about noon {i}", "x") for i in range(95)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, spans string")


WORD = re.compile(r"[^\W\d_][^\W_]{2,}")


def blanked(text):
    """The text without its personal data, and that data as entities."""
    entities, out = set(), list(text or "")
    for span in plain(text):
        kind, start, end = span.split(":")
        value = text[int(start) : int(end)]
        entities.add(f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else re.sub('[^0-9]', '', value)}")
        out[int(start) : int(end)] = " " * (int(end) - int(start))
    return "".join(out), entities


def plain_pairs(texts):
    """``{(entity, term): (raw, smoothed)}`` and both counts, by plain counting over distinct texts."""
    judged = [blanked(t) for t in {t or "" for t in texts}]
    holding = [({w.lower() for w in WORD.findall(t)}, e) for t, e in judged]
    n_term, n_entity, both = Counter(), Counter(), Counter()
    for terms, entities in holding:
        n_term.update(terms)
        n_entity.update(entities)
        both.update((e, t) for e in entities for t in terms)
    share = lambda e, t, u: (both[e, t] / (n_term[t] + u) - n_entity[e] / len(judged)) / (1 - n_entity[e] / len(judged))
    return {(e, t): (share(e, t, 0), share(e, t, privacy.UNSEEN)) for e, t in both if n_entity[e] < len(judged)}, n_term, n_entity


def test_disclosure_by_plain_counts(spark, corpus):
    rows = privacy.disclosures(corpus, privacy._scan(corpus)).collect()
    expected, _, _ = plain_pairs([r.text for r in corpus.collect()])
    assert {(r.entity, r.term): (r.disclosure, r.smoothed) for r in rows} == {k: pytest.approx(v) for k, v in expected.items()}
    found = {r.term: r.disclosure for r in rows}
    assert found["ellery"] == pytest.approx(1) and found["the"] < 0.1


def test_hidden_terms_of_all_documents(spark):
    """Which terms are hidden, what takes their place and where they stand, against plain counting."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    pairs, n_term, n_entity = plain_pairs(texts.values())
    strong, largest = Counter(), Counter()
    for (entity, term), (_, smoothed) in pairs.items():
        if smoothed >= privacy.GENERALISE:
            strong[term] = max(strong[term], smoothed)
            largest[term] = max(largest[term], n_entity[entity])
    common = Counter()
    for term, n in n_term.items():
        for size in range(1, min(len(term), privacy.BEGINNING) + 1):
            common[term[:size]] = max(common[term[:size]], n)
    label = {}
    for term, smoothed in strong.items():
        safe = [k for k in range(1, min(len(term) - 1, privacy.BEGINNING) + 1) if (common[term[:k]] + privacy.UNSEEN) * privacy.GENERALISE > largest[term]]
        label[term] = f"{term[: max(safe)]}*" if safe and smoothed < privacy.REMOVE else ""
    rows = privacy.reveal(docs).collect()
    assert len(rows) == len(texts) and label
    for r in rows:
        text, entities = blanked(texts[r.doc_id])
        expected = [(m.start(), m.end(), label[m[0].lower()]) for m in WORD.finditer(text) if m[0].lower() in label] if entities else []
        assert [(t.start, t.end, t.label) for t in r.terms] == expected
        assert all((t.action == "removed") == (t.label == "") for t in r.terms)


def test_names_are_found_and_common_words_left(spark):
    """Names far from their owners' addresses, in long letters of common words: recall and precision."""
    common = [f"plain{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"]
    rows = []
    for i in range(300):
        body = [common[(i * 7 + j * (1 + i % 9)) % 100] for j in range(120)]
        owner, name = i // 3, f"name{'abcdefghij'[i // 3 // 10 % 10]}{'abcdefghij'[i // 3 % 10]}x"
        text = " ".join([name.title(), *body, f"box{owner}@host.org"]) if i < 150 else " ".join(body)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in privacy.reveal(docs).collect():
        named = r.doc_id < 150
        assert [(t.start, t.end) for t in r.terms] == ([(0, 7)] if named else [])


def test_revealing_terms_are_hidden(corpus):
    out = {r.doc_id: r.text for r in privacy.sanitised(corpus).collect()}
    assert "[email]" in out[0] and "@" not in out[0] and "Ellery" not in out[0] and "desk" in out[0]
    assert all(out[10 + i] == f"the desk is open about noon {i}" for i in range(95))
    assert privacy.sanitised(corpus).columns == corpus.columns


def test_copies_prove_nothing(spark):
    text = "meet Quillon at home, call +1 (743) 555-3824 now"
    docs = spark.createDataFrame([(i, text) for i in range(50)] + [(99, "clean words")], "doc_id bigint, text string")
    rows = privacy.digest(privacy.reveal(docs)).collect()
    assert sum(r.n_phone for r in rows) == 50 and sum(r.n_term for r in rows) == 0


@pytest.mark.parametrize("size", [20, 500, 3000])
def test_a_term_met_once_at_every_size(spark, size):
    """A name and an address in a single text, far apart; neither copies nor the corpus' size change what becomes of it."""
    letter = "write to Ottoline at the desk: " + "at the desk " * 50 + "box7@host.org"
    rows = [(0, letter), (1, letter)] + [(10 + i, f"write to other desks and the desk about number n{i}") for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.term: r for r in privacy.disclosures(docs, privacy._scan(docs)).collect()}
    assert found["ottoline"].disclosure == pytest.approx(1)
    assert found["ottoline"].smoothed == pytest.approx((2 / 3 - 1 / (size + 1)) / (1 - 1 / (size + 1)))
    assert found["desk"].disclosure == pytest.approx(0)
    out = {r.doc_id: r.text for r in privacy.sanitised(docs).collect()}
    assert out[0] == out[1] == letter.replace("Ottoline", "ot*").replace("box7@host.org", "[email]")


@pytest.mark.parametrize("size", [15, 16, 17, 31, 32, 40, 70])
def test_broader_terms_of_any_length(spark, size):
    """A name is cut to the longest beginning that a common word shares, however long."""
    shared = ("abcdefghijklmnopqrstuvwxyz" * 3)[:size]
    rows = [(0, f"write to {shared}xyz at box7@host.org"), (1, f"write to {shared[:5]}0ther at box8@host.org")]
    rows += [(10 + i, f"write to {shared}other at number n{i}") for i in range(20)]
    out = {r.doc_id: r.text for r in privacy.sanitised(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out[0] == f"write to {shared}* at [email]" and out[1] == f"write to {shared[:5]}* at [email]"


def test_masked_texts_by_plain_code(spark):
    """Personal data blanked out in a long text of many entities, some inside others."""
    parts = [f"word{i % 97} élan 🙂 {i % 250}.1.2.{i % 256}" if i % 3 else f"call +1 (743) 555-{1000 + i} or a{i}@host{i}.org, abc" for i in range(900)]
    texts = [" ".join(parts), "x1 " + ".".join(["1.2.3.4"] * 300) + "@y.z end", "abc" * 900 + " a@b.cd " + "def" * 900, "none", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    rows = {r.n: r.masked for r in frame.select("n", privacy.masked(F.col("text"), privacy.base_spans(F.col("text"))).alias("masked")).collect()}
    assert [rows[n] for n in range(len(texts))] == [blanked(t)[0] for t in texts]


def test_many_entities_in_one_text(spark):
    """Eight thousand addresses in one text, found and replaced."""
    text = "start " + " ".join(f"at {i // 250 % 250}.{i % 250}.1.2 is" for i in range(8000)) + " end"
    docs = spark.createDataFrame([(1, text), (2, "clean")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in privacy.digest(privacy.reveal(docs)).collect()}
    assert (rows[1].n_ip, rows[2].n_ip) == (8000, 0)
    out = {r.doc_id: r.text for r in privacy.sanitised(docs).collect()}
    assert out == {1: "start " + " ".join(["at [ip] is"] * 8000) + " end", 2: "clean"}


def test_defined_cases(spark):
    data = [(None, "a@b.cd", "k"), (1, None, "k"), (1, "", "k"), (2, "a@b.cd", None), (2, "a@b.cd", None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, kind string")
    rows = sorted((r.doc_id or 0, r.spans) for r in privacy.digest(privacy.reveal(docs)).collect())
    assert rows == [(0, "email:0:6"), (1, ""), (1, ""), (2, "email:0:6"), (2, "email:0:6")]
    assert sorted(r.text or "" for r in privacy.sanitised(docs).collect()) == ["", "", "[email]", "[email]", "[email]"]
    empty = docs.filter(F.lit(False))
    assert privacy.digest(privacy.reveal(empty)).count() == privacy.sanitised(empty).count() == 0


def test_revealing_terms_in_texts_without_personal_data(spark):
    """A name that reveals an address is hidden in texts without any too, copies and long texts among them."""
    rows = [(i, f"dear Ellery about {w}: box@host.org") for i, w in enumerate(["this", "that", "these", "those", "them", "him"])]
    rows += [(10, "we met ELLERY there, and ellery again"), (11, "we met ELLERY there, and ellery again"), (12, "the " * 4000 + "Ellery")]
    rows += [(20 + i, f"we met elbows there, number n{i}") for i in range(60)] + [(90, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs, _, _ = plain_pairs([t for _, t in rows])
    assert privacy.GENERALISE <= pairs["email:box@host.org", "ellery"][1] < privacy.REMOVE
    found = {r.doc_id: r for r in privacy.digest(privacy.reveal(docs)).collect()}
    assert [found[i].n_term for i in (10, 11, 12, 20, 90)] == [2, 2, 1, 0, 0]
    assert found[10].spans == "term:7:13,term:25:31" and found[12].spans == "term:16000:16006"
    out = {r.doc_id: r.text for r in privacy.sanitised(docs).collect()}
    assert out[10] == out[11] == "we met el* there, and el* again" and out[12] == "the " * 4000 + "el*"
    assert all(out[i] == t for i, t in rows if i >= 20)
