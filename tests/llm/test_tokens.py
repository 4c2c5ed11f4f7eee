"""Token files: ids equal to the tokenizer's, positions, the cases defined, and metadata pruning."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarn.llm import tokens
from tarn.session import scratch_path

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def write_and_read(spark, docs):
    path = scratch_path(spark, "tokens-test")
    tokens.write_tokens(docs, path, PATH)
    return path, tokens.read_tokens(spark, path)


def test_pieces_are_whole_texts(tokenizer):
    texts = [
        "", None, " ", "  ", "\n", "a  b", " a b ", "it's a dog 's", "x  y  z", "a \n b\t c   d", "<|endoftext|> x",
        "é è  ü", "1 22  333 4,4", "a" * 5000, "\x1c a \x1d", "don't  stop\r\n", "🙂 🙂  🙂", "tab\tspace \tx",
        "hello <|endoftext|> world", "a<|endoftext|>b c", "<|endoftext|>", "x <|endoftext|><|endoftext|> ", "<|endoftext| >",
        "word, word. word", "!", " ?!", "a!b", "naïve, Ærø ÿ× x÷y", "don't, (no) \"x\"",
    ]
    ids, sizes = tokens.Encoder(PATH).encode(texts)
    flat = [i for t in texts for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]]
    assert ids.tolist() == flat and sizes.sum() == len(flat)


def test_the_name_of_a_special_token():
    ids, sizes = tokens.Encoder(PATH).encode(["hello <|endoftext|> world", "x"])
    assert ids.tolist()[:5] == [31373, 220, 50256, 995, 0] and sizes.tolist() == [5, 2]


def test_other_kinds_of_tokenizer():
    """A file whose tokens are not cut at spaces is asked for whole texts."""
    other = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(other)
    texts = ["Hello  World, it's", "", "<|endoftext|> a", "x " * 50]
    encoder = tokens.Encoder(other)
    assert not encoder.by_piece and tokens.Encoder(PATH).by_piece
    assert encoder.encode(texts)[0].tolist() == [i for t in texts for i in [*plain.encode(t, add_special_tokens=False).ids, 0]]


def test_starts_follow_the_numbers_of_the_files(spark):
    rows = [(f"part-{n:05d}-x.orc", n % 7 + 1) for n in (0, 7, 99_998, 99_999, 100_000, 100_001, 1_234_567)]
    files = spark.createDataFrame(rows[::-1], "file string, n_tokens bigint")
    starts = {r.file: r.start for r in tokens.with_starts(files).collect()}
    assert [starts[f] for f, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))]


def test_against_the_tokenizer(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    _, read = write_and_read(spark, docs)
    assert sorted(map(tuple, tokens.checksums(read).collect())) == expected(tokenizer, rows)


def test_forgets_without_error(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 50)
    encoder = tokens.Encoder(PATH)
    for text in ("one two three " * 30, " ".join(map(str, range(80))), "one two " * 40, "four one " * 70):
        assert encoder.encode([text])[0].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_a_unit_is_merged_once(tokenizer):
    """Whatever marks and line breaks stand beside a word, its ids are remembered."""

    class Merges:
        def __init__(self, merges):
            self.merges, self.asked = merges, []

        def tokenize(self, unit):
            self.asked.append(unit)
            return self.merges.tokenize(unit)

    encoder = tokens.Encoder(PATH)
    encoder.encode(["a fromage b"])
    encoder.merges = Merges(encoder.merges)
    texts = ["a fromage, b fromage. a fromage.\nfromage!", "fromage\nfromage; fromage #\n#b fromage\n", "\nfromage fromage.\n fromage \nb", ",\nb .\n. a.\n\nb"]
    ids, _ = encoder.encode(texts)
    assert ids.tolist() == [i for t in texts for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 0]]
    assert encoder.merges.asked.count("\u0120fromage") == 0 and encoder.merges.asked.count("fromage") == 1
    assert len(encoder.merges.asked) == len(set(encoder.merges.asked))


def test_defined_cases(spark, tokenizer):
    data = [(5, "x y", 1), (None, "null id", 2), (3, None, 3), (3, "", 4), (9, "word " * 50000, 5), (5, "x y", 6)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, ids int")
    _, read = write_and_read(spark, docs)
    rows = sorted(map(tuple, tokens.checksums(read).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, 3, 3, 5, 5, 9]
    assert [r[1] for r in rows] == [sum(r[2] for r in rows[:k]) for k in range(6)]
    assert rows[1][2:] == rows[2][2:] == (1, zlib.crc32(b"\0\0\0\0"))
    _, read = write_and_read(spark, docs.filter(F.lit(False)))
    assert tokens.checksums(read).count() == 0


def test_filter_reaches_the_files(spark, capsys):
    path, _ = write_and_read(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    one = tokens.read_tokens(spark, path).filter("doc_id = 17")
    one.explain("formatted")
    assert "EqualTo(doc_id,17)" in capsys.readouterr().out
    assert one.count() == 1
