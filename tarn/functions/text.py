"""Text expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode text processing understands it: the White_Space property plus the
# four separator controls. The plain class \s would be ASCII only.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# The first letter of each word made of letters alone.
LETTER_WORDS = r"(?U)(?<![^\s\x1c-\x1f])(\p{L})\p{L}*+(?![^\s\x1c-\x1f])"

DIGITS = r"^[\p{Nd}\u00b2\u00b3\u00b9\u2070\u2074-\u2079\u2080-\u2089]+$"

# Words, clitics and single marks, in the manner of Penn Treebank tokenisation. A comma or colon
# between digits and an apostrophe inside a word belong to it, unless a clitic follows; so does a
# period behind it that does not end the text.
WORDS_AND_MARKS = (
    r"'(?:s|m|d|ll|re|ve)(?![\p{L}\p{N}])"
    r"|n't(?![\p{L}\p{N}])"
    r"|[\p{L}\p{N}]+?(?=n't(?![\p{L}\p{N}]))"
    r"|[\p{L}\p{N}]+(?:(?:[-./]|(?<=\p{N})[,:](?=\p{N})|'(?!(?:s|m|d|ll|re|ve)(?![\p{L}\p{N}])))[\p{L}\p{N}]+)*"
    r"(?:\.(?=\s+\S))?"
    r"|\.\.\.|--|[^\p{L}\p{N}\s]"
)

# The English stop words and punctuation tokens left out of titles.
# fmt: off
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her",
    "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves",
    "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was",
    "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s",
    "t", "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re",
    "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn",
    "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren",
    "weren't", "won", "won't", "wouldn", "wouldn't",
)
# fmt: on
PUNCTUATION = (",", "(", ")", "'s", ".", ":", "&")


def words(text: Column) -> Column:
    """Split on runs of white space; no empty entries."""
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")


def words_and_marks(text: Column) -> Column:
    """Words, clitics such as ``'s``, and punctuation marks as separate tokens."""
    return F.regexp_extract_all(text, F.lit(WORDS_AND_MARKS), F.lit(0))


TOKENIZERS = {"word": words_and_marks, "whitespace": words}


def is_digits(word: Column) -> Column:
    return word.rlike(DIGITS)


def first_letters(text: Column) -> Column:
    """First letters of the purely alphabetic words of a text."""
    return F.regexp_extract_all(text, F.lit(LETTER_WORDS), F.lit(1))


def title_words(title: Column, tokenizer: str = "word") -> Column:
    """Lower-cased title tokens without stop words, punctuation and plain numbers."""
    tokens = TOKENIZERS[tokenizer](F.lower(title))
    return F.filter(tokens, lambda w: ~w.isin(*STOP_WORDS, *PUNCTUATION) & ~is_digits(w))


def year_of(title: Column) -> Column:
    """The first four digits in a row, always a string; ``'0'`` where there are none."""
    found = F.regexp_extract(title, "[0-9]{4}", 0)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("0"))


def genre_words(genres: Column) -> Column:
    """Lower-cased parts of a pipe-separated list."""
    return F.split(F.lower(genres), r"\|")
