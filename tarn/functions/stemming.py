"""Porter stemming (M. F. Porter, 1980) with the usual later refinements.

The stemmer is a small per-word helper. It reaches data through Arrow batches, and the
jobs call it only after equal tokens have been counted together.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Words whose stem does not follow from the rules.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# The published suffix tables, longer suffixes before their own endings.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _ending(suffixes) -> re.Pattern:
    longest_first = sorted(suffixes, key=len, reverse=True)
    return re.compile(f"(?:{'|'.join(longest_first)})$")


_STEP_2, _STEP_3, _STEP_4 = _ending(STEP_2), _ending(STEP_3), _ending(STEP_4)


def _shape(stem: str) -> str:
    """The word as a string of c (consonant) and v (vowel); y after a consonant is a vowel."""
    shape = ""
    for letter in stem:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_ending(stem: str) -> bool:
    shape = _shape(stem)
    return shape == "vc" or (shape.endswith("cvc") and stem[-1] not in "wxy")


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_or_progressive(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word.removesuffix(suffix)
        if stem != word and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _doubled(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_ending(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c" else word


def _double_suffix(word: str) -> str:
    found = _STEP_2.search(word)
    if not found:
        return word
    suffix, stem = found[0], word[: found.start()]
    # For "logi" the l counts as part of the stem when its length is judged.
    if _measure(stem + "l" if suffix == "logi" else stem) == 0:
        return word
    shortened = stem + STEP_2[suffix]
    return _double_suffix(shortened) if suffix == "alli" else shortened


def _derived_suffix(word: str) -> str:
    found = _STEP_3.search(word)
    if found and _measure(word[: found.start()]) > 0:
        return word[: found.start()] + STEP_3[found[0]]
    return word


def _bare_suffix(word: str) -> str:
    found = _STEP_4.search(word)
    if not found:
        return word
    stem = word[: found.start()]
    removable = _measure(stem) > 1 and (found[0] != "ion" or stem.endswith(("s", "t")))
    return stem if removable else word


def _final_e_and_ll(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_ending(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem_word(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (
        _plural, _past_or_progressive, _final_y, _double_suffix,
        _derived_suffix, _bare_suffix, _final_e_and_ll,
    ):
        word = step(word)
    return word


def _stemmed(tokens: pa.Array) -> pa.Array:
    """Each distinct token of the batch is worked once; null stays null."""
    coded = tokens.dictionary_encode()
    stems = pa.array([stem_word(t) for t in coded.dictionary.to_pylist()], pa.string())
    return stems.take(coded.indices)


@F.arrow_udf(StringType())
def stem(tokens: pa.Array) -> pa.Array:
    """Stem a token column."""
    return _stemmed(tokens)


@F.arrow_udf(ArrayType(StringType()))
def stem_all(lists: pa.Array) -> pa.Array:
    """Stem every entry of a list column, keeping order and repeats."""
    lengths = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
    # A null offset marks a null list.
    nulls = np.append(lists.is_null().to_numpy(zero_copy_only=False), False)
    return pa.ListArray.from_arrays(pa.array(ends, mask=nulls), _stemmed(lists.flatten()))
