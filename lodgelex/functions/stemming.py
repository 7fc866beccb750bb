"""Porter's suffix-stripping algorithm (M. F. Porter, "An algorithm for suffix stripping", 1980).

The stemmer itself is a small helper for one word.  ``stem_tokens`` applies it to token arrays: each
Arrow batch is dictionary-encoded first, so a word is looked up once per batch and stemmed once per
task.  The step is narrow.  Joining stems back through a vocabulary table would move
every token row across the network on a key ("the", "room") that a large share of the rows hold.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions travel to the executors with the plan, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stems a task remembers before the older half goes, which words met again leave.
REMEMBERED = 1 << 17
#: Tokens of a batch whose stems are looked up together.
TOGETHER = 1 << 17

# Suffix tables of the published algorithm.
STEP_1A = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)

_VC = re.compile("v+c+")
#: Stems of the words met last, and of those met before them.
_seen: list[dict[str, str]] = [{}, {}]



def _longest_first(suffixes) -> tuple[str, ...]:
    return tuple(sorted(suffixes, key=len, reverse=True))


_ENDINGS = {
    "1a": _longest_first(STEP_1A),
    "1b": _longest_first(("eed", "ed", "ing")),
    "2": _longest_first(STEP_2),
    "3": _longest_first(STEP_3),
    "4": _longest_first(STEP_4),
}


def _split_ending(word: str, step: str) -> tuple[str, str] | None:
    """``word`` before and from the longest suffix listed for the step."""
    listed = _ENDINGS[step]
    if not word.endswith(listed):
        return None
    ending = next(suffix for suffix in listed if word.endswith(suffix))
    return word[: len(word) - len(ending)], ending


def letter_shape(word: str) -> str:
    """``c`` or ``v`` per letter; ``y`` is a vowel exactly when a consonant precedes it."""
    shape = []
    before = "v"
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and before == "c")
        before = "v" if vowel else "c"
        shape.append(before)
    return "".join(shape)


def measure(shape: str) -> int:
    """The number of vowel-consonant groups, ``m`` in the paper."""
    return len(_VC.findall(shape))


def _short_end(word: str, shape: str) -> bool:
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _double_end(word: str, shape: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape[-1] == "c"


def _replace(word: str, step: str, table: dict[str, str]) -> str:
    parts = _split_ending(word, step)
    if parts and measure(letter_shape(parts[0])) > 0:
        return parts[0] + table[parts[1]]
    return word


def _past_and_participle(word: str) -> str:
    parts = _split_ending(word, "1b")
    if not parts:
        return word
    stem, ending = parts
    shape = letter_shape(stem)
    if ending == "eed":
        return stem + "ee" if measure(shape) > 0 else word
    if "v" not in shape:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_end(stem, shape) and stem[-1] not in "lsz":
        return stem[:-1]
    if measure(shape) == 1 and _short_end(stem, shape):
        return stem + "e"
    return stem


def _final_e(word: str) -> str:
    if not word.endswith("e"):
        return word
    stem = word[:-1]
    shape = letter_shape(stem)
    m = measure(shape)
    return stem if m > 1 or (m == 1 and not _short_end(stem, shape)) else word


def porter_stem(word: str) -> str:
    parts = _split_ending(word, "1a")
    if parts:
        word = parts[0] + STEP_1A[parts[1]]
    word = _past_and_participle(word)
    if word.endswith("y") and "v" in letter_shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, "2", STEP_2)
    word = _replace(word, "3", STEP_3)
    parts = _split_ending(word, "4")
    if parts:
        stem, ending = parts
        kept_by_ion = ending == "ion" and not stem.endswith(("s", "t"))
        if measure(letter_shape(stem)) > 1 and not kept_by_ion:
            word = stem
    word = _final_e(word)
    if word.endswith("ll") and measure(letter_shape(word[:-1])) > 1:
        word = word[:-1]
    return word


def _remembered_stem(word: str | None) -> str | None:
    if word is None:
        return None
    recent, older = _seen
    stem = recent.get(word)
    if stem is None:
        stem = older.get(word)
        if stem is None:
            stem = porter_stem(word)
        if len(recent) >= REMEMBERED // 2:
            recent = {}
            _seen[:] = [recent, _seen[0]]
        recent[word] = stem
    return stem


def _stem_values(words: pa.Array) -> pa.Array:
    """Stem the distinct values only."""
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    stems = [_remembered_stem(word) for word in coded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(coded.indices)


def stem_slices(words: pa.Array) -> pa.Array:
    """Stems of any number of words, so many at a time that what is kept beside them is bounded."""
    parts = [
        _stem_values(words.slice(a, TOGETHER).cast(pa.string())) for a in range(0, len(words), TOGETHER)
    ]
    return pa.concat_arrays([pa.array([], pa.string()), *parts])


@F.arrow_udf(T.StringType())
def stem_word(words: pa.Array) -> pa.Array:
    """Stem a column of words; used on a vocabulary."""
    return stem_slices(words)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_arrays(tokens: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(tokens), 0)
    ends = pc.cumulative_sum(lengths).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    stems = stem_slices(pc.list_flatten(tokens))
    return pa.ListArray.from_arrays(offsets, stems, mask=pc.is_null(tokens))


def stem_tokens(tokens: Column | str) -> Column:
    """Stem every word of a token array, keeping order."""
    return _stem_arrays(tokens)
