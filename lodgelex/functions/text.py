"""Token expressions.  Everything here is a built-in and stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a run of letters, marks, digits or underscores; single apostrophes and dots join runs
# ("don't", "3.5").
TOKEN_RE = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"


def word_tokens(text: Column) -> Column:
    """Lower-cased tokens of ``text`` in order; null for null."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), F.lit(0))


def tokens_of(df: DataFrame, text: str) -> Column:
    """The tokens of a string column, or an array column as it is."""
    if isinstance(df.schema[text].dataType, T.ArrayType):
        return F.col(text)
    return word_tokens(F.col(text))


def non_empty(tokens: Column) -> Column:
    """Generator of one row holding ``tokens``, or of none when they are empty or null.

    The same as a filter on the size, except that a filter would be pushed below the projection and
    have the tokens computed twice.
    """
    return F.explode(F.filter(F.array(tokens), lambda t: F.size(t) > 0))


def adjacent_words(tokens: str, n: int = 2) -> Column:
    """All runs of ``n`` neighbouring tokens as structs ``(word1, ..., wordn)``.

    ``n`` shifted slices zipped together: no join, no window and no per-element lambda.  An array
    with fewer than ``n`` tokens gives an empty result, so no missing bigram arises.
    """
    runs = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    return F.arrays_zip(
        *[F.slice(F.col(tokens), F.lit(i + 1), runs).alias(f"word{i + 1}") for i in range(n)]
    )


def outside(word: Column, words: Iterable[str]) -> Column:
    """``word`` is in none of ``words``."""
    listed = list(words)
    return ~word.isin(listed) if listed else F.lit(True)


def clean_starts(tokens: str, dropped: Iterable[str]) -> Column:
    """The indexes of tokens that start a pair of neighbours, neither of them in ``dropped``."""
    words, listed = F.col(tokens), list(dropped)
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0)))
    if listed:
        every = F.filter(
            every,
            lambda i: outside(F.get(words, i), listed) & outside(F.get(words, i + 1), listed),
        )
    return F.when(F.size(words) > 1, every).otherwise(F.array().cast("array<int>"))


def run_starts(words: Column) -> Column:
    """The indexes at which the value of a sorted, non-empty array changes."""
    return F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
    )


def run_lengths(words: Column, starts: Column) -> Column:
    """``array<struct<word, n>>``: the distances between the starts of a sorted array."""
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(words)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(F.get(words, a).alias("word"), (b - a).cast("long").alias("n")),
    )
