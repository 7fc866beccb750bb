"""Words and bigrams: from one row per listing to one row per token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import adjacent_words, clean_starts, tokens_of
from ..session import LITERAL_WORDS, fits_broadcast

KEYS = ("document_id", "country")


def listed_words(stop: DataFrame, limit: int = LITERAL_WORDS) -> list[str] | None:
    """The distinct words of a short list; ``None`` when it has more than ``limit`` of them.

    The limit picks between two plans with one result: see ``clean_pairs`` and ``clean_tokens``.
    """
    rows = stop.select("word").where("word is not null").distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(row.word for row in rows)


def dropped_words(listings: DataFrame, text: str, stop: DataFrame) -> list[str] | None:
    """The words to drop from the texts: a short list whole, of a long one those that do occur.

    A long list is met by the words where they are; what leaves a task are its words that occur, once
    each, and not the texts.  ``None`` when more than a literal set takes occur.
    """
    listed = listed_words(stop)
    if listed is not None:
        return listed
    occurring = words(listings, text, keep=[]).select("word")
    known = stop.select("word")
    if fits_broadcast(known):
        met = occurring.join(F.broadcast(known), "word", "left_semi").distinct()
    else:
        met = occurring.distinct().join(known, "word", "left_semi")
    return listed_words(met)


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast a word table if its estimated size allows it, else leave the join to the planner."""
    return F.broadcast(df) if fits_broadcast(df) else df


def without_stop_words(tokens: DataFrame, stop: DataFrame, word: str = "word") -> DataFrame:
    """Anti join on one word column."""
    listed = small_side(stop.select(F.col("word").alias(word)))
    return tokens.join(listed, word, "left_anti")


def words(
    listings: DataFrame,
    text: str = "text",
    keep: Sequence[str] = KEYS,
    stop: DataFrame | None = None,
    outer: bool = False,
) -> DataFrame:
    """One row per token: ``keep..., pos, word``.

    ``text`` names a string column or an array of tokens already made.  With ``outer`` a listing
    without any token keeps one row with a null word, so that its market is not lost.
    """
    # The tokeniser sits inside the generator: exploding a projected array instead would make the
    # optimizer infer a filter on its size, that is, a second run of the tokeniser below it.
    explode = F.posexplode_outer if outer else F.posexplode
    tokens = listings.select(*keep, explode(tokens_of(listings, text)).alias("pos", "word"))
    return tokens if stop is None else without_stop_words(tokens, stop)


def bigrams(
    listings: DataFrame,
    text: str = "text",
    stop: DataFrame | None = None,
    keep: Sequence[str] = KEYS,
) -> DataFrame:
    """Neighbouring words of a listing, neither of them a stop word: ``keep..., place, word1, word2``.

    ``place`` numbers the pairs that remain in their listing from 0.  With a short stop list the pairs
    are filtered inside the row, and so with the words of a long list that occur in the texts; where
    those are too many as well, the list is anti joined twice, and the pairs of each row are put
    together again.
    """
    # A projection of its own, since the pairs refer to the tokens several times.
    tokens = listings.select(*keep, tokens_of(listings, text).alias("_tokens"))
    listed = [] if stop is None else dropped_words(listings, text, stop)
    if listed is None:
        return clean_pairs(tokens, adjacent_words("_tokens"), stop, keep)
    # A pair is the index of its first word, and the words are looked up in the row's one array.  The
    # lambda stays out of the generator, which is then compiled together with what counts the pairs.
    placed = tokens.withColumn("_starts", clean_starts("_tokens", listed))
    starts = F.slice("_starts", F.lit(1), F.size("_starts"))
    return placed.select(*keep, "_tokens", F.posexplode(starts).alias("place", "_at")).select(
        *keep,
        "place",
        F.get("_tokens", F.col("_at")).alias("word1"),
        F.get("_tokens", F.col("_at") + 1).alias("word2"),
    )


def clean_pairs(
    tokens: DataFrame, pairs: Column, stop: DataFrame, keep: Sequence[str]
) -> DataFrame:
    """The pairs without stop words by anti joins: a group is one row's pairs, whatever its id is."""
    # A projection of its own: next to a generator the id would count its output.
    numbered = tokens.withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.select("_row", *keep, F.posexplode(pairs).alias("_at", "_pair")).select(
        "_row", *keep, "_at", "_pair.word1", "_pair.word2"
    )
    clean = without_stop_words(without_stop_words(placed, stop, "word1"), stop, "word2")
    row = F.array_sort(F.collect_list(F.struct("_at", "word1", "word2")))
    return (
        clean.groupBy("_row", *keep)
        .agg(row.alias("_pairs"))
        .select(*keep, F.posexplode("_pairs").alias("place", "_pair"))
        .select(*keep, "place", "_pair.word1", "_pair.word2")
    )


def unite(pairs: DataFrame, name: str = "bigram") -> DataFrame:
    """Write the two words as one string, in a column before which nothing else changes."""
    return pairs.withColumn(name, F.concat_ws(" ", "word1", "word2"))


def separate(df: DataFrame, name: str = "bigram") -> DataFrame:
    """Split a loaded bigram string into ``word1`` and ``word2``."""
    parts = F.split(F.col(name), " ")
    return df.withColumn("word1", F.get(parts, F.lit(0))).withColumn(
        "word2", F.get(parts, F.lit(1))
    )


def ngrams(
    listings: DataFrame, n: int, text: str = "text", keep: Sequence[str] = KEYS
) -> DataFrame:
    """``n`` neighbouring words, one column each."""
    tokens = listings.select(*keep, tokens_of(listings, text).alias("_tokens"))
    return tokens.select(*keep, F.inline(adjacent_words("_tokens", n)))
