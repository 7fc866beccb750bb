"""Lexicon joins and the summaries built on them.

Lexicons are small and fixed, texts are not.  So whatever can be done to the lexicon is done there:
the union of methods and the spread of classes to columns happen on lexicon rows, and the tokens are
read once for all three methods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast
from .counting import count_by

# Method labels and the classes that make up polarity.
AFINN = "AFINN"
BING = "Bing et al."
NRC = "NRC"
POLARITY = ("negative", "positive")


def known_word_counts(words: DataFrame, lexicon: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by..., word, n`` for the words the lexicon knows.

    A lexicon of checked size filters the tokens before anything is shuffled.  Any other is joined
    after counting, when even the most frequent word is down to one row per market.
    """
    listed = lexicon.select("word")
    if fits_broadcast(listed):
        return count_by(words.join(F.broadcast(listed), "word", "left_semi"), *by, "word")
    return count_by(words, *by, "word").join(listed, "word", "left_semi")


def lexicon_hits(words: DataFrame, lexicon: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counted words with their lexicon rows; a word with several rows appears several times."""
    side = F.broadcast(lexicon) if fits_broadcast(lexicon) else lexicon
    return known_word_counts(words, lexicon, by).join(side, "word")


def class_totals(
    words: DataFrame, lexicon: DataFrame, by: Sequence[str] = ("country",), weighted: bool = False
) -> DataFrame:
    """Words per sentiment class: distinct words, or occurrences when ``weighted``."""
    n = F.sum("n") if weighted else F.count(F.lit(1))
    return lexicon_hits(words, lexicon, by).groupBy(*by, "sentiment").agg(n.alias("n"))


def slice_class_counts(
    words: DataFrame, bing: DataFrame, nrc: DataFrame, by: Sequence[str] = ("country",)
) -> DataFrame:
    """Occurrences per method and class: all classes of the first lexicon, polarity of the second.

    The lexicons are one table with a column for the method, so texts are taken apart once.
    """
    both = bing.select("word", F.lit(BING).alias("method"), "sentiment").unionByName(
        nrc.where(F.col("sentiment").isin(*POLARITY)).select(
            "word", F.lit(NRC).alias("method"), "sentiment"
        )
    )
    hits = lexicon_hits(words, both, by)
    return hits.groupBy(*by, "method", "sentiment").agg(F.sum("n").alias("n"))


def score_totals(
    words: DataFrame, lexicon: DataFrame, by: Sequence[str] = ("country",), weighted: bool = False
) -> DataFrame:
    """Summed scores of the known words, once per distinct word or per occurrence."""
    value = F.col("value") * F.col("n") if weighted else F.col("value")
    return (
        lexicon_hits(words, lexicon, by)
        .groupBy(*by)
        .agg(F.sum(value.cast("long")).alias("total_afinn_score"))
        .withColumn("is_positive", F.col("total_afinn_score") > 0)
    )


def mostly_used(
    words: DataFrame, lexicon: DataFrame, by: Sequence[str] = ("country",)
) -> DataFrame:
    """How often each word of the lexicon occurs."""
    return lexicon_hits(words, lexicon, by).groupBy(*by, "word").agg(F.sum("n").alias("n"))


def method_card(
    bing: DataFrame, nrc: DataFrame, afinn: DataFrame | None = None
) -> DataFrame:
    """One row per word with its total weight under every method and class."""
    tagged = (
        bing.select("word", F.lit("bing").alias("method"), "sentiment")
        .unionByName(nrc.select("word", F.lit("nrc").alias("method"), "sentiment"))
        .where(F.col("sentiment").isin(*POLARITY))
        .withColumn("weight", F.lit(1))
    )
    columns = [f"{method}_{c}" for method in ("bing", "nrc") for c in POLARITY]
    if afinn is not None:
        scores = afinn.select(
            "word", F.lit("afinn").alias("method"), F.lit("score").alias("sentiment"),
            F.col("value").alias("weight"),
        )
        tagged = tagged.unionByName(scores)
        columns.append("afinn_score")
    return (
        tagged.withColumn("column", F.concat_ws("_", "method", "sentiment"))
        .groupBy("word")
        .pivot("column", columns)
        .agg(F.sum("weight"))
        .na.fill(0)
    )


def card_totals(words: DataFrame, card: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum the card over all tokens of each slice; a slice without a known word sums to 0.

    ``words`` should come from an outer explode where markets without tokens are to be kept.
    """
    weights = [c for c in card.columns if c != "word"]
    if fits_broadcast(card):
        scored = words.join(F.broadcast(card), "word", "left").withColumn("n", F.lit(1))
    else:
        scored = count_by(words, *by, "word").join(card, "word", "left")
    return scored.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.col("n") * F.col(c).cast("long")), F.lit(0)).alias(c)
            for c in weights
        ]
    )


def polarity_table(
    words: DataFrame, bing: DataFrame, nrc: DataFrame, by: Sequence[str] = ("country",)
) -> DataFrame:
    """Negative and positive occurrences per method, and their difference."""
    totals = card_totals(words, method_card(bing, nrc), by)
    rows = [
        F.struct(
            F.lit(label).alias("method"),
            F.col(f"{method}_negative").alias("negative"),
            F.col(f"{method}_positive").alias("positive"),
            (F.col(f"{method}_positive") - F.col(f"{method}_negative")).alias("sentiment_score"),
        )
        for label, method in ((BING, "bing"), (NRC, "nrc"))
    ]
    return totals.select(*by, F.inline(F.array(*rows)))


def sentiment_comparison(
    words: DataFrame,
    afinn: DataFrame,
    bing: DataFrame,
    nrc: DataFrame,
    by: Sequence[str] = ("country",),
) -> DataFrame:
    """The three methods side by side: ``by..., sentiment, method``, three rows per slice."""
    return comparison_rows(card_totals(words, method_card(bing, nrc, afinn), by), by)


def comparison_rows(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summed cards as three rows per slice."""
    rows = [
        F.struct(score.alias("sentiment"), F.lit(label).alias("method"))
        for label, score in (
            (AFINN, F.col("afinn_score")),
            (BING, F.col("bing_positive") - F.col("bing_negative")),
            (NRC, F.col("nrc_positive") - F.col("nrc_negative")),
        )
    ]
    return totals.select(*by, F.inline(F.array(*rows)))
