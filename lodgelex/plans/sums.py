"""Panels from prepared sums: what a slider move needs without taking a text apart.

For every country and every phrase (or nothing, for documents and sentiment) the sums are kept as
steps over the lowest rating: a row holds from ``above`` (exclusive) up to ``rating`` (inclusive) and
says what the sum over all listings rated at least that much is.  A panel with a lowest rating reads
one row per country and phrase, found by two comparisons that reach the scan, and adds countries up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.counting import count_by, descending, top_with_ties
from ..operators.graph import bigram_edges
from ..operators.listings import RATING
from ..operators.sentiment import card_totals, comparison_rows, method_card
from ..operators.tokens import bigrams, unite, words
from ..operators.weighting import weighted_bigrams
from ..sources.tables import load_table, save_table
from .params import Params

#: Names of the prepared tables.
PHRASES, DOCUMENTS, SCORES = "phrase_sums", "document_sums", "score_sums"
LOWEST = -2147483648


def rating_steps(counts: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums from each occurring rating upwards, valid for lowest ratings in (above, rating].

    ``counts`` has one row per ``by`` and rating: a group has no more rows than there are ratings, so
    the window over it is small whatever the group's texts are.
    """
    group = Window.partitionBy(*by)
    falling = group.orderBy(F.desc(RATING))  # one sort for both: the next lower rating comes next
    down = falling.rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        *by, F.col(RATING).alias("rating"),
        F.coalesce(F.lead(RATING).over(falling), F.lit(LOWEST)).alias("above"),
        *[F.sum(m).over(down).alias(m) for m in measures],
    )


def prepared(
    listings: DataFrame,
    stop: DataFrame,
    afinn: DataFrame,
    bing: DataFrame,
    nrc: DataFrame,
    text: str = "text",
) -> dict[str, DataFrame]:
    """The three tables of steps.  Listings without a rating or a country are in no panel."""
    keep = ["country", RATING]
    rated = listings.where(F.col(RATING).isNotNull() & F.col("country").isNotNull())
    pairs = bigrams(rated, text, stop, keep=keep)
    phrases = count_by(pairs, *keep, "word1", "word2")
    # Every listing with a pair has one at place 0: counted from the pairs, no phrase is shuffled.
    documents = count_by(pairs.where(F.col("place") == 0), *keep, name="documents")
    scores = card_totals(words(rated, text, keep=keep), method_card(bing, nrc, afinn), keep)
    totals = [c for c in scores.columns if c not in keep]
    return {
        PHRASES: rating_steps(phrases, ["country", "word1", "word2"], ["n"]),
        DOCUMENTS: rating_steps(documents, ["country"], ["documents"]),
        SCORES: rating_steps(scores, ["country"], totals),
    }


def save_sums(folder: str, tables: dict[str, DataFrame]) -> list[str]:
    for name, table in tables.items():
        save_table(table, folder, name, ["country"] if name == PHRASES else ())
    return list(tables)


def load_sums(
    spark: SparkSession, folder: str, names: Sequence[str] = (PHRASES, DOCUMENTS, SCORES)
) -> dict[str, DataFrame]:
    return {name: load_table(spark, folder, name) for name in names}


def at_rating(steps: DataFrame, params: Params) -> DataFrame:
    """The one row of each group that holds for the chosen lowest rating, in the chosen countries."""
    return steps.where(
        F.col("country").isin(*params.countries)
        & (F.col("rating") >= F.lit(params.min_rating))
        & (F.col("above") < F.lit(params.min_rating))
    )


def phrase_counts(sums: dict[str, DataFrame], params: Params) -> DataFrame:
    chosen = at_rating(sums[PHRASES], params)
    return chosen.groupBy("word1", "word2").agg(F.sum("n").alias("n"))


def bigram_panel(sums: dict[str, DataFrame], params: Params, top: int = 15) -> DataFrame:
    leading = top_with_ties(phrase_counts(sums, params), [], "n", top)
    return descending(bigram_edges(leading, []), "n", "src", "dst")


def tf_idf_panel(
    sums: dict[str, DataFrame], params: Params, top: int = 10, n_docs: int | None = None
) -> DataFrame:
    if n_docs is None:
        chosen = at_rating(sums[DOCUMENTS], params)
        documents = chosen.agg(F.sum("documents").alias("total_documents")).scalar()
    else:
        documents = F.lit(n_docs)
    counted = phrase_counts(sums, params).withColumn("total_documents", documents)
    ranked = top_with_ties(weighted_bigrams(counted, []), [], "tf_idf", top)
    return descending(
        unite(ranked).select("bigram", "n", "tf", "idf", "tf_idf"), "tf_idf", "bigram"
    )


def sentiment_panel(sums: dict[str, DataFrame], params: Params) -> DataFrame:
    """Three rows, 0 where the selection holds no known word or no listing at all."""
    scores = at_rating(sums[SCORES], params)
    totals = [c for c in scores.columns if c not in ("country", "rating", "above")]
    summed = scores.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals])
    return comparison_rows(summed, [])
