"""Market reports: the tables for every country in one job each, and the set that is saved.

Every report groups by country.  A user who wants one market filters the input or the result; the
filter moves below the tokeniser to the scan either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import LDAModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens_of
from ..operators import listings as li
from ..operators.counting import count_by, top_with_ties
from ..operators.graph import bigram_edges, bigram_nodes
from ..operators.sentiment import (
    BING,
    NRC,
    polarity_table,
    sentiment_comparison,
    slice_class_counts,
)
from ..operators.tokens import bigrams, unite, words
from ..operators.topics import (
    doc_terms,
    fit_topics,
    processed_documents,
    processed_texts,
    top_terms,
    topic_term_beta,
)
from ..operators.weighting import bigram_counts, bigram_tf_idf, total_documents
from ..sources.tables import load_table, save_table, save_tables, save_topic_model
from ..sources.versions import Version, publish

BY = ("country",)


@dataclass(frozen=True)
class Lexicons:
    afinn: DataFrame
    bing: DataFrame
    nrc: DataFrame


def word_counts(
    flat: DataFrame, text: str = "description", stop: DataFrame | None = None
) -> DataFrame:
    """Words per country over the descriptions."""
    return count_by(words(flat, text, keep=BY, stop=stop), *BY, "word")


def top_bigrams(flat: DataFrame, stop: DataFrame, text: str = "text", k: int = 15) -> DataFrame:
    """``country, word1, word2, n, rank``: the ``k`` most frequent bigrams per market, with ties."""
    return top_with_ties(bigram_counts(bigrams(flat, text, stop), BY), BY, "n", k)


def bigram_graph(
    top: DataFrame, more_than: int | None = 15, by: Sequence[str] = BY
) -> tuple[DataFrame, DataFrame]:
    """Edges and nodes of the leading bigrams."""
    edges = bigram_edges(top, by, more_than)
    return edges, bigram_nodes(edges, by)


def comparison(
    flat: DataFrame, lexicons: Lexicons, text: str = "text", every: DataFrame | None = None
) -> DataFrame:
    """Three methods per market; a market without any known word, or any text, scores 0.

    Where ``flat`` is a slice, ``every`` names the table whose markets are all to be listed: those
    without a listing in the slice score 0 too.
    """
    tokens = words(flat, text, keep=BY, outer=True)
    if every is not None:
        silent = every.select(*BY).distinct()
        tokens = tokens.unionByName(silent, allowMissingColumns=True)
    return sentiment_comparison(tokens, lexicons.afinn, lexicons.bing, lexicons.nrc, BY)


def polarity(flat: DataFrame, lexicons: Lexicons, text: str = "text") -> DataFrame:
    return polarity_table(words(flat, text, keep=BY, outer=True), lexicons.bing, lexicons.nrc, BY)


def token_table(flat: DataFrame, text: str = "text") -> DataFrame:
    """What the panels read: one row per listing with its tokens, to be partitioned by country.

    One row per listing rather than per token keeps a document's words in one row, so that bigrams,
    term counts and processed texts of saved listings stay free of shuffles.
    """
    tokens = tokens_of(flat, text).alias("tokens")
    return flat.select(
        "document_id", "country", li.RATING, "number_of_reviews", "coordinates", tokens
    )


def derived_tables(
    flat: DataFrame,
    country: str,
    stop: DataFrame,
    lexicons: Lexicons,
    fitted: tuple[LDAModel, DataFrame] | None = None,
    tokens: DataFrame | None = None,
    docs: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The tables saved for one market, by name; topic terms when a model is given.

    With ``tokens``, a saved token table, no text is taken apart again; with ``docs``, the saved
    processed words of the market, no word is stemmed again.
    """
    source, text = (flat, "text") if tokens is None else (tokens, "tokens")
    market = li.market_slice(source, country)
    pairs = unite(bigrams(market, text, stop))
    market_words = words(market, text)
    if docs is None:
        docs = processed_documents(market, text, stop)
    classes = slice_class_counts(market_words, lexicons.bing, lexicons.nrc)
    tables = {
        "listings": flat,
        "descriptions": li.descriptions(flat),
        "market_words": market_words,
        "market_bing": classes.where(F.col("method") == BING),
        "market_nrc": classes.where(F.col("method") == NRC),
        "market_polarity": polarity(market, lexicons, text),
        "market_comparison": comparison(market, lexicons, text),
        "market_bigrams": pairs.select("document_id", "bigram"),
        "market_bigram_tf_idf": unite(bigram_tf_idf(pairs, BY)),
        "total_documents": total_documents(pairs, BY),
        "processed_words": docs,
        "doc_terms": doc_terms(docs),
        "processed_texts": processed_texts(docs),
        "afinn": lexicons.afinn,
        "bing": lexicons.bing,
        "nrc": lexicons.nrc,
    }
    if fitted is not None:
        tables["top_terms"] = top_terms(topic_term_beta(flat.sparkSession, fitted))
    return tables


def build_tables(
    flat: DataFrame,
    folder: str,
    country: str,
    stop: DataFrame,
    lexicons: Lexicons,
    k: int = 2,
) -> list[str]:
    """The whole batch run for one market: save everything the panels load, return the names.

    The texts of all countries are taken apart once, into the token table; every other table of the
    market is made from its partition there.  Words are stemmed once, into the processed words.
    """
    spark = flat.sparkSession
    save_table(token_table(flat), folder, "tokens", BY)
    tokens = load_table(spark, folder, "tokens")
    market = li.market_slice(tokens, country)
    save_table(processed_documents(market, "tokens", stop), folder, "processed_words")
    docs = load_table(spark, folder, "processed_words")
    fitted = fit_topics(docs, k=k)
    tables = derived_tables(flat, country, stop, lexicons, fitted, tokens, docs)
    del tables["processed_words"]
    names = ["tokens", "processed_words", *save_tables(tables, folder)]
    if fitted is not None:
        save_topic_model(fitted[0], folder)
        names.append("topic_model")
    return names


def publish_tables(
    flat: DataFrame,
    folder: str,
    country: str,
    stop: DataFrame,
    lexicons: Lexicons,
    k: int = 2,
) -> Version:
    """The batch run as one version: panels see all of its tables, or those of the run before."""
    return publish(
        flat.sparkSession,
        folder,
        lambda version: build_tables(flat, version, country, stop, lexicons, k),
    )
