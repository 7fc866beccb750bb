"""The five dashboard panels as queries over chosen countries and a lowest rating.

``flat`` is a flattened listing table, or the saved token table of ``markets.token_table``: that one
is partitioned by country, so the choice of countries prunes partitions, the rating filter reaches
the scan, and ``text="tokens"`` skips the tokeniser.  The chosen countries form one slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import listings as li
from ..operators.counting import descending, top_with_ties
from ..operators.graph import bigram_edges
from ..operators.sentiment import sentiment_comparison
from ..operators.tokens import bigrams, unite, words
from ..operators.topics import fit_topics, processed_documents, top_terms, topic_term_beta
from ..operators.weighting import bigram_counts, bigram_tf_idf
from .params import Params


def selection(flat: DataFrame, params: Params) -> DataFrame:
    return li.at_least_rated(li.in_countries(flat, params.countries), params.min_rating)


def bigram_panel(
    flat: DataFrame, params: Params, stop: DataFrame, text: str = "text", top: int = 15
) -> DataFrame:
    """The edges behind the phrase graph: ``src, dst, n, width``, most frequent first."""
    pairs = bigrams(selection(flat, params), text, stop, keep=["document_id"])
    leading = top_with_ties(bigram_counts(pairs, []), [], "n", top)
    return descending(bigram_edges(leading, []), "n", "src", "dst")


def sentiment_panel(
    flat: DataFrame,
    params: Params,
    afinn: DataFrame,
    bing: DataFrame,
    nrc: DataFrame,
    text: str = "text",
) -> DataFrame:
    tokens = words(selection(flat, params), text, keep=[])
    return sentiment_comparison(tokens, afinn, bing, nrc, by=[])


def tf_idf_panel(
    flat: DataFrame,
    params: Params,
    stop: DataFrame,
    text: str = "text",
    top: int = 10,
    n_docs: int | DataFrame | None = None,
) -> DataFrame:
    pairs = bigrams(selection(flat, params), text, stop, keep=["document_id"])
    ranked = top_with_ties(bigram_tf_idf(pairs, [], n_docs), [], "tf_idf", top)
    return descending(
        unite(ranked).select("bigram", "n", "tf", "idf", "tf_idf"), "tf_idf", "bigram"
    )


def topic_panel(
    flat: DataFrame,
    params: Params,
    stop: DataFrame,
    text: str = "text",
    k: int = 2,
    top: int = 10,
) -> DataFrame:
    """Leading terms per topic, with the topic as a category label as well.

    An empty table when the selection holds no text.
    """
    docs = processed_documents(selection(flat, params), text, stop, keep=["document_id"])
    leading = top_terms(topic_term_beta(flat.sparkSession, fit_topics(docs, k=k)), top)
    return leading.withColumn("topic_label", F.col("topic").cast("string"))


def map_panel(
    flat: DataFrame, params: Params, text: str = "text", more_reviews_than: int = 2
) -> DataFrame:
    chosen = li.more_reviews_than(selection(flat, params), more_reviews_than)
    return li.map_points(li.with_text(chosen, text))
