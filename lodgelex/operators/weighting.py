"""TF-IDF over words and over bigrams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counting import count_by, matches, per_group


def word_tf_idf(counts: DataFrame, doc: str = "country", term: str = "word") -> DataFrame:
    """``tf = n / sum(n) of the document``, ``idf = ln(documents / documents with the term)``.

    ``counts`` has one row per (document, term).  Documents may be markets or listings: a term can be
    in most of them, and its frequency is attached without bringing its rows together.
    """
    # Always true; every use of the counts then needs them whole, and one exchange serves all.
    counts = counts.where("n >= 0")
    totals = counts.groupBy(doc).agg(F.sum("n").alias("total_words"))
    documents = totals.where("total_words > 0").agg(F.count(F.lit(1)).alias("documents"))
    # Null-safe like the other joins, so that all of them read the one exchange of the counts; a term
    # that is in most documents is split by the adaptive skew join.
    frequency = counts.groupBy(F.col(term).alias(f"_{term}")).agg(F.count(F.lit(1)).alias("doc_freq"))
    known = counts.join(frequency, matches([term])).drop(f"_{term}")
    weighted = per_group(
        per_group(known, totals, [doc], "total_words"), documents, [], "documents"
    )
    return (
        weighted.withColumn("tf", F.col("n") / F.col("total_words"))
        .withColumn("idf", F.ln(F.col("documents") / F.col("doc_freq")))
        .withColumn("tf_idf", F.col("tf") * F.col("idf"))
        .select(doc, term, "n", "total_words", "doc_freq", "tf", "idf", "tf_idf")
    )


def total_documents(pairs: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    """Exact number of documents with at least one bigram.

    A document is one listing row.  ``place`` is 0 once in each, so where it is present the distinct
    count is a sum and no document id is shuffled.
    """
    if "place" in pairs.columns:
        counted = F.count_if(F.col("place") == 0)
    else:
        counted = F.count_distinct("document_id")
    return pairs.groupBy(*by).agg(counted.alias("total_documents"))


def bigram_counts(pairs: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    return count_by(pairs, *by, "word1", "word2")


def bigram_tf_idf(
    pairs: DataFrame, by: Sequence[str] = ("country",), n_docs: int | DataFrame | None = None
) -> DataFrame:
    """``tf = n / N``, ``idf = ln(N / n)`` with ``n`` the occurrences of the bigram.

    ``n`` counts occurrences and not documents, so ``idf`` may be negative.  ``N`` is the document
    count of each market, or ``n_docs`` for all of them: a number, or a one-row table with the column
    ``total_documents`` such as another market's count.  One pass over the text: occurrences that
    open a document are counted apart from the later ones, ``n`` is the sum of both and ``N`` that
    of the openings.  Where ``N`` is 0 the weights are null.
    """
    by = list(by)
    if isinstance(n_docs, DataFrame):
        weighted = per_group(bigram_counts(pairs, by), n_docs, [], "total_documents")
    elif n_docs is not None:
        weighted = bigram_counts(pairs, by).withColumn("total_documents", F.lit(n_docs))
    elif "place" in pairs.columns:
        # Both uses of this table need both counts (the filter is always true), so column pruning
        # leaves them the same aggregate and the second one reuses its exchange.
        counts = (
            pairs.groupBy(*by, "word1", "word2")
            .agg(
                F.count_if(F.col("place") == 0).alias("_opening"),
                F.count_if(F.col("place") > 0).alias("_later"),
            )
            .withColumn("n", F.col("_opening") + F.col("_later"))
            .where("n > 0")
        )
        totals = counts.groupBy(*by).agg(F.sum("_opening").alias("total_documents"))
        weighted = per_group(counts, totals, by, "total_documents")
    else:
        weighted = per_group(
            bigram_counts(pairs, by), total_documents(pairs, by), by, "total_documents"
        )
    return weighted_bigrams(weighted, by)


def weighted_bigrams(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The weights of counted bigrams whose rows hold ``n`` and ``total_documents``."""
    documents = F.col("total_documents")
    return (
        counts.withColumn("tf", F.try_divide("n", documents))
        .withColumn("idf", F.ln(documents / F.col("n")))
        .withColumn("tf_idf", F.col("tf") * F.col("idf"))
        .select(*by, "word1", "word2", "n", "tf", "idf", "tf_idf")
    )
