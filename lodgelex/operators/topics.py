"""Documents of processed words, their term counts, and LDA topics over them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stemming import stem_tokens, stem_word
from ..functions.text import non_empty, outside, run_lengths, run_starts, tokens_of
from ..schema import TOPIC_TERMS
from ..session import shared_folder
from .counting import top_with_ties
from .identifiers import contiguous_ids
from .tokens import KEYS, dropped_words, small_side, without_stop_words

#: Terms shorter than this are left out of the document-term matrix.
SHORTEST_TERM = 3

#: Documents in one partition of the vectors, until there are ``FIT_PARTS`` of them; they then grow up to
#: ``FIT_MOST``.  The layout depends on the documents alone, so a fit does not depend on the number of
#: cores.  In every iteration each partition makes a k by terms matrix that is dealt out to be added up.
FIT_ROWS, FIT_PARTS, FIT_MOST = 2_000, 11, 200_000


def processed_documents(
    listings: DataFrame,
    text: str = "text",
    stop: DataFrame | None = None,
    stem: bool = True,
    keep: Sequence[str] = KEYS,
) -> DataFrame:
    """One row per document that keeps a word: ``keep..., tokens``, in text order.

    ``keep`` must identify the document.  Tokenising, the stop list and the stems all work on the
    array of one row, so nothing is shuffled.  Only where more stop words occur than a literal set takes
    are the tokens taken apart for an anti join, and those of each row put together again, with the same
    result.
    """
    known = listings.where(F.col(text).isNotNull())
    tokens = tokens_of(known, text)
    listed = [] if stop is None else dropped_words(known, text, stop)
    if listed is None:
        # A projection of its own: next to a generator the id would count its output.
        numbered = known.withColumn("_row", F.monotonically_increasing_id())
        exploded = numbered.select("_row", *keep, F.posexplode(tokens).alias("pos", "word"))
        known = ordered_tokens(without_stop_words(exploded, stop), ["_row", *keep])
        tokens = F.col("tokens")
    elif listed:
        tokens = F.filter(tokens, lambda w: outside(w, listed))
    if stem:
        tokens = stem_tokens(tokens)
    return known.select(*keep, non_empty(tokens).alias("tokens"))


def ordered_tokens(tokens: DataFrame, keep: Sequence[str] = KEYS) -> DataFrame:
    """Put a token table together again: one array per document, by token position.

    A group is one document, whose tokens came out of one row.
    """
    pairs = F.array_sort(F.collect_list(F.struct("pos", "word")))
    return tokens.groupBy(*keep).agg(F.transform(pairs, lambda p: p["word"]).alias("tokens"))


def processed_texts(docs: DataFrame, keep: Sequence[str] = KEYS) -> DataFrame:
    """The corpus: the processed words of each document as one string."""
    return docs.select(*keep, F.array_join("tokens", " ").alias("text"))


def doc_terms(docs: DataFrame, keep: Sequence[str] = KEYS) -> DataFrame:
    """Term counts per document: ``keep..., word, n``.

    A document sits in one row, so its counts need no shuffle: they are the lengths of the runs in
    its sorted tokens.
    """
    words = F.col("_sorted")
    runs = docs.select(*keep, F.sort_array("tokens").alias("_sorted")).select(
        *keep, "_sorted", run_starts(words).alias("_starts")
    )
    return runs.select(*keep, F.inline(run_lengths(words, F.col("_starts"))))


def word_stems(words: DataFrame) -> DataFrame:
    """The vocabulary with its stems, one row per distinct word."""
    return words.select("word").distinct().withColumn("stem", stem_word("word"))


def long_terms(docs: DataFrame) -> DataFrame:
    """Documents reduced to the terms of the matrix; documents without any are left out."""
    kept = F.filter("tokens", lambda term: F.length(term) >= SHORTEST_TERM)
    return docs.select("document_id", non_empty(kept).alias("tokens"))


def document_term_matrix(docs: DataFrame) -> DataFrame:
    """``document_id, term, n`` over the terms that topics are fitted on."""
    counted = doc_terms(long_terms(docs), ["document_id"])
    return counted.withColumnRenamed("word", "term")


def vocabulary_of(terms: DataFrame, min_df: int = 1) -> DataFrame:
    """``index, term, n``: the terms found in at least ``min_df`` documents, numbered from 0, the most
    frequent first, ties by term.

    The numbers come from ranges and their sizes, so the vocabulary is never in one place.
    """
    counted = (
        doc_terms(terms, ["document_id"])
        .groupBy(F.col("word").alias("term"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_df)
        .select("term", "n", (-F.col("n")).alias("_rank"))
    )
    numbered = contiguous_ids(counted, "_rank", "_place", then=["term"])
    return numbered.select((F.col("_place") - 1).cast("int").alias("index"), "term", "n")


def term_vectors(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``document_id, _order, features``: sparse counts over the numbered vocabulary, written once.

    A vocabulary of checked size is broadcast, any other joined.  The arrays of a vector are stored as
    they are and read back as vectors, without Python.
    """
    rows = terms.withColumns(
        {"_row": F.monotonically_increasing_id(), "_order": F.xxhash64("document_id", "tokens")}
    )
    keys = ["_row", "document_id", "_order"]
    counted = doc_terms(rows, keys)
    names = vocabulary.select("index", F.col("term").alias("word"))
    found = counted.join(small_side(names), "word").groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("index", F.col("n").cast("double").alias("n")))).alias("_pairs")
    )
    size = vocabulary.agg(F.count(F.lit(1)).cast("int")).scalar()
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        size.alias("size"),
        F.col("_pairs.index").alias("indices"),
        F.col("_pairs.n").alias("values"),
    )
    spark = terms.sparkSession
    folder = shared_folder(spark, f"lodgelex-topics/{uuid.uuid4().hex}/vectors")
    found.select("document_id", "_order", vector.alias("features")).write.parquet(folder)
    stored = [terms.schema["document_id"], T.StructField("_order", T.LongType())]
    schema = T.StructType([*stored, T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(folder)


def fit_parts(documents: int) -> int:
    """In how many partitions that many documents are laid out."""
    return max(min(-(-documents // FIT_ROWS), FIT_PARTS), -(-documents // FIT_MOST))


def fit_topics(
    docs: DataFrame,
    k: int = 2,
    min_df: int = 1,
    seed: int = 42,
    max_iter: int = 20,
) -> tuple[LDAModel, DataFrame] | None:
    """LDA by online variational Bayes and its vocabulary; ``None`` when no document has a term.

    Every iteration draws from all documents at rate 1.  The terms are written once, since vocabulary and
    vectors read them, and so are the vectors, since every iteration does.  The vocabulary is a table with a fixed order and the vectors have a layout
    that depends on the documents only, so one seed gives one model.  No vocabulary is refused or cut;
    ``min_df`` is the way to say which terms may go.  The model itself keeps its k topic rows on the
    driver and in the tasks, 8 * k bytes a term.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, f"lodgelex-topics/{uuid.uuid4().hex}/terms")
    long_terms(docs).write.parquet(folder)
    terms = spark.read.schema(long_terms(docs).schema).parquet(folder)
    vocabulary = vocabulary_of(terms, min_df)
    if vocabulary.isEmpty():
        return None
    vectors = term_vectors(terms, vocabulary)
    parts = fit_parts(vectors.count())
    laid_out = vectors.repartition(parts, "_order").sortWithinPartitions("_order", "document_id")
    lda = LDA(
        k=k, seed=seed, maxIter=max_iter, optimizer="online", featuresCol="features",
        subsamplingRate=1.0,
    )
    return lda.fit(laid_out), vocabulary


#: How a saved model keeps its topics: a matrix with a row per term and a column per topic.
MATRIX = T.StructType.fromJson({"type": "struct", "fields": [
    {"name": name, "type": kind, "nullable": True, "metadata": {}}
    for name, kind in (
        ("numRows", "integer"), ("numCols", "integer"),
        ("values", {"type": "array", "elementType": "double", "containsNull": True}),
        ("isTransposed", "boolean"),
    )
]})


def topic_term_beta(spark, fitted: tuple[LDAModel, DataFrame] | None) -> DataFrame:
    """``topic, term, beta`` in long form, topics from 1; empty when there was nothing to fit.

    The topic rows are read from the saved model and joined with the vocabulary by term number, so no
    term passes through the driver.
    """
    if fitted is None:
        return spark.createDataFrame([], TOPIC_TERMS)
    model, vocabulary = fitted
    folder = shared_folder(spark, f"lodgelex-topics/{uuid.uuid4().hex}/model")
    model.write().overwrite().save(folder)
    stored = spark.read.schema(T.StructType([T.StructField("topicsMatrix", MATRIX)]))
    matrix = stored.parquet(f"{folder}/data").select("topicsMatrix.*")
    cells = matrix.select(
        "numRows", "numCols", "isTransposed", F.posexplode("values").alias("at", "weight")
    )
    across, down = F.col("at") % F.col("numCols"), F.floor(F.col("at") / F.col("numCols"))
    long = cells.select(
        F.when(F.col("isTransposed"), across).otherwise(F.floor(F.col("at") / F.col("numRows")))
        .cast("int").alias("column"),
        F.when(F.col("isTransposed"), down).otherwise(F.col("at") % F.col("numRows"))
        .cast("int").alias("index"),
        "weight",
    )
    totals = long.groupBy("column").agg(F.sum("weight").alias("total"))
    return (
        long.join(F.broadcast(totals), "column")  # one row per topic of the model
        .join(vocabulary, "index")
        .select(
            (F.col("column") + 1).alias("topic"), "term", (F.col("weight") / F.col("total")).alias("beta")
        )
    )


def top_terms(beta: DataFrame, top: int = 10) -> DataFrame:
    """The leading terms of each topic, ties kept, strongest first."""
    ranked = top_with_ties(beta, ["topic"], "beta", top)
    return ranked.select("topic", "term", "beta").orderBy("topic", F.desc("beta"), "term")
