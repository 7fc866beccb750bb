"""Every operator as a query ``(spark, folder) -> DataFrame`` over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgelex.functions.folding import fold
from lodgelex.functions.text import word_tokens
from lodgelex.operators import listings as li
from lodgelex.operators.counting import count_by, descending, round_half_up
from lodgelex.operators.documents import aggregate, find
from lodgelex.operators.identifiers import contiguous_ids
from lodgelex.operators.segmentation import segmented
from lodgelex.operators.sentiment import (
    class_totals,
    mostly_used,
    score_totals,
    slice_class_counts,
)
from lodgelex.operators.tokens import bigrams, separate, unite, words
from lodgelex.operators.topics import (
    doc_terms,
    document_term_matrix,
    fit_topics,
    processed_documents,
    processed_texts,
    top_terms,
    topic_term_beta,
    word_stems,
)
from lodgelex.operators.weighting import bigram_tf_idf, total_documents, word_tf_idf
from lodgelex.plans import markets, panels, sums
from lodgelex.plans.params import Params
from lodgelex.session import shared_folder, spread
from lodgelex.sources.checked import check_listings, check_score_lexicon
from lodgelex.sources.listings import listings_from_documents, read_listings
from lodgelex.sources.samples import (
    sample_afinn,
    sample_bing,
    sample_nrc,
    sample_stop_words,
)
from lodgelex.sources.tables import load_table, save_table, save_tables
from lodgelex.sources.versions import current, publish
from lodgelex.sources.words import (
    default_stop_words,
    read_class_lexicon,
    read_score_lexicon,
    read_stop_words,
)

MARKET = "de"
PINNED_DOCUMENTS = 145
PLANTED = ("de", "fr")
LEADERS = 5
PANEL = Params(countries=("en", "de"), min_rating=50)
KEYS = ["document_id", "country"]


def flat(spark: SparkSession, folder: str) -> DataFrame:
    return li.flatten(listings_from_documents(spark, folder))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Listings whose text is about to be taken apart."""
    return spread(flat(spark, folder), "document_id")


def lexicons(spark: SparkSession) -> markets.Lexicons:
    return markets.Lexicons(sample_afinn(spark), sample_bing(spark), sample_nrc(spark))


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, f"lodgelex-tables/{uuid.uuid4().hex}")


def long_stop_words(spark: SparkSession) -> DataFrame:
    """The sample list and more words than a literal set takes, none of which occurs."""
    absent = spark.range(12_000).selectExpr("concat('absent word ', id) as word")
    return sample_stop_words(spark).unionByName(absent)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns({c: round_half_up(c) if c in doubles else F.round(c, 6) for c in columns})


def country_words(spark: SparkSession, folder: str) -> DataFrame:
    return words(texts(spark, folder), "description", keep=["country"])


def clean_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return bigrams(texts(spark, folder), "text", sample_stop_words(spark))


# Listings -----------------------------------------------------------------------------------------


def listings_flat(spark, folder):
    return flat(spark, folder).select("document_id", "country", "market", "text", li.RATING)


def rated_texts(spark, folder):
    return li.rated_texts(flat(spark, folder))


def country_counts(spark, folder):
    return li.country_counts(flat(spark, folder))


def market_slice(spark, folder):
    return li.descriptions(li.market_slice(flat(spark, folder), MARKET))


def find_bedrooms_price(spark, folder):
    return li.find_by_rooms_and_price(flat(spark, folder)).select(
        "document_id", "bedrooms", "price", "room_type"
    )


def avg_price_by_room_type(spark, folder):
    return rounded(li.average_price(flat(spark, folder)), "avg_price")


def high_rated(spark, folder):
    return li.high_rated(flat(spark, folder)).select(
        "document_id", "country", li.RATING, "number_of_reviews"
    )


def document_ids(spark, folder):
    numbered = contiguous_ids(flat(spark, folder).select(F.col("document_id").alias("id")), "id")
    return numbered.select("id", "document_id")


def document_ids_text_key(spark, folder):
    """Numbers in the order of a text key."""
    key = F.concat_ws("/", "market", F.col("document_id").cast("string")).alias("key")
    return contiguous_ids(flat(spark, folder).select(key), "key")


def document_ids_hot_key(spark, folder):
    """Numbers by a key that most listings share and many lack, and by the listing's own key then."""
    keyed = flat(spark, folder).select(
        F.nullif("country", F.lit(MARKET)).alias("key"), F.col("document_id").alias("id")
    )
    return contiguous_ids(keyed, "key", then=["id"])


def listings_numbered(spark, folder):
    numbered = li.flatten(listings_from_documents(spark, folder), numbered=True)
    return numbered.select("document_id", "country", "market", "description")


def map_points(spark, folder):
    return li.map_points(li.market_slice(flat(spark, folder), "en"), keep=["document_id"])


def _round_trip(spark, folder, fmt):
    """The whole collection written nested, read with the listing reader and flattened."""
    target = new_folder(spark)
    listings_from_documents(spark, folder).write.format(fmt).save(target)
    return li.flatten(read_listings(spark, target, fmt)).select(
        "document_id", "country", "market", "text", "description", li.RATING, "number_of_reviews",
        "bedrooms", "price", "room_type",
    )


def listings_json_round_trip(spark, folder):
    return _round_trip(spark, folder, "json")


def listings_parquet_round_trip(spark, folder):
    return _round_trip(spark, folder, "parquet")


#: Query documents over nested listings, by the name of their query.
FOUND = {
    "find_by_document": {"bedrooms": 2, "price": {"$gt": 50}},
    "find_any_of": {"$or": [{"bedrooms": {"$in": [0, 3]}}, {"price": {"$gte": 100, "$lt": 140}}]},
    "find_missing_rating": {"review_scores.review_scores_rating": None},
    "find_none_of": {
        "address.country": {"$nin": ["de", "fr"]}, "$nor": [{"room_type": {"$regex": "^Private"}}],
        "review_scores.review_scores_rating": {"$not": {"$lt": 60}}, "bedrooms": {"$ne": 1},
    },
}
#: Pipelines of query documents.
AGGREGATED = {
    "aggregate_by_document": [
        {"$group": {"_id": "$room_type", "avg_price": {"$avg": "$price"}}},
    ],
    "aggregate_markets": [
        {"$match": {"price": {"$gt": 50}}},
        {"$group": {
            "_id": {"country": "$address.country", "room_type": "$room_type"},
            "listings": {"$sum": 1}, "reviews": {"$sum": "$number_of_reviews"},
            "cheapest": {"$min": "$price"}, "dearest": {"$max": "$price"},
        }},
        {"$match": {"listings": {"$gte": 2}}},
    ],
    "aggregate_leading": [
        {"$group": {"_id": "$address.country", "listings": {"$sum": 1}}},
        {"$sort": {"listings": -1, "_id": 1}},
        {"$limit": 3},
        {"$project": {"country": "$_id", "listings": 1}},
    ],
    "aggregate_count": [
        {"$match": {"address.country": {"$exists": True}}}, {"$count": "listings"},
    ],
}


def _found(name):
    def query(spark, folder):
        found = find(listings_from_documents(spark, folder), FOUND[name])
        return found.select(
            F.col("_id").alias("document_id"), "bedrooms", "price", "room_type"
        )

    return query


def _aggregated(name):
    def query(spark, folder):
        result = aggregate(listings_from_documents(spark, folder), AGGREGATED[name])
        return rounded(result, "avg_price") if "avg_price" in result.columns else result

    return query


def _faulty_lines(spark, folder):
    """The collection as JSON lines, one market's without their end, one room type's without a price."""
    target = new_folder(spark)
    whole = listings_from_documents(spark, folder)
    price = F.when(F.col("room_type") == "Shared room", "on request").otherwise(
        F.concat(F.lit("$"), F.col("price").cast("string"))
    )
    line = F.to_json(F.struct(*whole.withColumn("price", price).columns))
    cut = F.when(F.col("address.country") == MARKET, F.expr("left(line, length(line) - 1)"))
    faulty = whole.withColumn("price", price).withColumn("line", line)
    faulty.select(F.coalesce(cut, "line").alias("value")).write.text(target)
    return target


def listings_checked(spark, folder):
    checked = check_listings(spark, _faulty_lines(spark, folder))
    return li.flatten(checked.rows).select(
        "document_id", "country", "market", "text", li.RATING, "price", "room_type"
    )


def listings_rejected(spark, folder):
    rejected = check_listings(spark, _faulty_lines(spark, folder)).rejected
    key = F.regexp_extract("line", r'"_id":(\d+)', 1).cast("long")
    return rejected.select(key.alias("document_id"), "reason")


# Words --------------------------------------------------------------------------------------------


def word_counts_by_country(spark, folder):
    return markets.word_counts(texts(spark, folder))


def word_counts_no_stopwords(spark, folder):
    return markets.word_counts(texts(spark, folder), stop=sample_stop_words(spark))


def word_counts_default_stopwords(spark, folder):
    """Without the words of the default English list, written as a table and read back."""
    target = new_folder(spark)
    default_stop_words(spark).write.parquet(target)
    return markets.word_counts(texts(spark, folder), stop=read_stop_words(spark, target))


def word_tf_idf_by_country(spark, folder):
    counts = markets.word_counts(texts(spark, folder), stop=sample_stop_words(spark))
    return rounded(word_tf_idf(counts), "tf", "idf", "tf_idf")


def word_tf_idf_one_country(spark, folder):
    market = li.market_slice(texts(spark, folder), MARKET)
    counts = markets.word_counts(market, stop=sample_stop_words(spark))
    return rounded(word_tf_idf(counts), "tf", "idf", "tf_idf")


# Letters and the ideographs that stand for them in texts written without spaces.
LATIN = "abcdefghijklmnopqrstuvwxyz"
SIGNS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"


def signs_of(text):
    return F.translate(F.lower(text), LATIN, SIGNS)


def spaceless(spark, folder):
    """The listings with their texts in ideographs, every two neighbouring words written together."""
    joined = F.regexp_replace(signs_of("text"), "([一-鿿]+) ([一-鿿]+)", "$1$2")
    return texts(spark, folder).withColumn("text", joined)


def sign_dictionary(spark, folder):
    """Words of the benchmark texts in the same signs, weighted by how often they occur."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select(signs_of("text").alias("text"))
    counted = count_by(words(items, "text", keep=[]), "word")
    return counted.where(F.col("word").rlike("^[一-鿿]+$"))


def segmented_word_counts(spark, folder):
    split = segmented(spaceless(spark, folder), sign_dictionary(spark, folder))
    return markets.word_counts(split, "tokens")


def segmented_word_counts_by_join(spark, folder):
    # What goes along is packed with the tokens, so only the country does.
    made = spaceless(spark, folder).select("country", word_tokens(F.col("text")).alias("tokens"))
    split = segmented(made, sign_dictionary(spark, folder), "tokens", limit=0)
    return markets.word_counts(split, "tokens")


def segmented_bigram_top15(spark, folder):
    split = segmented(spaceless(spark, folder), sign_dictionary(spark, folder))
    return markets.top_bigrams(split, sample_stop_words(spark), "tokens")


def _decomposed(spark, folder):
    """The listings with every e and o followed by its accent, one market's in Turkish capitals."""
    accented = F.replace(F.replace("text", F.lit("e"), F.lit("e\u0301")), F.lit("o"), F.lit("o\u0308"))
    capitals = F.translate("text", LATIN.replace("i", "") + "i", LATIN.upper().replace("I", "") + "\u0130")
    text = F.when(F.col("country") == MARKET, capitals).otherwise(accented)
    return texts(spark, folder).withColumn("text", text)


def folded_word_counts(spark, folder):
    return markets.word_counts(fold(_decomposed(spark, folder), "text", {MARKET: "tr"}), "text")


def folded_score_totals(spark, folder):
    """Scores of folded texts by a lexicon whose words are folded as well."""
    scores = sample_afinn(spark)
    accented = scores.withColumn("word", F.replace("word", F.lit("o"), F.lit("o\u0308")))
    lexicon = fold(scores.unionByName(accented).distinct(), "word")
    folded = fold(_decomposed(spark, folder), "text", {MARKET: "tr"})
    return score_totals(words(folded, "text", keep=["country"]), lexicon, weighted=True)


# Lexicons -----------------------------------------------------------------------------------------


def lexicon_rejected(spark, folder):
    """Every word of the texts with its length as value; long words have a word for it, two none."""
    target = new_folder(spark)
    length = F.length("word")
    value = F.when(length > 8, "long").when(length != 2, length.cast("string"))
    listed = words(texts(spark, folder), "text", keep=[]).select("word").distinct()
    listed.withColumn("value", value).write.json(target, ignoreNullFields=False)
    rejected = check_score_lexicon(spark, target, "json").rejected
    return rejected.select(F.get_json_object("line", "$.word").alias("word"), "reason")




def nrc_by_country(spark, folder):
    return class_totals(country_words(spark, folder), sample_nrc(spark))


def bing_by_country(spark, folder):
    return class_totals(country_words(spark, folder), sample_bing(spark))


def bing_occurrences(spark, folder):
    return class_totals(country_words(spark, folder), sample_bing(spark), weighted=True)


def afinn_by_country(spark, folder):
    return score_totals(country_words(spark, folder), sample_afinn(spark))


def afinn_occurrences(spark, folder):
    return score_totals(country_words(spark, folder), sample_afinn(spark), weighted=True)


def mostly_used_words(spark, folder):
    tokens = words(texts(spark, folder), "text", keep=["country"])
    return descending(mostly_used(tokens, sample_afinn(spark)), "n", "country", "word")


def polarity_table(spark, folder):
    return markets.polarity(texts(spark, folder), lexicons(spark))


def sentiment_comparison(spark, folder):
    return markets.comparison(texts(spark, folder), lexicons(spark))


def sentiment_from_tables(spark, folder):
    """The three methods with lexicons written as tables and read back by their readers."""
    target, own = new_folder(spark), lexicons(spark)
    own.afinn.write.option("header", True).csv(f"{target}/afinn")
    own.bing.write.parquet(f"{target}/bing")
    own.nrc.write.json(f"{target}/nrc")
    read = markets.Lexicons(
        read_score_lexicon(spark, f"{target}/afinn", "csv"),
        read_class_lexicon(spark, f"{target}/bing"),
        read_class_lexicon(spark, f"{target}/nrc", "json"),
    )
    return markets.comparison(texts(spark, folder), read)


def class_counts_by_method(spark, folder):
    tokens = words(texts(spark, folder), "text", keep=["country"])
    return slice_class_counts(tokens, sample_bing(spark), sample_nrc(spark))


def high_rated_sentiment(spark, folder):
    high = li.high_rated(texts(spark, folder))
    return markets.comparison(high, lexicons(spark), every=flat(spark, folder))


# Bigrams ------------------------------------------------------------------------------------------


def bigram_rows(spark, folder):
    return unite(clean_bigrams(spark, folder)).select(*KEYS, "word1", "word2", "bigram")


def bigrams_long_stop_list(spark, folder):
    pairs = bigrams(texts(spark, folder), "text", long_stop_words(spark))
    return unite(pairs).select(*KEYS, "place", "word1", "word2", "bigram")


def bigram_split(spark, folder):
    joined = unite(clean_bigrams(spark, folder)).select("document_id", "bigram")
    return separate(joined)


def bigram_top15(spark, folder):
    return markets.top_bigrams(texts(spark, folder), sample_stop_words(spark))


def bigram_edges(spark, folder):
    return rounded(markets.bigram_graph(bigram_top15(spark, folder))[0], "width")


def bigram_nodes(spark, folder):
    return markets.bigram_graph(bigram_top15(spark, folder))[1]


def total_documents_by_country(spark, folder):
    return total_documents(clean_bigrams(spark, folder))


def bigram_weights(spark, folder):
    weighted = unite(bigram_tf_idf(clean_bigrams(spark, folder)))
    return rounded(weighted.drop("word1", "word2"), "tf", "idf", "tf_idf")


def bigram_weights_pinned(spark, folder):
    weighted = unite(bigram_tf_idf(clean_bigrams(spark, folder), n_docs=PINNED_DOCUMENTS))
    return rounded(weighted.drop("word1", "word2"), "tf", "idf", "tf_idf")


def bigram_weights_of_one_market(spark, folder):
    """Every market weighted with the document count of one of them."""
    pairs = clean_bigrams(spark, folder)
    market = total_documents(li.market_slice(pairs, MARKET), by=[])
    weighted = unite(bigram_tf_idf(pairs, n_docs=market))
    return rounded(weighted.drop("word1", "word2"), "tf", "idf", "tf_idf")


def bigram_tf_idf_sorted(spark, folder):
    """The weights of one market in the order of the score."""
    pairs = bigrams(
        li.market_slice(texts(spark, folder), MARKET), "text", sample_stop_words(spark)
    )
    weighted = unite(bigram_tf_idf(pairs)).drop("word1", "word2")
    return rounded(descending(weighted, "tf_idf", "bigram"), "tf", "idf", "tf_idf")


def high_rated_bigram_top15(spark, folder):
    return markets.top_bigrams(li.high_rated(texts(spark, folder)), sample_stop_words(spark))


def high_rated_bigram_edges(spark, folder):
    top = high_rated_bigram_top15(spark, folder)
    return rounded(markets.bigram_graph(top, more_than=None)[0], "width")


def high_rated_bigram_nodes(spark, folder):
    return markets.bigram_graph(high_rated_bigram_top15(spark, folder), more_than=None)[1]


# Documents and topics -----------------------------------------------------------------------------


def unstemmed_doc_terms(spark, folder):
    docs = processed_documents(texts(spark, folder), "text", sample_stop_words(spark), stem=False)
    return doc_terms(docs)


def processed_descriptions_unstemmed(spark, folder):
    docs = processed_documents(texts(spark, folder), "text", sample_stop_words(spark), stem=False)
    return processed_texts(docs)


def doc_terms_long_stop_list(spark, folder):
    docs = processed_documents(texts(spark, folder), "text", long_stop_words(spark), stem=False)
    return doc_terms(docs)


def document_terms(spark, folder):
    docs = processed_documents(texts(spark, folder), "text", sample_stop_words(spark))
    return document_term_matrix(docs)


def vocabulary_stems(spark, folder):
    return word_stems(words(texts(spark, folder), "text", keep=[]))


def stemmed_doc_terms(spark, folder):
    return doc_terms(processed_documents(texts(spark, folder), "text", sample_stop_words(spark)))


def processed_descriptions(spark, folder):
    docs = processed_documents(texts(spark, folder), "text", sample_stop_words(spark))
    return processed_texts(docs)


def _market_topics(spark, folder):
    market = li.market_slice(texts(spark, folder), MARKET)
    return fit_topics(processed_documents(market, "text", sample_stop_words(spark)))


def topic_beta(spark, folder):
    return topic_term_beta(spark, _market_topics(spark, folder))


def topic_top_terms(spark, folder):
    return top_terms(topic_term_beta(spark, _market_topics(spark, folder)))


def topic_vocabulary(spark, folder):
    return topic_beta(spark, folder).select("topic", "term")


def topic_totals(spark, folder):
    beta = topic_beta(spark, folder)
    return beta.groupBy("topic").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.sum("beta"), 6).alias("beta_sum")
    )


def topic_leaders(spark, folder):
    """Two planted topics: the initials of words, marked with their market, so that every document
    uses one of two vocabularies with its own shares.

    The terms that lead a fitted topic are then those that lead its market's counts.
    """
    planted = texts(spark, folder).where(F.col("country").isin(*PLANTED))
    docs = processed_documents(planted, "text", sample_stop_words(spark), stem=False)
    initial = F.transform("tokens", lambda w: F.concat_ws("_", "country", F.substring(w, 1, 1)))
    fitted = fit_topics(docs.withColumn("tokens", initial), max_iter=40)
    leading = top_terms(topic_term_beta(spark, fitted), LEADERS)
    place = F.rank().over(Window.partitionBy("topic").orderBy(F.desc("beta")))
    return leading.select(
        F.split("term", "_")[0].alias("country"), "term", place.cast("long").alias("place")
    )


def topic_panel_labels(spark, folder):
    """Labels of the panel on the planted topics, with the markets that their leading terms come from;
    a panel on a market without listings has no label."""
    planted = texts(spark, folder).where(F.col("country").isin(*PLANTED))
    initial = F.transform(
        word_tokens(F.col("text")), lambda w: F.concat_ws("_", "country", F.substring(w, 1, 1))
    )
    stop = sample_stop_words(spark)
    made = planted.withColumn("text", initial)
    chosen = panels.topic_panel(made, Params(PLANTED), stop, top=LEADERS)
    nothing = panels.topic_panel(made, Params(("nowhere",)), stop, top=LEADERS)
    market = F.split("term", "_")[0]
    return chosen.unionByName(nothing).groupBy("topic_label").agg(
        F.count(F.lit(1)).alias("terms"), F.count_distinct(market).alias("markets")
    )


# Panels and saved tables --------------------------------------------------------------------------


def panel_bigrams(spark, folder):
    panel = panels.bigram_panel(texts(spark, folder), PANEL, sample_stop_words(spark))
    return rounded(panel, "width")


def panel_sentiment(spark, folder):
    lex = lexicons(spark)
    return panels.sentiment_panel(texts(spark, folder), PANEL, lex.afinn, lex.bing, lex.nrc)


def panel_tf_idf_top10(spark, folder):
    panel = panels.tf_idf_panel(texts(spark, folder), PANEL, sample_stop_words(spark))
    return rounded(panel, "tf", "idf", "tf_idf")


def panel_topics(spark, folder):
    return panels.topic_panel(texts(spark, folder), PANEL, sample_stop_words(spark))


def _sums(spark, folder, *names):
    """The named tables of prepared sums, saved and loaded again."""
    lex, target = lexicons(spark), new_folder(spark)
    made = sums.prepared(
        texts(spark, folder), sample_stop_words(spark), lex.afinn, lex.bing, lex.nrc
    )
    sums.save_sums(target, {name: made[name] for name in names})
    return sums.load_sums(spark, target, names)


def panel_bigrams_from_sums(spark, folder):
    return rounded(sums.bigram_panel(_sums(spark, folder, sums.PHRASES), PANEL), "width")


def panel_sentiment_from_sums(spark, folder):
    return sums.sentiment_panel(_sums(spark, folder, sums.SCORES), PANEL)


def panel_tf_idf_from_sums(spark, folder):
    panel = sums.tf_idf_panel(_sums(spark, folder, sums.PHRASES, sums.DOCUMENTS), PANEL)
    return rounded(panel, "tf", "idf", "tf_idf")


def panel_map(spark, folder):
    return panels.map_panel(flat(spark, folder), PANEL)


def artifact_round_trip(spark, folder):
    """Save the token table partitioned by country, load it and answer a panel from it."""
    target = new_folder(spark)
    save_table(markets.token_table(texts(spark, folder)), target, "tokens", ["country"])
    loaded = load_table(spark, target, "tokens")
    panel = panels.tf_idf_panel(loaded, PANEL, sample_stop_words(spark), text="tokens")
    return rounded(panel, "tf", "idf", "tf_idf")


def batch_tables(spark, folder):
    """Run the batch for one market, load what it saved, and report its bigram weights."""
    target = new_folder(spark)
    markets.build_tables(
        texts(spark, folder), target, MARKET, sample_stop_words(spark), lexicons(spark)
    )
    weighted = load_table(spark, target, "market_bigram_tf_idf").drop("word1", "word2")
    return rounded(weighted, "tf", "idf", "tf_idf")


def published_tables(spark, folder):
    """Publish two versions of one market's token table and weights; read the one that is current."""
    target, source = new_folder(spark), texts(spark, folder)

    def written(market):
        def write(version):
            slice_ = li.market_slice(source, market)
            pairs = bigrams(slice_, "text", sample_stop_words(spark))
            made = {"weights": unite(bigram_tf_idf(pairs)), "documents": total_documents(pairs)}
            return save_tables(made, version)

        return write

    publish(spark, target, written(PLANTED[1]))
    publish(spark, target, written(MARKET))
    weighted = current(spark, target).load(spark, "weights").drop("word1", "word2")
    return rounded(weighted, "tf", "idf", "tf_idf")


#: The tables that the batch saves, and what goes into the sum of each.
COUNTED = {
    "tokens": "document_id", "listings": "number_of_reviews", "descriptions": "document_id",
    "market_words": "pos", "market_bing": "n", "market_nrc": "n", "market_polarity": "positive",
    "market_comparison": "sentiment", "market_bigrams": "document_id", "market_bigram_tf_idf": "n",
    "total_documents": "total_documents", "processed_words": "document_id", "doc_terms": "n",
    "processed_texts": "document_id", "afinn": "value", "bing": "length(word)",
    "nrc": "length(word)", "top_terms": "topic",
}


def saved_tables(spark, folder):
    """Everything that the batch publishes: rows of the tables and the sum of one column of each,
    topics and terms of the model."""
    target = new_folder(spark)
    markets.publish_tables(
        texts(spark, folder), target, MARKET, sample_stop_words(spark), lexicons(spark)
    )
    version = current(spark, target)
    counted = [
        version.load(spark, name).agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.expr(column).cast("long")).alias("total"),
        )
        for name, column in COUNTED.items()
    ]
    model = version.load_topic_model()
    held = ("topic_model", model.getK(), model.vocabSize())
    fitted = spark.createDataFrame([held], "name string, rows long, total long")
    return reduce(DataFrame.unionByName, [*counted, fitted])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listings_flat": listings_flat,
    "rated_texts": rated_texts,
    "country_counts": country_counts,
    "market_slice": market_slice,
    "find_bedrooms_price": find_bedrooms_price,
    "avg_price_by_room_type": avg_price_by_room_type,
    "high_rated": high_rated,
    "document_ids": document_ids,
    "document_ids_text_key": document_ids_text_key,
    "document_ids_hot_key": document_ids_hot_key,
    "listings_numbered": listings_numbered,
    "map_points": map_points,
    "word_counts_by_country": word_counts_by_country,
    "word_counts_no_stopwords": word_counts_no_stopwords,
    "word_tf_idf": word_tf_idf_by_country,
    "word_tf_idf_one_country": word_tf_idf_one_country,
    "nrc_by_country": nrc_by_country,
    "bing_by_country": bing_by_country,
    "bing_occurrences": bing_occurrences,
    "afinn_by_country": afinn_by_country,
    "afinn_occurrences": afinn_occurrences,
    "mostly_used_words": mostly_used_words,
    "polarity_table": polarity_table,
    "sentiment_comparison": sentiment_comparison,
    "high_rated_sentiment": high_rated_sentiment,
    "bigrams": bigram_rows,
    "bigram_split": bigram_split,
    "bigram_top15": bigram_top15,
    "bigram_edges": bigram_edges,
    "bigram_nodes": bigram_nodes,
    "total_documents": total_documents_by_country,
    "bigram_tf_idf": bigram_weights,
    "bigram_tf_idf_pinned_n": bigram_weights_pinned,
    "bigram_tf_idf_pinned_market": bigram_weights_of_one_market,
    "bigram_tf_idf_sorted": bigram_tf_idf_sorted,
    "high_rated_bigram_top15": high_rated_bigram_top15,
    "high_rated_bigram_edges": high_rated_bigram_edges,
    "high_rated_bigram_nodes": high_rated_bigram_nodes,
    "unstemmed_doc_terms": unstemmed_doc_terms,
    "processed_descriptions_unstemmed": processed_descriptions_unstemmed,
    "vocabulary_stems": vocabulary_stems,
    "stemmed_doc_terms": stemmed_doc_terms,
    "processed_descriptions": processed_descriptions,
    "topic_term_beta": topic_beta,
    "topic_top_terms": topic_top_terms,
    "panel_bigrams": panel_bigrams,
    "panel_sentiment": panel_sentiment,
    "panel_tf_idf_top10": panel_tf_idf_top10,
    "panel_topics": panel_topics,
    "panel_map": panel_map,
    "artifact_round_trip": artifact_round_trip,
    "batch_tables": batch_tables,
    "saved_tables": saved_tables,
    "listings_json_round_trip": listings_json_round_trip,
    "listings_parquet_round_trip": listings_parquet_round_trip,
    "word_counts_default_stopwords": word_counts_default_stopwords,
    "sentiment_from_tables": sentiment_from_tables,
    "slice_class_counts": class_counts_by_method,
    "bigrams_long_stop_list": bigrams_long_stop_list,
    "doc_terms_long_stop_list": doc_terms_long_stop_list,
    "document_term_matrix": document_terms,
    "topic_vocabulary": topic_vocabulary,
    "topic_totals": topic_totals,
    "topic_leaders": topic_leaders,
    "topic_panel_labels": topic_panel_labels,
    "segmented_word_counts": segmented_word_counts,
    "segmented_word_counts_by_join": segmented_word_counts_by_join,
    "segmented_bigram_top15": segmented_bigram_top15,
    "panel_bigrams_from_sums": panel_bigrams_from_sums,
    "panel_sentiment_from_sums": panel_sentiment_from_sums,
    "panel_tf_idf_from_sums": panel_tf_idf_from_sums,
    **{name: _found(name) for name in FOUND},
    **{name: _aggregated(name) for name in AGGREGATED},
    "listings_checked": listings_checked,
    "listings_rejected": listings_rejected,
    "lexicon_rejected": lexicon_rejected,
    "folded_word_counts": folded_word_counts,
    "folded_score_totals": folded_score_totals,
    "published_tables": published_tables,
}
