import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgelex.operators.counting import count_by
from lodgelex.operators.tokens import bigrams, words
from lodgelex.operators.weighting import bigram_tf_idf, total_documents, word_tf_idf
from lodgelex.plans.markets import word_counts


@pytest.fixture(scope="module")
def flat(make):
    return make(
        {"text": "sea view sea view", "country": "Spain"},
        {"text": "city view", "country": "Spain"},
        {"text": "sea sea sea", "country": "Turkey"},
        {"text": "alone", "country": "Turkey"},
        {"text": None, "country": "Canada"},
    )


def test_word_weights(flat):
    weights = {
        (r.country, r.word): r for r in word_tf_idf(word_counts(flat)).collect()
    }
    assert len(weights) == 5
    sea = weights["Turkey", "sea"]
    assert (sea.n, sea.total_words, sea.doc_freq) == (3, 4, 2)
    assert sea.tf == 3 / 4 and sea.idf == 0.0 and sea.tf_idf == 0.0
    city = weights["Spain", "city"]
    assert city.tf_idf == pytest.approx(1 / 6 * math.log(2))


def test_tf_sums_to_one_per_document(flat):
    sums = word_tf_idf(word_counts(flat)).groupBy("country").agg(F.sum("tf").alias("s")).collect()
    assert [pytest.approx(1.0)] * 2 == [r.s for r in sums]


def test_one_country_scores_zero_throughout(flat):
    only = flat.where("country = 'Spain'")
    assert {r.tf_idf for r in word_tf_idf(word_counts(only)).collect()} == {0.0}


def test_listings_may_be_the_documents(flat):
    counts = count_by(words(flat), "document_id", "word")
    got = {(r.document_id, r.word): r for r in word_tf_idf(counts, "document_id").collect()}
    assert got[2, "view"].doc_freq == 2
    assert got[2, "view"].tf_idf == pytest.approx(1 / 2 * math.log(4 / 2))


def test_bigram_weights_and_negative_idf(flat):
    got = {(r.country, r.word1, r.word2): r for r in bigram_tf_idf(bigrams(flat)).collect()}
    repeated = got["Turkey", "sea", "sea"]
    assert (repeated.n, repeated.tf) == (2, 2.0)
    assert repeated.idf == pytest.approx(math.log(1 / 2)) and repeated.tf_idf < 0
    assert got["Spain", "sea", "view"].idf == 0.0
    assert got["Spain", "city", "view"].tf_idf == pytest.approx(0.5 * math.log(2))


def test_pinned_document_count(flat):
    got = {(r.word1, r.word2): r for r in bigram_tf_idf(bigrams(flat), n_docs=8).collect()}
    assert got["sea", "sea"].tf == 2 / 8
    assert got["sea", "sea"].idf == pytest.approx(math.log(8 / 2))


def test_document_counts_with_and_without_places(flat, words_of):
    pairs = bigrams(flat, stop=words_of["stop"])
    expected = [("Spain", 2), ("Turkey", 1)]
    assert rows(total_documents(pairs)) == expected
    assert rows(total_documents(pairs.drop("place"))) == expected
    assert rows(total_documents(pairs, by=[])) == [(3,)]
    with_place = rows(bigram_tf_idf(pairs))
    assert rows(bigram_tf_idf(pairs.drop("place"))) == with_place


def test_pooled_slice(flat):
    got = {(r.word1, r.word2): r for r in bigram_tf_idf(bigrams(flat), by=[]).collect()}
    assert got["sea", "sea"].tf == pytest.approx(2 / 3)
    assert got["view", "sea"].tf_idf == pytest.approx(1 / 3 * math.log(3))


def test_no_documents_give_null_weights(make, words_of):
    flat = make({"text": "sea view"}, {"text": "sea", "country": "Spain"})
    pairs = bigrams(flat, "text", words_of["stop"])
    none = total_documents(pairs.where("country = 'Spain'"), by=[])
    (row,) = bigram_tf_idf(pairs, n_docs=none).collect()
    assert (row.n, row.tf, row.idf, row.tf_idf) == (1, None, None, None)
