"""Grouped reports against the same report made market by market, on the test tables."""

import pytest

from lodgelex.operators import listings as li
from lodgelex.operators.sentiment import class_totals
from lodgelex.operators.tokens import bigrams, unite, words
from lodgelex.operators.weighting import bigram_tf_idf
from lodgelex.plans import markets
from lodgelex.sources.listings import listings_from_documents

FOLDER = "/root/testdata/sf0.001"
COUNTRIES = ("de", "en", "es", "fr")


@pytest.fixture(scope="module")
def flat(spark):
    return li.flatten(listings_from_documents(spark, FOLDER))


@pytest.fixture(scope="module")
def lexicons(words_of):
    return markets.Lexicons(words_of["afinn"], words_of["bing"], words_of["nrc"])


def lines(df):
    return sorted(str(r) for r in df.collect())


def reports(lexicons, stop):
    return {
        "top": lambda flat: markets.top_bigrams(flat, stop),
        "weights": lambda flat: unite(bigram_tf_idf(bigrams(flat, "text", stop))),
        "comparison": lambda flat: markets.comparison(flat, lexicons),
        "polarity": lambda flat: markets.polarity(flat, lexicons),
        "classes": lambda flat: class_totals(words(flat, keep=["country"]), lexicons.nrc),
        "counts": lambda flat: markets.word_counts(flat, stop=stop),
    }


@pytest.mark.parametrize("name", ["top", "weights", "comparison", "polarity", "classes", "counts"])
def test_grouped_equals_market_by_market(flat, lexicons, words_of, name):
    report = reports(lexicons, words_of["stop"])[name]
    single = [line for c in COUNTRIES for line in lines(report(li.market_slice(flat, c)))]
    assert lines(report(flat)) == sorted(single)


def test_market_filter_may_come_after_the_report(flat, lexicons):
    after = markets.comparison(flat, lexicons).where("country = 'de'")
    assert lines(after) == lines(markets.comparison(li.market_slice(flat, "de"), lexicons))
    assert "EqualTo(lang,de)" in after._jdf.queryExecution().executedPlan().toString()


def test_high_rated_is_a_part_of_the_collection(flat, words_of):
    rated = markets.top_bigrams(li.high_rated(flat), words_of["stop"])
    assert {r.country for r in rated.collect()} <= set(COUNTRIES)
    assert li.high_rated(flat).count() == 23


def test_known_comparison_of_the_larger_tables(spark, lexicons):
    """Values worked out beforehand in SQL."""
    flat = li.flatten(listings_from_documents(spark, "/root/testdata/sf0.01"))
    got = {(r.country, r.method): r.sentiment for r in markets.comparison(flat, lexicons).collect()}
    expected = {"de": (65, 23, 23), "en": (765, 1340, 1350), "es": (1, 1, 1), "fr": (1, 1, 1)}
    methods = ("AFINN", "Bing et al.", "NRC")
    assert got == {
        (country, method): value
        for country, values in expected.items()
        for method, value in zip(methods, values, strict=True)
    }
