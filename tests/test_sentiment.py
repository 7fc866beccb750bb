import pytest
from conftest import rows

from lodgelex.operators import sentiment as se
from lodgelex.operators.tokens import words
from lodgelex.plans.markets import Lexicons, comparison, polarity
from lodgelex.sources.words import read_class_lexicon, read_score_lexicon, read_stop_words


@pytest.fixture(scope="module")
def flat(make):
    return make(
        {"text": "best clown with with", "country": "en"},
        {"text": "scum idiot trash for", "country": "en"},
        {"text": "best best", "country": "de"},
        {"text": "nothing known here", "country": "fr"},
        {"text": None, "country": "es"},
    )


@pytest.fixture(scope="module")
def lexicons(words_of):
    return Lexicons(words_of["afinn"], words_of["bing"], words_of["nrc"])


def test_comparison_keeps_markets_without_hits_or_text(flat, lexicons):
    assert rows(comparison(flat, lexicons), "country", "method", "sentiment") == [
        ("de", "AFINN", 6), ("de", "Bing et al.", 2), ("de", "NRC", 2),
        ("en", "AFINN", -4), ("en", "Bing et al.", 0), ("en", "NRC", 1),
        ("es", "AFINN", 0), ("es", "Bing et al.", 0), ("es", "NRC", 0),
        ("fr", "AFINN", 0), ("fr", "Bing et al.", 0), ("fr", "NRC", 0),
    ]


def test_polarity(flat, lexicons):
    assert rows(polarity(flat, lexicons).where("country = 'en'")) == [
        ("en", "Bing et al.", 4, 4, 0), ("en", "NRC", 2, 3, 1),
    ]


def test_empty_slice_still_has_three_rows(flat, lexicons):
    none = words(flat.where("country = 'nowhere'"), keep=[])
    got = se.sentiment_comparison(none, lexicons.afinn, lexicons.bing, lexicons.nrc, by=[])
    assert rows(got, "method", "sentiment") == [("AFINN", 0), ("Bing et al.", 0), ("NRC", 0)]


def test_distinct_words_against_occurrences(flat, words_of):
    tokens = words(flat, keep=["country"])
    by_word = rows(se.score_totals(tokens, words_of["afinn"]))
    assert by_word == [("de", 3, True), ("en", 3 + 1 - 4 - 3 - 2, False)]
    by_occurrence = rows(se.score_totals(tokens, words_of["afinn"], weighted=True))
    assert by_occurrence == [("de", 6, True), ("en", -4, False)]
    assert rows(se.class_totals(tokens, words_of["nrc"])) == [
        ("de", "joy", 1), ("de", "positive", 1), ("en", "anger", 1), ("en", "disgust", 1),
        ("en", "joy", 1), ("en", "negative", 2), ("en", "positive", 2), ("en", "trust", 1),
    ]


def test_words_with_two_classes_multiply(flat, words_of):
    tokens = words(flat.where("country = 'en'"), keep=["country"])
    got = dict((r.sentiment, r.n) for r in se.class_totals(tokens, words_of["bing"]).collect())
    assert got == {"negative": 4, "positive": 3}


def test_repeated_lexicon_rows_multiply(spark, flat):
    twice = spark.createDataFrame([("best", 3), ("best", 3)], "word string, value int")
    tokens = words(flat.where("country = 'de'"), keep=["country"])
    assert rows(se.score_totals(tokens, twice), "total_afinn_score") == [(6,)]
    assert rows(se.mostly_used(tokens, twice)) == [("de", "best", 4)]


def test_mostly_used(flat, words_of):
    tokens = words(flat, keep=["country"])
    assert ("en", "with", 2) in rows(se.mostly_used(tokens, words_of["afinn"]))


def test_lexicon_too_large_to_broadcast(flat, lexicons, words_of, monkeypatch):
    tokens = words(flat, keep=["country"])
    small = (
        rows(comparison(flat, lexicons)),
        rows(polarity(flat, lexicons)),
        rows(se.class_totals(tokens, words_of["nrc"], weighted=True)),
        rows(se.mostly_used(tokens, words_of["afinn"])),
    )
    monkeypatch.setattr(se, "fits_broadcast", lambda df: False)
    large = (
        rows(comparison(flat, lexicons)),
        rows(polarity(flat, lexicons)),
        rows(se.class_totals(tokens, words_of["nrc"], weighted=True)),
        rows(se.mostly_used(tokens, words_of["afinn"])),
    )
    assert large == small


def test_lexicon_readers(spark, tmp_path, words_of):
    path = str(tmp_path / "afinn")
    words_of["afinn"].write.option("header", True).csv(path)
    assert rows(read_score_lexicon(spark, path, "csv")) == rows(words_of["afinn"])
    path = str(tmp_path / "nrc")
    words_of["nrc"].write.parquet(path)
    assert rows(read_class_lexicon(spark, path)) == rows(words_of["nrc"])
    with pytest.raises(ValueError, match="value"):
        read_score_lexicon(spark, path)
    path = str(tmp_path / "stop")
    words_of["stop"].write.json(path)
    assert rows(read_stop_words(spark, path, "json")) == [("a",), ("in",), ("of",), ("to",)]
