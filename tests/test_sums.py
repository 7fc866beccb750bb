import pytest
from conftest import rows

from lodgelex.operators.listings import RATING
from lodgelex.plans import panels, sums
from lodgelex.plans.params import Params


@pytest.fixture(scope="module")
def listings(make):
    texts = ["best scum with sea view", "sea view trash best", "best best sea view", "idiot sea", None, ""]
    return make(*[
        {"text": texts[i % 6], "rating": [20, 55, 55, 80, 100, None, 19][i % 7],
         "country": ["Turkey", "Brazil", None, "Turkey"][i % 4]}
        for i in range(60)
    ])


@pytest.fixture(scope="module")
def loaded(spark, listings, words_of, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sums"))
    made = sums.prepared(listings, words_of["stop"], words_of["afinn"], words_of["bing"], words_of["nrc"])
    sums.save_sums(folder, made)
    return sums.load_sums(spark, folder)


@pytest.mark.parametrize("rating", [20, 21, 55, 56, 80, 100])
@pytest.mark.parametrize("countries", [("Turkey",), ("Turkey", "Brazil"), ("Nowhere",)])
def test_panels_from_sums_equal_the_panels(listings, loaded, words_of, rating, countries):
    chosen = Params(countries, rating)
    stop, lex = words_of["stop"], [words_of[k] for k in ("afinn", "bing", "nrc")]
    as_text = lambda df: sorted(map(str, df.collect()))
    assert as_text(sums.bigram_panel(loaded, chosen)) == as_text(panels.bigram_panel(listings, chosen, stop))
    assert as_text(sums.sentiment_panel(loaded, chosen)) == as_text(
        panels.sentiment_panel(listings, chosen, *lex)
    )
    assert as_text(sums.tf_idf_panel(loaded, chosen)) == as_text(panels.tf_idf_panel(listings, chosen, stop))


def test_steps_cover_every_lowest_rating_once(loaded):
    for rating in range(20, 101):
        chosen = sums.at_rating(loaded[sums.PHRASES], Params(("Turkey",), rating))
        assert chosen.count() == chosen.select("country", "word1", "word2").distinct().count()


def test_choices_reach_the_scan(loaded):
    plan = sums.bigram_panel(loaded, Params(("Turkey",), 90))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rating,90)" in plan and "LessThan(above,90)" in plan
    assert "country" in plan.split("PartitionFilters")[1] and "regexp_extract_all" not in plan


def test_rating_steps_add_up_from_above(spark):
    counts = spark.createDataFrame([("a", 20, 1), ("a", 50, 2), ("a", 90, 4)], f"country string, {RATING} int, n long")
    assert rows(sums.rating_steps(counts, ["country"], ["n"]), "above", "rating", "n") == [
        (sums.LOWEST, 20, 7), (20, 50, 6), (50, 90, 4),
    ]


def test_prepared_sums_sort_once_and_count_documents_without_phrases(listings, words_of):
    made = sums.prepared(listings, words_of["stop"], words_of["afinn"], words_of["bing"], words_of["nrc"])
    planned = {
        name: made[name]._jdf.queryExecution().executedPlan().toString()
        for name in (sums.PHRASES, sums.DOCUMENTS)
    }
    assert planned[sums.PHRASES].count("Sort [") == 1
    exchanged = [line for line in planned[sums.DOCUMENTS].splitlines() if "hashpartitioning" in line]
    assert exchanged and not any("word1" in line for line in exchanged)
