import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgelex.operators.graph import bigram_edges, bigram_nodes
from lodgelex.operators.topics import fit_topics, processed_documents, topic_term_beta
from lodgelex.plans import markets, panels
from lodgelex.plans.params import COUNTRY_CHOICES, Params
from lodgelex.sources import tables


@pytest.fixture(scope="module")
def flat(make):
    return make(
        {"text": "sea view best beach", "country": "Turkey", "rating": 99, "reviews": 3},
        {"text": "sea view of the sea view", "country": "Spain", "rating": 100, "reviews": 2},
        {"text": "city view with trash", "country": "Turkey", "rating": 98, "reviews": 9},
        {"text": "sea view", "country": "Canada", "rating": 100, "reviews": 9},
        {"text": None, "country": "Turkey", "rating": 100, "reviews": 9, "coordinates": (3.0, 4.0)},
        {"text": "sea view", "country": "Turkey", "rating": None},
    )


CHOICE = Params(("Turkey", "Spain"), 99)


def test_params():
    assert Params.reset() == Params(("United States",), 20)
    assert Params("Spain").countries == ("Spain",)
    assert "China" in COUNTRY_CHOICES and "Spain" not in COUNTRY_CHOICES
    for wrong in ({"min_rating": 19}, {"min_rating": 101}, {"countries": ()}):
        with pytest.raises(ValueError):
            Params(**wrong)


def test_selection_is_inclusive_and_needs_a_rating(flat):
    assert rows(panels.selection(flat, CHOICE), "document_id") == [(1,), (2,), (5,)]


def test_bigram_panel(flat, words_of):
    first = panels.bigram_panel(flat, CHOICE, words_of["stop"], top=1).collect()
    assert [(r.src, r.dst, r.n, r.width) for r in first] == [("sea", "view", 3, 3**0.5)]


def test_sentiment_panel(flat, words_of):
    got = panels.sentiment_panel(
        flat, CHOICE, words_of["afinn"], words_of["bing"], words_of["nrc"]
    )
    assert rows(got, "method", "sentiment") == [("AFINN", 3), ("Bing et al.", 1), ("NRC", 1)]


def test_tf_idf_panel(flat, words_of):
    got = panels.tf_idf_panel(flat, CHOICE, words_of["stop"], top=1).collect()
    assert {r.bigram for r in got} == {"best beach", "the sea", "view best"}
    pinned = panels.tf_idf_panel(flat, CHOICE, words_of["stop"], n_docs=100).collect()
    assert pinned[0].bigram == "sea view" and pinned[0].tf == 0.03


def test_map_panel_needs_text_and_reviews(flat):
    assert rows(panels.map_panel(flat, CHOICE)) == [(1.0, 2.0)]


def test_topic_panel(flat, words_of):
    terms = panels.topic_panel(flat, CHOICE, words_of["stop"])
    assert {r.term for r in terms.collect()} == {"sea", "view", "best", "beach", "the"}
    assert panels.topic_panel(flat, Params("Nowhere"), words_of["stop"]).count() == 0


def test_panels_from_the_saved_token_table(spark, flat, words_of, tmp_path):
    folder = str(tmp_path)
    tables.save_table(markets.token_table(flat), folder, "tokens", ["country"])
    saved = tables.load_table(spark, folder, "tokens")
    stop = words_of["stop"]
    for panel in (panels.bigram_panel, panels.tf_idf_panel):
        assert rows(panel(saved, CHOICE, stop, text="tokens")) == rows(panel(flat, CHOICE, stop))
    assert rows(panels.map_panel(saved, CHOICE, "tokens")) == rows(panels.map_panel(flat, CHOICE))
    lex = [words_of[name] for name in ("afinn", "bing", "nrc")]
    assert rows(panels.sentiment_panel(saved, CHOICE, *lex, text="tokens")) == rows(
        panels.sentiment_panel(flat, CHOICE, *lex)
    )
    plan = panels.selection(saved, CHOICE)._jdf.queryExecution().executedPlan().toString()
    assert "country#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(review_scores_rating,99)" in plan


def test_graph_threshold_is_strict(spark):
    counts = spark.createDataFrame(
        [("x", "a", "b", 15), ("x", "b", "c", 16), ("x", "c", "b", 17)],
        "country string, word1 string, word2 string, n long",
    )
    edges, nodes = markets.bigram_graph(counts)
    assert rows(edges, "src", "dst", "n") == [("b", "c", 16), ("c", "b", 17)]
    assert rows(nodes) == [("x", "b"), ("x", "c")]
    assert bigram_edges(counts).count() == 3
    assert rows(bigram_nodes(bigram_edges(counts), by=[])) == [("a",), ("b",), ("c",)]


def test_derived_tables_round_trip(spark, flat, words_of, tmp_path):
    lexicons = markets.Lexicons(words_of["afinn"], words_of["bing"], words_of["nrc"])
    docs = processed_documents(flat.where("country = 'Turkey'"), stop=words_of["stop"])
    fitted = fit_topics(docs, max_iter=2)
    made = markets.derived_tables(flat, "Turkey", words_of["stop"], lexicons, fitted)
    assert len(made) == 17
    tables.save_tables(made, str(tmp_path))
    loaded = tables.load_tables(spark, str(tmp_path), list(made))
    for name, table in made.items():
        assert sorted(loaded[name].columns) == sorted(table.columns), name
        assert sorted(map(str, loaded[name].select(*table.columns).collect())) == sorted(
            map(str, table.collect())
        ), name
    assert rows(loaded["total_documents"]) == [("Turkey", 3)]


def test_model_round_trip(spark, flat, tmp_path):
    model, terms = fit_topics(processed_documents(flat), max_iter=2)
    tables.save_topic_model(model, str(tmp_path))
    again = tables.load_topic_model(str(tmp_path))
    assert rows(topic_term_beta(spark, (again, terms))) == rows(
        topic_term_beta(spark, (model, terms))
    )


def test_batch_run_saves_what_the_reports_give(spark, flat, words_of, tmp_path):
    lexicons = markets.Lexicons(words_of["afinn"], words_of["bing"], words_of["nrc"])
    stop = words_of["stop"]
    names = markets.build_tables(flat, str(tmp_path), "Turkey", stop, lexicons)
    assert len(names) == 19 and {"tokens", "top_terms", "topic_model"} <= set(names)
    direct = markets.derived_tables(flat, "Turkey", stop, lexicons)
    for name, table in direct.items():
        saved = tables.load_table(spark, str(tmp_path), name).select(*table.columns)
        assert sorted(map(str, saved.collect())) == sorted(map(str, table.collect())), name
    assert tables.load_topic_model(str(tmp_path)).describeTopics(1).count() == 2


def test_one_saved_file_is_read_by_many_tasks(spark, tmp_path):
    numbers = spark.range(2_000_000).select(F.xxhash64("id").alias("id")).coalesce(1)
    tables.save_table(numbers, str(tmp_path), "numbers")
    loaded = tables.load_table(spark, str(tmp_path), "numbers")
    held = loaded.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in held) == 2_000_000
    assert len(held) > 2 and max(r["count"] for r in held) < 1_000_000
